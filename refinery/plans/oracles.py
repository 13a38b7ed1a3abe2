"""The same queries as SQL text for DuckDB, spelled out independently of the operators.

Only the derivation of the raw input is shared. Rounding goes through the shortest text
of the double and a decimal, which is how Spark rounds doubles.
"""

from __future__ import annotations

from refinery.schemas import AUDIT_COLUMNS, CLEAN, FACT_SALES, RAW
from refinery.sources.derived_orders import raw_orders_sql


def _rounded(value: str, digits: int) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38,15)), {digits}) AS DOUBLE)"


def _repaired(value: str) -> str:
    for broken, right in [("â€™", "''"), ("â€œ", '"'), ("â€", '"'), ("Ã©", "é")]:
        value = f"replace({value}, '{broken}', '{right}')"
    return f"replace({value}, chr(0), '')"


def _trimmed(column: str) -> str:
    return _repaired(f"trim({column}, ' ')")


def _integer(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '[+-]?[0-9]+') "
        f"THEN TRY_CAST({column} AS INTEGER) END"
    )


_TRIMMED = ["order_id", "customer_id", "product_id", "customer_name", "product_name"]
_LOWERED = ["category", "status", "region"]
_TEXT = ", ".join(
    [f"{_trimmed(c)} AS {c}" for c in _TRIMMED]
    + [f"lower({_trimmed(c)}) AS {c}" for c in _LOWERED]
)
_NUMBERS = f"""
    {_integer("quantity")} AS quantity,
    TRY_CAST(unit_price AS DOUBLE) AS unit_price,
    TRY_CAST(total_amount AS DOUBLE) AS total_amount"""
_DATE_TEXT = "replace(trim(order_date, ' '), '/', '-')"
_DATE = f"""CASE WHEN NOT regexp_matches({_DATE_TEXT}, '[0-9]{{4}}') THEN NULL
    ELSE CAST(coalesce(
      try_strptime({_DATE_TEXT}, '%Y-%m-%d'),
      CASE WHEN TRY_CAST(left({_DATE_TEXT}, 2) AS INTEGER) > 12
           THEN try_strptime({_DATE_TEXT}, '%d-%m-%Y') END,
      try_strptime({_DATE_TEXT}, '%m-%d-%Y'),
      try_strptime({_DATE_TEXT}, '%d-%m-%Y')) AS DATE) END"""
_FILLED_TEXT = """
    coalesce(customer_name, 'unknown') AS customer_name,
    coalesce(product_name, 'unknown') AS product_name,
    coalesce(category, 'uncategorized') AS category,
    coalesce(region, 'unknown') AS region,
    coalesce(status, 'unknown') AS status"""
_FILLED_NUMBERS = """
    coalesce(quantity, 0) AS quantity,
    coalesce(unit_price, 0.0) AS unit_price,
    coalesce(total_amount, 0.0) AS total_amount"""

_RAW = f"raw AS ({raw_orders_sql()})"
_MOVED = f"raw AS ({raw_orders_sql('moved')})"
_RAW_OTHERS = [c for c in RAW.names if c not in ("order_id", "product_id")]
_DEDUP = f"""deduplicated AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id, product_id
      ORDER BY {", ".join(f"{c} ASC NULLS LAST" for c in _RAW_OTHERS)}) AS n
    FROM raw)
  WHERE n = 1)"""
_CLEAN = f"""{_DEDUP},
typed AS (
  SELECT {_TEXT}, {_NUMBERS},
    order_date AS order_date_raw, {_DATE_TEXT} AS order_date_clean, {_DATE} AS order_date
  FROM deduplicated),
filled AS (
  SELECT order_id, customer_id, product_id, {_FILLED_TEXT}, {_FILLED_NUMBERS},
    order_date_raw, order_date_clean, order_date
  FROM typed
  WHERE order_id <> '' AND customer_id <> '' AND product_id <> ''),
totalled AS (
  SELECT *, {_rounded("quantity * unit_price", 2)} AS calculated_total FROM filled),
clean AS (
  SELECT *, order_date IS NULL AS is_date_missing,
    abs(total_amount - calculated_total) > 0.01 AS total_amount_mismatch,
    CAST(year(order_date) AS INTEGER) AS order_year,
    CAST(month(order_date) AS INTEGER) AS order_month
  FROM totalled)"""


def _dimension(key: str, sk: str, attributes: list[str], name: str) -> str:
    last = ", ".join(f"{a} DESC NULLS LAST" for a in attributes)
    return f"""{name} AS (
  SELECT CAST(dense_rank() OVER (ORDER BY {key} NULLS FIRST) AS BIGINT) AS {sk},
    {key}, {", ".join(attributes)}
  FROM (SELECT *, row_number() OVER (
          PARTITION BY {key} ORDER BY order_date DESC NULLS LAST, {last}) AS n FROM clean)
  WHERE n = 1)"""


_DIM_CUSTOMER = _dimension("customer_id", "customer_sk", ["customer_name", "region"], "dim_customer")
_DIM_PRODUCT = _dimension("product_id", "product_sk", ["product_name", "category"], "dim_product")
_DIM_REGION = """dim_region AS (
  SELECT CAST(dense_rank() OVER (ORDER BY region NULLS FIRST) AS BIGINT) AS region_sk,
    region AS region_name, upper(region) AS region_code,
    CASE WHEN region IN ('north', 'northeast', 'northwest') THEN 'North Zone'
         WHEN region IN ('south', 'southeast', 'southwest') THEN 'South Zone'
         WHEN region = 'east' THEN 'East Zone' WHEN region = 'west' THEN 'West Zone'
         WHEN region = 'central' THEN 'Central Zone' ELSE 'Unknown Zone' END AS geo_zone
  FROM (SELECT DISTINCT region FROM clean))"""
_DIM_DATE = """dim_date AS (
  SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_sk, order_date,
    CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter,
    CAST(month(order_date) AS INTEGER) AS month, strftime(order_date, '%B') AS month_name,
    CAST(weekofyear(order_date) AS INTEGER) AS week_of_year,
    CAST(day(order_date) AS INTEGER) AS day_of_month,
    CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week,
    strftime(order_date, '%A') AS day_name,
    dayofweek(order_date) IN (0, 6) AS is_weekend,
    day(order_date) = 1 AS is_month_start,
    order_date = last_day(order_date) AS is_month_end
  FROM (SELECT DISTINCT order_date FROM clean WHERE order_date IS NOT NULL))"""

_MEASURES = f"""measures AS (
  SELECT *,
    {_rounded("revenue - total_amount", 2)} AS discount_amount,
    CASE WHEN revenue > 0 THEN {_rounded("(revenue - total_amount) / revenue", 4)}
         ELSE 0.0 END AS discount_rate,
    {_rounded("total_amount / CASE WHEN quantity > 0 THEN quantity ELSE 1 END", 2)}
      AS avg_unit_price,
    total_amount > 500 AS is_high_value,
    CASE WHEN quantity <= 1 THEN 'single' WHEN quantity <= 5 THEN 'small'
         WHEN quantity <= 20 THEN 'medium' ELSE 'large' END AS order_size_bucket,
    CASE WHEN total_amount < 50 THEN 'low' WHEN total_amount < 500 THEN 'medium'
         WHEN total_amount < 5000 THEN 'high' ELSE 'enterprise' END AS revenue_band
  FROM (SELECT *, calculated_total AS revenue FROM clean))"""
_FACT = f"""{_DIM_CUSTOMER}, {_DIM_PRODUCT}, {_DIM_DATE}, {_DIM_REGION}, {_MEASURES},
fact AS (
  SELECT m.*, c.customer_sk, p.product_sk, d.date_sk, r.region_sk
  FROM measures m
  LEFT JOIN dim_customer c ON c.customer_id = m.customer_id
  LEFT JOIN dim_product p ON p.product_id = m.product_id
  LEFT JOIN dim_date d ON d.order_date = m.order_date
  LEFT JOIN dim_region r ON r.region_name = m.region)"""

_CLEAN_COLUMNS = ", ".join(c for c in CLEAN.names if c not in AUDIT_COLUMNS)
_FACT_COLUMNS = ", ".join(c for c in FACT_SALES.names if c not in AUDIT_COLUMNS)
_EVEN = "right(order_id, 1) IN ('0', '2', '4', '6', '8')"
_MONTHS = """SELECT order_year, order_month, count(*) AS count FROM clean
  GROUP BY order_year, order_month
  ORDER BY order_year NULLS FIRST, order_month NULLS FIRST"""


def _raw(select: str) -> str:
    return f"WITH {_RAW} {select}"


def _clean(select: str, source: str = _RAW) -> str:
    return f"WITH {source}, {_CLEAN} {select}"


def _star(select: str) -> str:
    return f"WITH {_RAW}, {_CLEAN}, {_FACT} {select}"


def _upserted() -> str:
    status = "CASE WHEN batch = 1 THEN 'returned' ELSE status END AS status"
    columns = _CLEAN_COLUMNS.replace(", status,", f", {status},")
    return _clean(
        f"""SELECT {_CLEAN_COLUMNS} FROM (
          SELECT {columns}, row_number() OVER (
            PARTITION BY order_id, product_id ORDER BY batch DESC) AS n
          FROM (SELECT *, 0 AS batch FROM clean
                UNION ALL SELECT *, 1 AS batch FROM clean WHERE {_EVEN}))
        WHERE n = 1"""
    )


def _latest() -> str:
    """The latest of all versions, those of the table and those of the batch."""
    versions = """SELECT *, 0 AS age FROM clean
      UNION ALL SELECT * REPLACE ('returned' AS status), 1 FROM clean
        WHERE right(order_id, 1) IN ('0', '2', '4', '6', '8')
      UNION ALL SELECT * REPLACE ('shipped' AS status), 2 FROM clean
        WHERE right(order_id, 1) IN ('0', '4')
      UNION ALL SELECT * REPLACE ('lost' AS status), -1 FROM clean
        WHERE right(order_id, 1) IN ('1', '2', '6')"""
    return _clean(
        f"""SELECT {_CLEAN_COLUMNS} FROM (SELECT *, row_number() OVER (
          PARTITION BY order_id, product_id ORDER BY age DESC) AS n FROM ({versions}))
        WHERE n = 1"""
    )


def _rough(select: str) -> str:
    """Duplicates by key without padding; blank text counts as missing, which comes last."""
    blank = "CASE WHEN coalesce(trim({0}, ' '), '') = '' THEN 1 ELSE 0 END, {0}"
    others = ", ".join(blank.format(c) for c in _RAW_OTHERS)
    keys = ", ".join(f"{_trimmed(c)} AS {c}" for c in ("order_id", "product_id"))
    deduplicated = f"""padded AS ({raw_orders_sql('rough')}),
deduplicated AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY {others}) AS n
    FROM (SELECT * REPLACE ({keys}) FROM padded))
  WHERE n = 1)"""
    return f"WITH {_CLEAN.replace(_DEDUP, deduplicated)} {select}"


def _lossy() -> str:
    return _clean(
        f"""SELECT 'order_id' AS "column", 'declared' AS state, CAST(0 AS BIGINT) AS cast_failures,
          count(*) FILTER (order_id IS NULL) AS nulls FROM clean
        UNION ALL SELECT 'quantity', 'declared', count(*) FILTER ({_EVEN} AND quantity IS NOT NULL),
          count(*) FILTER (quantity IS NULL) FROM clean
        UNION ALL SELECT 'order_date', 'declared',
          count(*) FILTER ({_EVEN} AND order_date IS NOT NULL),
          count(*) FILTER (order_date IS NULL) FROM clean"""
    )


def _orphans() -> str:
    def count(key: str) -> str:
        return f"""(SELECT count(*) FROM clean WHERE {key} IS NOT NULL AND {key} NOT IN
          (SELECT {key} FROM clean WHERE order_date < DATE '2000-01-01')) AS orphan_{key}"""

    keys = ["customer_id", "product_id", "order_date", "region"]
    return _clean("SELECT " + ", ".join(map(count, keys)))


def _contract() -> str:
    fails = {
        "quantity": f"quantity IS NOT NULL AND {_integer('quantity')} IS NULL",
        "unit_price": "unit_price IS NOT NULL AND TRY_CAST(unit_price AS DOUBLE) IS NULL",
        "total_amount": "total_amount IS NOT NULL AND TRY_CAST(total_amount AS DOUBLE) IS NULL",
        "order_date": "order_date IS NOT NULL AND "
        "NOT regexp_full_match(order_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')",
    }
    parts = []
    for column in CLEAN.names:
        there = column in RAW.names
        failures = f"count(*) FILTER ({fails[column]})" if column in fails else "CAST(0 AS BIGINT)"
        nulls = f"count(*) FILTER ({column} IS NULL)" if there else "count(*)"
        parts.append(
            f"""SELECT '{column}' AS "column", '{"declared" if there else "missing"}' AS state,
              {failures} AS cast_failures, {nulls} AS nulls FROM raw"""
        )
    return _raw(" UNION ALL ".join(parts))


def _stable() -> str:
    """Numbers of the first load's ids in their order, then those of ids only the second has."""
    latest = """SELECT * EXCLUDE (n) FROM (SELECT customer_id, customer_name, region, row_number() OVER (
        PARTITION BY customer_id ORDER BY order_date DESC, customer_name DESC NULLS LAST, region DESC NULLS LAST) AS n
      FROM clean WHERE order_date BETWEEN DATE '1993-07-01' AND DATE '1994-06-30') WHERE n = 1"""
    return _clean(
        f""", old AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_sk
          FROM (SELECT DISTINCT customer_id FROM clean
                WHERE order_date BETWEEN DATE '1992-01-01' AND DATE '1992-12-31')),
        present AS ({latest}),
        fresh AS (SELECT customer_id, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY customer_id) AS customer_sk
          FROM present WHERE customer_id NOT IN (SELECT customer_id FROM old))
        SELECT CAST(coalesce(o.customer_sk, f.customer_sk) AS BIGINT) AS customer_sk, p.*
        FROM present p LEFT JOIN old o USING (customer_id) LEFT JOIN fresh f USING (customer_id)"""
    )


def _quarantined() -> str:
    problems = f"""concat_ws('; ',
        CASE WHEN customer_id IS NULL THEN 'customer_id:is required' END,
        CASE WHEN quantity IS NOT NULL AND {_integer("quantity")} IS NULL THEN 'quantity:' || quantity || ':does not cast' END,
        CASE WHEN unit_price IS NOT NULL AND TRY_CAST(unit_price AS DOUBLE) IS NULL THEN 'unit_price:' || unit_price || ':does not cast' END,
        CASE WHEN NOT regexp_full_match(order_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'order_date:' || order_date || ':does not cast' END)"""
    return _raw(
        f"""SELECT order_id, customer_id, product_id, quantity,
          CASE WHEN problems = '' THEN 'accepted' ELSE 'rejected' END AS verdict, problems
        FROM (SELECT *, {problems} AS problems FROM raw)"""
    )


# Attributes of a customer per day, and the days on which they change.
_HISTORY = """days AS (
  SELECT customer_id, order_date, customer_name, region FROM (SELECT *, row_number() OVER (
    PARTITION BY customer_id, order_date ORDER BY customer_name DESC NULLS LAST, region DESC NULLS LAST) AS n FROM clean)
  WHERE n = 1 AND (order_date IS NOT NULL OR customer_id NOT IN (SELECT customer_id FROM clean WHERE order_date IS NOT NULL))),
changes AS (
  SELECT * FROM (SELECT *, lag(customer_name) OVER w AS old_name, lag(region) OVER w AS old_region,
                        row_number() OVER w AS n
    FROM days WINDOW w AS (PARTITION BY customer_id ORDER BY order_date))
  WHERE n = 1 OR old_name IS DISTINCT FROM customer_name OR old_region IS DISTINCT FROM region),
history AS (
  SELECT customer_id, customer_name, region, CAST(row_number() OVER w AS INTEGER) AS version,
    order_date AS valid_from, CAST(lead(order_date) OVER w - 1 AS DATE) AS valid_to
  FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY order_date))"""


def _as_of() -> str:
    return _clean(
        f""", {_HISTORY}
        SELECT c.order_id, c.product_id, c.customer_id, c.order_date,
          h.version, h.customer_name, h.region
        FROM clean c JOIN history h ON h.customer_id = c.customer_id
          AND CASE WHEN c.order_date IS NULL THEN h.valid_to IS NULL
                   ELSE coalesce(h.valid_from, c.order_date) <= c.order_date
                     AND coalesce(h.valid_to, c.order_date) >= c.order_date END""",
        _MOVED,
    )


def _fingerprint() -> str:
    columns = ["order_id", "customer_id", "product_id", "quantity", "order_date", "is_date_missing", "order_date_raw", "category"]
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    row = " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts)
    return _clean(
        f"""SELECT count(*) AS rows, CAST(CAST(sum(CAST(CAST('0x' || substr(md5({row}), 1, 15) AS BIGINT)
          AS HUGEINT)) AS DECIMAL(38,0)) AS VARCHAR) AS digest, TRUE AS as_written FROM clean"""
    )


_TEXT_ROWS = f"SELECT {_TEXT}, quantity, unit_price, total_amount, order_date FROM raw"
_NUMBER_ROWS = f"SELECT * EXCLUDE (quantity, unit_price, total_amount), {_NUMBERS} FROM raw"
_PARSED = f"{_DATE_TEXT} AS order_date_clean, {_DATE} AS order_date"

ORACLES: dict[str, str] = {
    "scan_raw": _raw("SELECT * FROM raw"),
    "scan_clean": _clean(f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "roundtrip_csv": _clean(f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "partition_pruned_scan": _clean(
        f"SELECT {_CLEAN_COLUMNS} FROM clean WHERE order_year = 1997 AND order_month <= 6"
    ),
    "publish_fact": _star(f"SELECT {_FACT_COLUMNS} FROM fact"),
    "publish_star": _star(f"SELECT {_FACT_COLUMNS} FROM fact"),
    "publish_catalog": _clean(f", {_DIM_REGION} SELECT * FROM dim_region"),
    "table_counts": _star(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", count(*) AS rows FROM {sql}"""
            for name, sql in [
                ("dim_customer", "dim_customer"), ("dim_product", "dim_product"),
                ("dim_date", "dim_date"), ("dim_region", "dim_region"), ("fact_sales", "fact"),
            ]
        )
    ),
    "incremental_upsert_latest": _latest(),
    "incremental_upsert_latest_table": _latest(),
    "refine_rough": _rough(f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "build_fact_rough": _rough(f", {_FACT} SELECT {_FACT_COLUMNS} FROM fact"),
    "roundtrip_csv_rough": _rough(f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "check_contract_lossy": _lossy(),
    "publish_dim_date": _clean(f", {_DIM_DATE} SELECT * FROM dim_date"),
    "incremental_upsert": _upserted(),
    "incremental_upsert_table": _upserted(),
    "dedup_rows": _raw("SELECT DISTINCT * FROM raw"),
    "dedup_business_key": _raw(f", {_DEDUP} SELECT * FROM deduplicated"),
    "clean_text": _raw(_TEXT_ROWS),
    "repair_encoding": _raw(
        f"SELECT order_id, product_id, {_repaired('customer_name')} AS customer_name FROM raw"
    ),
    "parse_dates": _raw(
        f"SELECT order_id, product_id, order_date AS order_date_raw, {_PARSED} FROM raw"
    ),
    "cast_numbers": _raw(f"SELECT order_id, product_id, {_NUMBERS} FROM raw"),
    "require_keys": _raw(
        f"SELECT * FROM ({_TEXT_ROWS}) "
        "WHERE order_id <> '' AND customer_id <> '' AND product_id <> ''"
    ),
    "fill_defaults": _raw(
        f"SELECT order_id, customer_id, product_id, order_date, {_FILLED_TEXT}, "
        f"{_FILLED_NUMBERS} FROM ({_NUMBER_ROWS})"
    ),
    "flag_missing_dates": _raw(
        "SELECT *, order_date IS NULL AS is_date_missing FROM "
        f"(SELECT order_id, product_id, order_date AS order_date_raw, {_DATE} AS order_date FROM raw)"
    ),
    "flag_amount_mismatch": _raw(
        f"""SELECT *, abs(total_amount - calculated_total) > 0.01 AS total_amount_mismatch
        FROM (SELECT *, {_rounded("quantity * unit_price", 2)} AS calculated_total
              FROM (SELECT order_id, product_id, {_FILLED_NUMBERS} FROM ({_NUMBER_ROWS})))"""
    ),
    "refine": _clean(f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "dim_customer": _clean(f", {_DIM_CUSTOMER} SELECT * FROM dim_customer"),
    "dim_customer_moved": _clean(f", {_DIM_CUSTOMER} SELECT * FROM dim_customer", _MOVED),
    "dim_customer_versions": _clean(
        """SELECT CAST(dense_rank() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT)
          AS customer_sk, customer_id, customer_name, region
        FROM (SELECT DISTINCT customer_id, customer_name, region FROM clean)""",
        _MOVED,
    ),
    "dim_product": _clean(f", {_DIM_PRODUCT} SELECT * FROM dim_product"),
    "dim_date": _clean(f", {_DIM_DATE} SELECT * FROM dim_date"),
    "dim_region": _clean(f", {_DIM_REGION} SELECT * FROM dim_region"),
    "distinct_regions": _clean("SELECT DISTINCT region AS region_name FROM clean"),
    "join_customer_sk": _star("SELECT order_id, product_id, customer_id, customer_sk FROM fact"),
    "join_product_sk": _star("SELECT order_id, product_id, product_sk FROM fact"),
    "join_region_sk": _star("SELECT order_id, product_id, region, region_sk FROM fact"),
    "join_date_sk": _star("SELECT order_id, product_id, order_date, date_sk FROM fact"),
    "build_fact": _star(f"SELECT {_FACT_COLUMNS} FROM fact"),
    "fact_projection": _star(
        "SELECT customer_sk, product_sk, date_sk, region_sk, order_id, product_id, "
        "order_date, status FROM fact"
    ),
    "fact_metrics": _clean(
        f""", {_MEASURES} SELECT order_id, product_id, quantity, unit_price, total_amount,
          revenue, discount_amount, discount_rate, avg_unit_price, is_high_value,
          order_size_bucket, revenue_band FROM measures"""
    ),
    "revenue_by_band": _clean(
        f""", {_MEASURES} SELECT revenue_band, count(*) AS orders,
          CAST(sum(CAST(revenue AS DECIMAL(28,2))) AS DOUBLE) AS total_revenue
        FROM measures GROUP BY revenue_band ORDER BY revenue_band"""
    ),
    "orders_by_month": _clean(_MONTHS),
    "first_24_months": _clean(f"{_MONTHS} LIMIT 24"),
    "check_null_keys": _star(
        """SELECT count(*) FILTER (customer_sk IS NULL OR product_sk IS NULL
          OR date_sk IS NULL OR region_sk IS NULL) AS null_key_rows FROM fact"""
    ),
    "check_amount_mismatch": _clean(
        "SELECT count(*) FILTER (total_amount_mismatch) AS mismatch_rows FROM clean"
    ),
    "quality_summary": _star(
        """SELECT count(*) AS fact_rows,
          count(*) FILTER (customer_sk IS NULL OR product_sk IS NULL
            OR date_sk IS NULL OR region_sk IS NULL) AS null_key_rows,
          count(*) FILTER (customer_sk IS NULL) AS null_customer_sk,
          count(*) FILTER (product_sk IS NULL) AS null_product_sk,
          count(*) FILTER (date_sk IS NULL) AS null_date_sk,
          count(*) FILTER (region_sk IS NULL) AS null_region_sk,
          count(*) FILTER (total_amount_mismatch) AS mismatch_rows,
          count(*) FILTER (is_date_missing) AS missing_date_rows
        FROM fact"""
    ),
    "layer_counts": _clean(
        """SELECT (SELECT count(*) FROM raw) AS raw_rows,
          (SELECT count(*) FROM deduplicated) AS deduplicated_rows,
          (SELECT count(*) FROM clean) AS clean_rows"""
    ),
    "check_orphans": _orphans(),
    "dim_key_conflicts": _clean(
        """SELECT customer_id, count(*) AS versions
        FROM (SELECT DISTINCT customer_id, customer_name, region FROM clean)
        GROUP BY customer_id HAVING count(*) > 1""",
        _MOVED,
    ),
    "check_contract": _contract(),
    "dim_customer_stable": _stable(),
    "quarantine_rejects": _quarantined(),
    "scan_new_files": _raw(f"SELECT *, CAST(CASE WHEN {_EVEN} THEN 1 ELSE 2 END AS BIGINT) AS load FROM raw"),
    "incremental_upsert_version": _latest(),
    "quarter_by_calendar": _star(
        f"""SELECT {_FACT_COLUMNS}, strftime(order_date, '%A') AS day_name FROM fact
        WHERE order_date BETWEEN DATE '1997-04-01' AND DATE '1997-06-30' AND dayofweek(order_date) IN (0, 6)"""
    ),
    "join_customer_bucketed": _star("SELECT order_id, product_id, customer_id, customer_sk FROM fact"),
    "customer_history": _clean(f", {_HISTORY} SELECT * FROM history", _MOVED),
    "fact_as_of": _as_of(),
    "table_fingerprint": _fingerprint(),
    "dim_region_by_table": _clean(
        f""", {_DIM_REGION}, zones AS (
          SELECT CASE n_nationkey % 10 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east'
              WHEN 3 THEN 'west' WHEN 4 THEN 'central' WHEN 5 THEN 'northeast' WHEN 6 THEN 'northwest'
              WHEN 7 THEN 'southeast' WHEN 8 THEN 'southwest' END AS region_name, min(r_name) AS zone
          FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1)
        SELECT region_sk, region_name, region_code, coalesce(zone, 'Unknown Zone') AS geo_zone
        FROM dim_region LEFT JOIN zones USING (region_name)"""
    ),
}
