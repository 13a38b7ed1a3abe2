"""Dirty raw orders derived from the generated order, line, customer and part tables.

The rules live in one SQL text that Spark (with the joins in another order) and DuckDB both run, so a check compares the
operators and not two spellings of the input. Numbers become text through decimals,
never through doubles, which the engines print differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refinery.schemas import RAW

TABLES = ["lineitem", "orders", "customer", "nation", "part"]

RAW_ORDERS_SQL = """
WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM {lineitem}
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM {lineitem}
  WHERE l_orderkey % 101 = 0
),
joined AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, o_custkey AS ck,
         c_name, p_name, p_type,
         lpad(CAST(year(o_orderdate) AS STRING), 4, '0') AS yy,
         lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS mm,
         lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS dd,
         CAST(CASE WHEN p_partkey % 50 = 0 THEN CAST(p_retailprice AS DECIMAL(12,2))
                   ELSE CAST(p_size AS DECIMAL(12,2)) + CAST(0.99 AS DECIMAL(12,2)) END
              AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS DECIMAL(6,0)) AS qty,
         CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)) AS kept,
         CASE n_nationkey % 10
           WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'West'
           WHEN 4 THEN 'Central' WHEN 5 THEN 'Northeast' WHEN 6 THEN 'Northwest'
           WHEN 7 THEN 'Southeast' WHEN 8 THEN 'Southwest' ELSE 'Overseas' END AS reg,
         CASE n_nationkey % 10
           WHEN 9 THEN 'North' WHEN 0 THEN 'South' WHEN 1 THEN 'East' WHEN 2 THEN 'West'
           WHEN 3 THEN 'Central' WHEN 4 THEN 'Northeast' WHEN 5 THEN 'Northwest'
           WHEN 6 THEN 'Southeast' WHEN 7 THEN 'Southwest' ELSE 'Overseas' END AS next_reg,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                            ELSE 'shipped' END AS st
  FROM lines
  JOIN {orders} ON o_orderkey = l_orderkey
  JOIN {customer} ON c_custkey = o_custkey
  JOIN {nation} ON n_nationkey = c_nationkey
  JOIN {part} ON p_partkey = l_partkey
),
placed AS (
  SELECT *, {region_rule} AS place FROM joined
)
SELECT
  'ORD' || lpad(CAST(ok AS STRING), 8, '0') AS order_id,
  CASE WHEN ck % 20 = 0 THEN NULL
       ELSE 'CUST' || lpad(CAST(ck AS STRING), 7, '0') END AS customer_id,
  CASE WHEN ck % 31 = 0 THEN c_name || ' JosÃ©'
       WHEN ck % 37 = 0 THEN c_name || ' Oâ€™Neil'
       WHEN ln % 3 = 0 THEN '  ' || c_name || '  '
       ELSE c_name END AS customer_name,
  'PROD' || lpad(CAST(pk AS STRING), 7, '0') AS product_id,
  CASE WHEN ln % 2 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS product_name,
  CASE WHEN pk % 41 = 0 THEN NULL
       WHEN ln % 3 = 0 THEN lower(p_type)
       WHEN ln % 3 = 1 THEN '  ' || p_type || '  '
       ELSE p_type END AS category,
  CASE WHEN ok % 13 = 0 THEN NULL
       WHEN ok % 89 = 0 THEN 'n/a'
       ELSE CAST(CAST(qty AS INT) AS STRING) END AS quantity,
  CAST(price AS STRING) AS unit_price,
  CASE WHEN ok % 13 = 0 THEN NULL
       ELSE CAST(CAST(qty * price * kept AS DECIMAL(14,2)) AS STRING) END AS total_amount,
  CASE WHEN ok % 53 = 0 THEN NULL
       WHEN ok % 59 = 0 THEN 'not a date'
       WHEN ok % 4 = 0 THEN yy || '-' || mm || '-' || dd
       WHEN ok % 4 = 1 THEN dd || '-' || mm || '-' || yy
       WHEN ok % 4 = 2 THEN mm || '/' || dd || '/' || yy
       ELSE ' ' || dd || '/' || mm || '/' || yy END AS order_date,
  CASE ln % 3 WHEN 0 THEN upper(place) WHEN 1 THEN place ELSE lower(place) END AS region,
  CASE WHEN ln % 4 = 0 THEN '  ' || upper(st) || '  ' ELSE st END AS status
FROM placed
"""

# Rows as above with what the generated tables lack: keys padded in one of two copies, blank
# attributes, line breaks, and broken encodings in every text column.
ROUGH_SQL = """
WITH even AS ({raw})
SELECT
  CASE WHEN right(order_id, 1) = '4' THEN '  ' || order_id ELSE order_id END AS order_id,
  CASE WHEN right(order_id, 1) = '6' THEN customer_id || '  ' ELSE customer_id END AS customer_id,
  CASE WHEN right(order_id, 1) = '3' THEN ''
       WHEN right(order_id, 1) = '5' THEN customer_name || chr(10) || '"Ltd"'
       ELSE customer_name END AS customer_name,
  product_id,
  CASE WHEN right(order_id, 1) = '2' THEN '   ' ELSE product_name END AS product_name,
  CASE WHEN right(order_id, 1) = '7' THEN ' CafÃ© ' || category ELSE category END AS category,
  quantity, unit_price, total_amount, order_date,
  CASE WHEN right(order_id, 1) = '8' THEN region || 'â€™s' ELSE region END AS region,
  CASE WHEN right(order_id, 1) = '9' THEN '' ELSE status END AS status
FROM even
UNION ALL
SELECT order_id || ' ', customer_id, customer_name, ' ' || product_id, product_name, category,
       quantity, unit_price, total_amount, order_date, region, status
FROM even WHERE right(order_id, 2) = '21'
"""

# A customer normally stays in one region; the moved variant makes ids conflict.
REGION_RULES = {
    "settled": "reg",
    "moved": "CASE WHEN ok % 97 = 0 THEN next_reg ELSE reg END",
}


# The joins of the text, and the same in an order by which Spark moves fewer bytes: a customer
# is found for each order and not for each of its lines, and the lines of an order end up side
# by side, so that later moves compress what they share.
_JOINS = """  FROM lines
  JOIN {orders} ON o_orderkey = l_orderkey
  JOIN {customer} ON c_custkey = o_custkey
  JOIN {nation} ON n_nationkey = c_nationkey
  JOIN {part} ON p_partkey = l_partkey
"""
_BY_ORDER = """  FROM lines
  JOIN {part} ON p_partkey = l_partkey
  JOIN (SELECT * FROM {orders}
        JOIN {customer} ON c_custkey = o_custkey
        JOIN {nation} ON n_nationkey = c_nationkey) ON o_orderkey = l_orderkey
"""


def raw_orders_sql(variant: str = "settled", **tables: str) -> str:
    """The text, over the tables' own names or those given."""
    names = {table: tables.get(table, table) for table in TABLES}
    rule = REGION_RULES.get(variant, REGION_RULES["settled"])
    text = RAW_ORDERS_SQL.format(region_rule=rule, **names)
    return ROUGH_SQL.replace("{raw}", text) if variant == "rough" else text


def raw_orders(
    spark: SparkSession, folder: str, variant: str = "settled", partitions: int | None = None
) -> DataFrame:
    """``partitions``, or else the session's ``refinery.rawPartitions``, deals the order lines
    out first, for a table of one large row group. Without either nothing is moved."""
    partitions = partitions or int(spark.conf.get("refinery.rawPartitions", "0"))
    tables = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in TABLES}
    used = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount"]
    tables["lineitem"] = tables["lineitem"].select(*used)
    if partitions:
        tables["lineitem"] = tables["lineitem"].repartition(partitions)
    text = raw_orders_sql(variant, **{name: "{" + name + "}" for name in TABLES})
    text = text.replace(_JOINS, _BY_ORDER)
    return spark.sql(text, **tables).select(*RAW.names)
