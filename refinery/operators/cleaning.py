"""Row cleaning: duplicates, text, dates, numbers, missing values and flags."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from refinery.functions import dates, metrics, numbers, text
from refinery.operators.in_place import IN_PLACE_ROWS, addressed, bits_of, chosen
from refinery.schemas import BUSINESS_KEY, REQUIRED_KEYS
from refinery.session import materialize

# What stands in for a missing value. Dates are flagged, never filled.
DEFAULTS = {
    "customer_name": "unknown",
    "product_name": "unknown",
    "category": "uncategorized",
    "region": "unknown",
    "status": "unknown",
    "quantity": 0,
    "unit_price": 0.0,
    "total_amount": 0.0,
}

#: Keys with several rows up to which ``keep_one_per_stored_key`` names them to every task: as
#: hashes, about 64 bytes each.
REPEATED_KEYS = 3_000_000


def drop_copies(rows: DataFrame) -> DataFrame:
    """One of each set of fully equal rows."""
    return rows.dropDuplicates()


def clean_keys(rows: DataFrame, keys: Sequence[str] = tuple(BUSINESS_KEY)) -> DataFrame:
    """The keys as the text step will leave them, so that padding does not tell keys apart."""
    return rows.withColumns({key: text.trimmed(key) for key in keys})


def keep_one_per_key(
    rows: DataFrame,
    keys: Sequence[str] = tuple(BUSINESS_KEY),
    copies: str | None = None,
    latest_by: str | None = None,
) -> DataFrame:
    """One row per key: the first by all other columns, ascending, missing ones last.
    With ``latest_by``, a time, the latest comes before all that.

    The choice does not depend on the order or partitioning of the input, and a row with
    a customer beats one without. A minimum merges before the shuffle, so a key holding
    a large share of all rows leaves each map task as one row. Exact copies collapse on
    the way, so no separate pass for them is needed. ``copies`` names a column that
    receives the number of rows behind each survivor.
    """
    others = [c for c in rows.columns if c not in keys]
    ranked = [part for c in others for part in (_is_missing(rows, c).alias(f"no_{c}"), F.col(c))]
    if latest_by:
        latest = -F.unix_micros(F.col(latest_by).cast("timestamp"))
        ranked = [F.isnull(latest_by).alias("_undated"), latest.alias("_age"), *ranked]
    found = [F.min(F.struct(*ranked)).alias("_least")]
    if copies:
        found.append(F.count("*").alias(copies))
    survivors = rows.groupBy(*keys).agg(*found)
    columns = [F.col(c) if c in keys else F.col(f"_least.{c}").alias(c) for c in rows.columns]
    return survivors.select(*columns, *([copies] if copies else []))


def keep_one_per_stored_key(rows: DataFrame, keys: Sequence[str] = tuple(BUSINESS_KEY)) -> DataFrame:
    """The same rows as ``keep_one_per_key``, from a stored table, which is read three times.

    Hashes of the keys are counted first. A row whose hash occurs once is alone with its key
    and stays where it is; the others, by hash a few too many, are moved and compared. The
    repeated hashes are sent to all tasks, up to ``REPEATED_KEYS`` of them; where there are
    more, the addresses of their rows are, for up to ``IN_PLACE_ROWS`` rows. Beyond that all
    rows are moved.
    """
    marked = rows.withColumn("_mark", F.xxhash64(*keys))
    marks = marked.groupBy("_mark").agg(F.count("*").alias("_rows"))
    repeated = materialize(marks.filter("_rows > 1").select("_mark"), "repeated")
    if repeated.count() > REPEATED_KEYS:
        if rows.count() > IN_PLACE_ROWS:
            return keep_one_per_key(rows, keys)
        found = addressed(marked).select("_mark", "_file", "_row").join(repeated, "_mark", "left_semi")
        bits = bits_of(found)
        return chosen(rows, bits, keep=False).unionByName(keep_one_per_key(chosen(rows, bits), keys))
    repeated = F.broadcast(repeated)
    alone = marked.join(repeated, "_mark", "left_anti").drop("_mark")
    several = marked.join(repeated, "_mark", "left_semi").drop("_mark")
    return alone.unionByName(keep_one_per_key(several, keys))


def _is_missing(rows: DataFrame, column: str) -> Column:
    if isinstance(rows.schema[column].dataType, StringType):
        return F.coalesce(F.trim(column) == "", F.lit(True))
    return F.isnull(column)


def clean_text(rows: DataFrame) -> DataFrame:
    """Trim every text column, lower-case the categorical ones, repair encodings."""
    return rows.withColumns(
        {c: text.trimmed_lower(c) for c in text.LOWERED_COLUMNS}
        | {c: text.trimmed(c) for c in text.TRIMMED_COLUMNS}
    )


def parse_dates(rows: DataFrame, day_first: bool = False) -> DataFrame:
    """Keep the date as written, unify its text and parse it."""
    renamed = rows.withColumnRenamed("order_date", "order_date_raw")
    unified = renamed.withColumn("order_date_clean", dates.unify_date_text("order_date_raw"))
    split = unified.withColumn("_parts", dates.date_parts("order_date_clean"))
    parsed = split.withColumn("order_date", dates.date_from_parts(F.col("_parts"), day_first))
    return parsed.drop("_parts")


def cast_numbers(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "quantity": numbers.parse_int("quantity"),
            "unit_price": numbers.parse_double("unit_price"),
            "total_amount": numbers.parse_double("total_amount"),
        }
    )


def require_keys(
    rows: DataFrame,
    keys: Sequence[str] = tuple(REQUIRED_KEYS),
    blank_is_missing: bool = True,
) -> DataFrame:
    """Rows whose keys are all there; a blank key counts as missing unless told not to.

    Blank is a text of nothing but what cleaning takes away. So the filter may stand
    before or after the text step, and before it is cheaper.
    """
    return rows.filter(keys_are_there(keys, blank_is_missing))


def keys_are_there(keys: Sequence[str], blank_is_missing: bool = True) -> Column:
    there = F.lit(True)
    for key in keys:
        there &= F.trim(key, F.lit(" \x00")) != "" if blank_is_missing else F.isnotnull(key)
    return there


def fill_defaults(rows: DataFrame) -> DataFrame:
    return rows.fillna(DEFAULTS)


def flag_missing_dates(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_date_missing", F.isnull("order_date"))


def flag_amount_mismatch(rows: DataFrame) -> DataFrame:
    """Recompute the line total and flag rows whose stated total differs."""
    totalled = rows.withColumn("calculated_total", metrics.line_total())
    return totalled.withColumn("total_amount_mismatch", metrics.amount_mismatch())


def add_order_period(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )


def stamp(rows: DataFrame, column: str, run_at: datetime | None) -> DataFrame:
    """One timestamp for the whole run; given as a value, a re-run task cannot shift it."""
    at = F.lit(run_at) if run_at else F.current_timestamp()
    return rows.withColumn(column, at.cast("timestamp"))
