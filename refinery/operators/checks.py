"""Quality checks. Each reads its rows once, and returns counts rather than rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from refinery.operators.cleaning import clean_keys, keep_one_per_key, keys_are_there
from refinery.schemas import BUSINESS_KEY, REQUIRED_KEYS, SURROGATE_KEYS


def any_null(columns: Sequence[str]) -> Column:
    condition = F.lit(False)
    for column in columns:
        condition = condition | F.isnull(column)
    return condition


def check_null_keys(fact: DataFrame) -> DataFrame:
    """Rows lacking a surrogate key; a missing date counts."""
    return fact.agg(F.count_if(any_null(SURROGATE_KEYS)).alias("null_key_rows"))


def check_amount_mismatch(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if("total_amount_mismatch").alias("mismatch_rows"))


def quality_summary(fact: DataFrame) -> DataFrame:
    """Both checks, their parts and the row count from a single scan."""
    return fact.agg(
        F.count("*").alias("fact_rows"),
        F.count_if(any_null(SURROGATE_KEYS)).alias("null_key_rows"),
        *[F.count_if(F.isnull(key)).alias(f"null_{key}") for key in SURROGATE_KEYS],
        F.count_if("total_amount_mismatch").alias("mismatch_rows"),
        F.count_if("is_date_missing").alias("missing_date_rows"),
    )


def layer_counts(raw: DataFrame) -> DataFrame:
    """Rows read, left after deduplication, and left after the key filter.

    Counting the copies of each key gives all three from the shuffle that deduplication
    needs anyway, and stays exact when a lost executor makes tasks run twice.
    """
    rows = clean_keys(raw.select(*REQUIRED_KEYS))
    survivors = keep_one_per_key(rows, BUSINESS_KEY, copies="copies")
    return survivors.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_rows"),
        F.count("*").alias("deduplicated_rows"),
        F.count_if(keys_are_there(REQUIRED_KEYS)).alias("clean_rows"),
    )


def check_orphans(rows: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """One row: per key column, how many rows hold a value its dimension lacks.

    ``keys`` maps a column of ``rows`` to a one-column table of the values allowed; null
    values are the business of the null check. All keys are taken from one scan, as pairs
    of column and value, and counted per pair before the one anti join, so a hot value is
    a single row in that shuffle.
    """
    pair = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in keys]
    held = rows.select(F.explode(F.array(*pair)).alias("pair")).select("pair.*")
    held = held.filter(F.col("value").isNotNull()).groupBy("key", "value").count()
    known = None
    for column, allowed in keys.items():
        named = allowed.toDF("value").select(
            F.lit(column).alias("key"), F.col("value").cast("string")
        )
        known = named if known is None else known.unionByName(named)
    lost = held.join(known, ["key", "value"], "left_anti")
    return lost.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("key") == column, F.col("count"))), F.lit(0))
            .alias(f"orphan_{column}")
            for column in keys
        ]
    )


def loses(kind: DataType, column: Column, cast: Column) -> Column:
    """Whether a cast changes a value of type ``kind``: casting back gives another one.

    Text is left out, as it has many spellings of one value."""
    if isinstance(kind, StringType):
        return F.lit(False)
    back = cast.try_cast(kind)
    return F.coalesce(cast.isNotNull() & ~back.eqNullSafe(column), F.lit(False))


def table_counts(tables: Mapping[str, DataFrame | Sequence[DataFrame]]) -> DataFrame:
    """The number of rows of each table, by name; a table may be given in parts, which are
    counted apart, as only then footers of Parquet files can tell."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, parts in tables.items()
        for df in ([parts] if isinstance(parts, DataFrame) else parts)
    ]
    if len(counts) == len(tables):
        return reduce(DataFrame.unionByName, counts)
    return reduce(DataFrame.unionByName, counts).groupBy("table").agg(F.sum("rows").alias("rows"))


def dim_key_conflicts(clean: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys that appear with more than one set of attributes."""
    versions = clean.select(key, *attributes).distinct().groupBy(key)
    return versions.agg(F.count("*").alias("versions")).filter("versions > 1")


def check_contract(rows: DataFrame, contract: StructType) -> DataFrame:
    """One row per column: is it declared and there, what fails to cast or loses by it,
    what is null."""
    state = {f.name: "declared" if f.name in rows.columns else "missing" for f in contract}
    state |= {c: "undeclared" for c in rows.columns if c not in contract.names}

    def report(column: str) -> Column:
        failures, nulls = F.lit(0).cast("long"), F.count("*")
        if column in rows.columns:
            nulls = F.count_if(F.isnull(column))
        if state[column] == "declared":
            cast = F.col(column).try_cast(contract[column].dataType)
            lost = loses(rows.schema[column].dataType, F.col(column), cast)
            failures = F.count_if((F.isnull(cast) & F.col(column).isNotNull()) | lost)
        return F.struct(
            F.lit(column).alias("column"),
            F.lit(state[column]).alias("state"),
            failures.alias("cast_failures"),
            nulls.alias("nulls"),
        )

    return rows.agg(F.array(*map(report, state)).alias("reports")).select(F.inline("reports"))
