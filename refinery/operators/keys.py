"""Surrogate keys without a single-task sort: numbered anew in every run, or kept for good."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from refinery.session import CODEC, materialize, scratch_path, temporary
from refinery.sources import versions

# monotonically_increasing_id() keeps the position within the task below this bit.
_POSITION_BITS = 33


def dense_key(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Number the rows 1, 2, ... by ``key`` ascending, nulls first; one row per key.

    Equals a global dense rank. The rows are range-partitioned and sorted by key, so
    a row's key is its position in its task plus the sizes of the tasks before it. The
    (task, position) address is only meaningful in the run that produced it, so it is
    written down first and read back. The driver sees one number per task.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    (
        rows.repartitionByRange(F.asc_nulls_first(key))
        .sortWithinPartitions(F.asc_nulls_first(key))
        .withColumn("_address", F.monotonically_increasing_id())
        .write.parquet(path, compression=CODEC)
    )
    schema = StructType([*rows.schema.fields, StructField("_address", LongType())])
    stored = spark.read.schema(schema).parquet(path)
    task = F.shiftright("_address", _POSITION_BITS).cast("int")
    position = F.col("_address").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    sizes = dict(stored.groupBy(task.alias("task")).count().collect())
    before, offsets = 0, []
    for number in range(max(sizes, default=-1) + 1):
        offsets.append(before)
        before += sizes.get(number, 0)
    starts = F.lit(offsets or [0]).cast("array<bigint>")
    return stored.withColumn(name, F.get(starts, task) + position + 1).drop("_address")


def dense_key_of_versions(rows: DataFrame, key: str, name: str) -> DataFrame:
    """As ``dense_key`` where a key may have several rows, which then share its number."""
    numbered = dense_key(rows.select(F.col(key).alias("_key")).distinct(), "_key", name)
    return rows.join(numbered, rows[key].eqNullSafe(numbered["_key"])).drop("_key")


def stable_key(rows: DataFrame, key: str, name: str, registry: str) -> DataFrame:
    """``rows`` with the number that ``key`` has in the registry at path ``registry``.

    Ids that the registry lacks are numbered after its highest number, in their order, and
    added to it; numbers are never changed or used again, also not those of ids that have
    vanished. On an empty registry this equals a dense rank. The registry is a versioned
    table of one row per id: a load that fails leaves it whole, and of two loads at once the
    later one numbers what the other has left.
    """
    spark = rows.sparkSession
    schema = StructType([StructField(key, rows.schema[key].dataType), StructField(name, LongType())])

    def add(base: versions.Version, folder: str) -> versions.Tables | None:
        known = versions.read_version(spark, registry, schema, version=base)
        named = known.select(F.col(key).alias("_key"), F.lit(True).alias("_known"))
        fresh = ids.join(named, F.col(key).eqNullSafe(F.col("_key")), "left_anti").select(key)
        fresh = materialize(fresh, "fresh")
        if fresh.isEmpty():
            return None
        highest = known.agg(F.max(name)).first()[0] or 0
        numbered = dense_key(fresh, key, name).withColumn(name, F.col(name) + F.lit(highest))
        folders = versions.appended(spark, registry, base, folder, numbered.select(*schema.names))
        return {**base.tables, versions.MAIN: folders}

    with temporary(spark):
        ids = materialize(rows.select(key).distinct(), "ids")
        version = versions.change(spark, registry, add)
    numbers = versions.read_version(spark, registry, schema, version=version)
    numbers = numbers.select(F.col(key).alias("_key"), name)
    return rows.join(numbers, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
