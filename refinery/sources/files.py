"""Reading and writing the layers as CSV or Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from refinery.schemas import RAW
from refinery.session import CODEC
from refinery.sources.versions import current, read_version

# Padding is data until the text step removes it, and a quote is escaped by doubling it.
_CSV = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


# A text that no layer holds: with it for null, the reader tells "" (blank) from nothing (null).
_NO_TEXT = "\ue000null"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType = RAW,
    multi_line: bool = False,
    corrupt_column: str | None = None,
    pattern: str = "*",
    partitions: int | None = None,
    keep_blanks: bool = False,
    **options: str,
) -> DataFrame:
    """CSV part files of a folder under a fixed schema; nothing is inferred.

    ``multi_line`` admits line breaks inside quotes, but then a file cannot be split:
    keep such input in many files, or name the ``partitions`` its rows are dealt out to
    after reading. ``corrupt_column`` names a column that receives the whole text of
    records with too few or too many fields. ``keep_blanks`` reads a quoted blank, as
    ``write_csv`` writes it, as a blank instead of a null.
    """
    reader = (
        spark.read.options(**_CSV)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("pathGlobFilter", pattern)
        .options(**options)
    )
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        # A record is only known to be broken when all of its fields are parsed.
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.option("columnPruning", False)
    if keep_blanks:
        reader = reader.option("nullValue", _NO_TEXT)
    rows = reader.schema(schema).csv(path if isinstance(path, str) else list(path))
    return rows if partitions is None else rows.repartition(partitions)


def write_csv(
    df: DataFrame, path: str, max_records_per_file: int = 0, append: bool = False, **options: str
) -> None:
    """Replace ``path`` with CSV part files, one per task or smaller, or add to those there.
    Blanks are quoted, nulls are not."""
    (
        df.write.mode("append" if append else "overwrite")
        .options(**_CSV)
        .option("maxRecordsPerFile", max_records_per_file)
        .options(**options)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored layer under its declared schema: the newest version of a versioned path, or
    the plain folder of one that isn't."""
    if version := current(spark, path):
        return read_version(spark, path, schema, version=version)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    only_partitions_present: bool = False,
    max_records_per_file: int = 0,
    sort_by: Sequence[str] = (),
    bloom_filter: Sequence[str] = (),
    watch: Callable[[DataFrame], DataFrame] | None = None,
    dealt: bool = False,
    **options: str,
) -> None:
    """Replace a Parquet table, or only those of its partitions that ``df`` holds.

    Rows are first brought together by partition so that no task writes a file into
    every folder. The rebalance is adaptive: a partition with a third of all rows is
    written by many tasks, and small ones share a task. ``sort_by`` orders the rows of a
    file, so that its row groups hold ranges that don't overlap; ``bloom_filter`` adds
    filters by which a look for single values passes over row groups, also where many files
    hold the same range. ``watch`` sees the rows in the stage that writes them. ``dealt`` says
    that ``df`` has been brought together already.
    """
    if partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    if watch:
        df = watch(df)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    writer = writer.option("compression", CODEC)
    for column in bloom_filter:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer = writer.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if only_partitions_present else "static"
        )
    writer.parquet(path)
