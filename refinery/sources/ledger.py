"""Loading each file of a growing folder once.

The ledger lists the files that a table was loaded from, by path and time of modification. It
is a table of the same version as the rows: both are there or neither is, so that a load that
fails is repeated whole, and one that succeeded is not repeated.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from refinery.schemas import FILES_READ, LONG, RAW
from refinery.session import materialize, temporary
from refinery.sources import versions
from refinery.sources.files import read_csv

LEDGER = "ledger"
#: Raw records with the number of the load that brought them.
LOADED = StructType([*RAW.fields, StructField("load", LONG)])


def unread_files(
    spark: SparkSession, source: str, path: str, pattern: str = "*", version: versions.Version | None = None
) -> DataFrame:
    """The files in ``source`` that the ledger of ``path`` lacks: new ones, and those that have
    been written anew since. Listed only, not read.

    The time is that of the listing. A file that changes while it is read is in the ledger
    with its earlier time, and so is read again by the next load.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source)
    listed = listed.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    known = versions.read_version(spark, path, FILES_READ, LEDGER, version)
    return listed.join(known.select("path", "modified"), ["path", "modified"], "left_anti").select(*FILES_READ.names)


def paths_of(files: DataFrame) -> list[str]:
    """The paths, as a reader takes them: signs that a pattern would expand are escaped."""
    return sorted(re.sub(r"([\\*?\[\]{}])", r"\\\1", r["path"]) for r in files.select("path").collect())


def ingest(
    spark: SparkSession,
    source: str,
    path: str,
    pattern: str = "*",
    read: Callable[[SparkSession, Sequence[str]], DataFrame] = read_csv,
) -> DataFrame:
    """Append the records of the files not yet read to the versioned table at ``path``, with
    the number of the load; returns the table. Without such files nothing is written."""

    def load(base: versions.Version, folder: str) -> versions.Tables | None:
        files = materialize(unread_files(spark, source, path, pattern, base), "files")
        if not (paths := paths_of(files)):
            return None
        rows = read(spark, paths).select(*RAW.names, F.lit(base.number + 1).cast("long").alias("load"))
        return {
            **base.tables,
            versions.MAIN: versions.appended(spark, path, base, folder, rows),
            LEDGER: versions.appended(spark, path, base, folder, files, LEDGER),
        }

    with temporary(spark):
        version = versions.change(spark, path, load)
    return versions.read_version(spark, path, LOADED, version=version)
