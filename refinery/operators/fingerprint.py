"""A digest of a table's rows that does not depend on their order, taken while it is written
and compared when it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refinery.schemas import FINGERPRINT

#: Hexadecimal digits of a row's md5 that are summed; 15 fit into a signed 64-bit number.
DIGITS = 15


def row_text(columns: Sequence[str]) -> Column:
    """The values of a row as one text: with their lengths, so that no two rows share it;
    ``-`` for null. Numbers and times as Spark writes them."""
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.concat_ws("", *[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def row_number_of(columns: Sequence[str]) -> Column:
    """A row as a whole number: the first digits of its md5."""
    digits = F.substring(F.md5(row_text(columns).cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("decimal(38,0)")


def measures(columns: Sequence[str]) -> list[Column]:
    """Rows, and the sum of their numbers: equal for equal bags of rows, however dealt."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_number_of(columns)), F.lit(0)).cast("decimal(38,0)").alias("digest"),
    ]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``rows`` and ``digest`` of the bag of rows of ``df``."""
    rows, digest = measures(list(columns or df.columns))
    return df.agg(rows, digest).select("rows", F.col("digest").cast("string").alias("digest"))


def observed(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df`` with its fingerprint taken along by the job that writes it.

    Only for the last stage of a job: Spark adds up what the tasks of a last stage have seen
    once per task, but may count a task of an earlier stage again when its output was lost.
    """
    seen = Observation()
    return df.observe(seen, *measures(columns)), seen


def as_table(spark: SparkSession, seen: Observation) -> DataFrame:
    found = seen.get
    return spark.createDataFrame([(int(found["rows"]), str(found["digest"]))], FINGERPRINT)

