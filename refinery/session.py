"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Dates must not depend on the driver's zone; malformed text must surface, so ANSI
# stays on; AQE sizes, splits and coalesces the shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Up to so many values are looked for in row groups one by one, and not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}

#: How stored order tables are compressed: about a quarter smaller than Spark's default, for a little
#: more time.
CODEC = "zstd"

_local_root: str | None = None

# The scratch folders of the innermost ``temporary`` block.
_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


def open_session(
    app: str = "refinery", shuffle_partitions: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above; ``conf`` (dots as ``__``) overrides them.

    ``shuffle_partitions`` is the number of pieces that shuffles start with. AQE merges
    small pieces but does not split those of an aggregation, so name a high number: the
    bytes of the raw input over 200 MB, or more.
    """
    builder = SparkSession.builder.appName(app)
    overrides = {k.replace("__", "."): v for k, v in conf.items()}
    if shuffle_partitions:
        overrides["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def counting_session(spark: SparkSession) -> SparkSession:
    """A session over the same context whose tables are counted from the footers of their
    Parquet files: no rows are read. For counts, least and greatest values alone; a table
    has to be read through this session."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or else what
    ``setCheckpointDir`` was told.

    Only a local session, where driver and executors share one disk, may fall back
    to a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    told = getattr(spark.sparkContext, "getCheckpointDir", lambda: None)()
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="refinery-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    if (kept := _kept.get()) is not None:
        kept.append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside this block when it ends.

    For work that stores its result elsewhere before it ends. Threads take part if they
    run in a copy of the context. Spark drops the shuffle files of such work when the driver
    collects its garbage, so that is asked for.
    """
    paths: list[str] = []
    mark = _kept.set(paths)
    try:
        yield
    finally:
        _kept.reset(mark)
        for path in paths:
            delete(spark, path)
        spark._jvm.System.gc()


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    system, at = file_system(spark, path)
    system.delete(at, True)


def materialize(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the stored table.

    Cuts the lineage, so a lost executor costs a file read instead of the upstream
    shuffles; later consumers read only their columns; and the planner sees the real
    size, which is what lets it pick a broadcast join safely. ``codec`` stands in for the
    session's compression.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, label: str) -> DataFrame:
    """``materialize`` with the compression of stored order tables."""
    return materialize(df, label, CODEC)
