"""Exact deduplication against a persistent digest index.

The index is a table of one row per different text (``digest``, ``keep_id``), bucketed and
sorted by the digest. A batch is reduced to its different digests, those the index lacks are
found by a sort-merge anti join that reads the index without a shuffle, and they are
appended. The index outlives the session: it is read again from its folder. A whole table is
added in several loads by ascending id, so that later ones meet a filled index.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became one
space; their SHA-256 stands for them. A null text is empty. Of equal texts that of the
smallest id stays, or that of the earlier batch; a null id is larger than all others, and
stays only where its text has no other. Rows of equal text *and* id are copies of one
document: ``decide`` marks them alike, ``drop_copies`` leaves one, by a hash of its columns. An
empty batch changes nothing. Other columns may have any name: the working columns live in a table of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.common import shuffle_partitions
from refinery.session import delete, file_system, materialize, scratch_path

SETTINGS = "settings"  # the folder that says how many buckets the index has
#: Sorted files per bucket beyond which the index is merged. With one, a join always finds it
#: in order; more spare rewriting it with every load and cost a sort of it instead.
MOST_FILES = 1
LOADS = 3  # loads that a whole table is deduplicated in


def normalised(text: str) -> Column:
    """The text with runs of white space as one space; only runs that change are replaced."""
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), runs, " ")


def text_digest(text: str) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """The index in folder ``path``; made there if the folder holds none.

    The bucketed files lie in numbered folders below ``path``, of which the highest that is
    whole counts. Each addition leaves one more sorted file per bucket; beyond ``most_files``
    of them ``add`` merges the index into a new folder, one sorted file per bucket, so that
    the next join finds it in order. One job adds to an index at a time. The catalog knows the index only while one is added to:
    nothing is left there.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, most_files: int | None = None):
        self.spark, self.path, self.most_files = spark, path, most_files or MOST_FILES
        system, at = file_system(spark, f"{path}/{SETTINGS}")
        if system.exists(at):  # the number of buckets is that of the files
            self.buckets = spark.read.schema("buckets int").parquet(f"{path}/{SETTINGS}").first()[0]
        else:
            self.buckets = buckets or shuffle_partitions(spark)
            spark.createDataFrame([(self.buckets,)], "buckets int").write.parquet(f"{path}/{SETTINGS}")

    def generation(self) -> int:
        """The number of the folder that counts: the highest whole one, or 0 of a new index."""
        system, at = file_system(self.spark, self.path)
        names = [s.getPath().getName() for s in system.listStatus(at)]
        whole = [int(n[1:]) for n in names if n.startswith("g") and n[1:].isdigit() and self.files(int(n[1:]), "_SUCCESS")]
        return max(whole, default=0)

    def folder(self, generation: int | None = None) -> str:
        return f"{self.path}/g{self.generation() if generation is None else generation}"

    def files(self, generation: int, pattern: str = "part-*") -> int:
        system, at = file_system(self.spark, f"{self.folder(generation)}/{pattern}")
        return len(system.globStatus(at) or [])

    @contextmanager
    def declared(self, generation: int | None = None) -> Iterator[str]:
        """The name of a catalog table over the files, which goes when the block ends; the
        files stay, as those of any table with a place of its own."""
        name = f"digests_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.folder(generation)}'"
        )
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def add(self, groups: DataFrame) -> None:
        """Append the digests of ``groups`` (digest, keep_id; one row each) that are new."""
        with self.declared() as name, self.in_order():
            self.write(self.unknown(groups, name), name)
        if self.files(self.generation()) > self.most_files * self.buckets:
            self.compact()

    def unknown(self, groups: DataFrame, name: str) -> DataFrame:
        """The sort-merge anti join: the side of the index is read as it lies, bucket by bucket."""
        return groups.join(self.spark.table(name).hint("merge"), "digest", "left_anti")

    def write(self, rows: DataFrame, name: str) -> None:
        """Each bucket is written by one task, as one sorted file."""
        rows.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(name)

    @contextmanager
    def in_order(self) -> Iterator[None]:
        """While this block runs, Spark reads a table of buckets a bucket a task, and relies
        on the order of buckets that are one file."""
        settings = {
            "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
            "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        }
        before = {key: self.spark.conf.get(key) for key in settings}
        for key, value in settings.items():
            self.spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                self.spark.conf.set(key, value)

    def compact(self) -> None:
        """Merge the files of each bucket into one, in the next folder; the old one goes last."""
        at = self.generation()
        delete(self.spark, self.folder(at + 1))  # what a lost compaction has left
        with self.declared(at) as old, self.declared(at + 1) as new, self.in_order():
            self.write(self.spark.table(old), new)
        delete(self.spark, self.folder(at))

    def rows(self) -> DataFrame:
        """The index as plain files: unlike buckets, their reader takes part in the splitting
        of hot keys in a join."""
        return self.spark.read.schema("digest binary, keep_id long").parquet(self.folder())


def batch_groups(digests: DataFrame) -> DataFrame:
    """One row per digest: smallest id and number of rows, summed in each task first."""
    return digests.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def decide(
    index: DigestIndex, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", loads: int = 1
) -> DataFrame:
    """Deduplicate ``docs`` against ``index``, and append what is new to it.

    ``loads`` deals the rows out to so many loads, by ascending ranges of their id: each is
    joined with what the loads before it have left in the index, as the deliveries of a
    growing corpus are. The result is that of one load. Texts are read once.

    One row per row of ``docs``: doc_id, keep_id (the document that stays), group_size (rows
    of the batch with this text), kept, text_sha256. Both inputs of the last join are shuffled
    by digest as plain rows, so a digest with a third of all rows is split over many tasks.
    """
    digests = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_digest(text).alias("digest"))
    digests = materialize(digests, "digests")
    seen = [batch_groups(part) for part in in_ranges(digests, loads)]
    sizes = None
    for number, groups in enumerate(seen):
        groups = materialize(groups, f"digest-groups-{number}")
        index.add(groups)
        own = groups.select("digest", "group_size")
        sizes = own if sizes is None else sizes.unionByName(own)
    if loads > 1:
        sizes = sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size"))
    settled = materialize(sizes.join(index.rows(), "digest"), "digest-settled")
    return digests.join(settled, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def in_ranges(digests: DataFrame, loads: int) -> list[DataFrame]:
    """The rows in ``loads`` parts by ascending id, of about equal size; null ids in the last."""
    if loads == 1:
        return [digests]
    shares = [i / loads for i in range(1, loads)]
    found = digests.agg(F.percentile_approx("doc_id", shares, 1000).alias("cuts")).first()["cuts"]
    cuts = sorted(set(found or []))
    parts, above = [], F.lit(True)
    for cut in cuts:
        parts.append(digests.filter(above & (F.col("doc_id") <= cut)))
        above = F.col("doc_id") > cut
    return [*parts, digests.filter(above | F.col("doc_id").isNull())]


def fresh_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, scratch_path(spark, "digest-index"))


def exact_report(docs: DataFrame, index: DigestIndex | None = None, loads: int = LOADS) -> DataFrame:
    """``decide`` for all of ``docs``, in ``loads`` loads, against ``index`` or a new one."""
    return decide(index or fresh_index(docs.sparkSession), docs, loads=loads)


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, loads: int = LOADS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns; of copies of one document that
    with the least hash of all its columns."""
    stays = exact_report(docs, index, loads).filter("kept").select("doc_id", "text_sha256").distinct()
    stays = materialize(stays.select(F.struct("doc_id", "text_sha256").alias("stay")), "stays")
    names = [F.col(f"`{x}`") for x in docs.columns]
    # Maps have no hash of their own.
    hashed = [F.to_json(c) if "map<" in kind else c for c, (_, kind) in zip(names, docs.dtypes)]
    keyed = docs.select(
        F.struct(*names).alias("row"),
        F.xxhash64(*hashed).alias("rank"),
        F.struct(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.lower(F.hex(text_digest("text"))).alias("text_sha256"),
        ).alias("key"),
    )
    joined = keyed.join(stays, F.col("key") == F.col("stay"), "left_semi")
    return joined.groupBy("key").agg(F.min_by("row", "rank").alias("row")).select("row.*")


ORACLE = r"""
WITH marked AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM marked
"""
