"""Conflict-constrained best-fit packing.

Documents are put into bins of ``capacity``, the longest first. Bins are kept in order of
what is left in them, and each carries bitmaps of the sources and of the duplicate clusters
that it holds. For a document, the search starts at the tightest bin it fits into and goes
on through the successors until one holds neither its cluster nor its source as often as
``per_source`` allows; if none does, a bin is opened.

A document longer than a bin is cut: its full pieces fill bins of their own, and the rest is
packed as any other. Documents are dealt to shards by a hash of id and cluster, so that a
shard has about ``shard_rows`` of them however common a source or a cluster is, and each
shard packs its own bins. Nothing is dropped: every unit of length is in one bin.

Lengths that are null or 0 take no room but are placed; null sources or clusters are a
source or cluster of their own for each row (they conflict with nothing). Repeated rows are
packed as often as they come. Ties are settled by id, cluster and source, so the result does
not depend on the order of rows. An empty table gives no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.digest_index import normalised

CAPACITY = 16_384
SHARD_ROWS = 4_096
PACKED = "doc_id long, piece int, start long, length long, shard int, bin int, place long"


class Bins:
    """Open bins by residual, with the bitmaps of what they hold."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.sources: list[list[int]] = []  # for each bin, a bitmap for each repetition
        self.clusters: list[int] = []

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and place in it for a document; ``source`` and ``cluster`` are single bits or 0."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, bin = self.order[at]
            if not (self.clusters[bin] & cluster or self.sources[bin][-1] & source):
                del self.order[at]
                break
            at += 1
        else:
            residual, bin = self.capacity, len(self.clusters)
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
        self.clusters[bin] |= cluster
        for level, held in enumerate(self.sources[bin]):
            if not held & source:
                self.sources[bin][level] |= source
                break
        insort(self.order, (residual - size, bin))
        return bin, self.capacity - residual


def pack_shard(rows: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """The bins of one shard: all pieces of its rows, in the order they were placed."""
    rows = rows.sort_values(["length", "doc_id", "cluster", "source"], ascending=[False, True, True, True], na_position="last")
    shard = int(rows["shard"].iloc[0])
    bits: dict[str, dict] = {"source": {}, "cluster": {}}

    def bit(kind: str, value) -> int:
        if pd.isna(value):
            return 0
        known = bits[kind]
        return 1 << known.setdefault(value, len(known))

    bins, packed, rest = Bins(capacity, per_source), [], []
    full = 0
    for doc_id, length, source, cluster in zip(rows["doc_id"], rows["length"], rows["source"], rows["cluster"]):
        pieces, left = divmod(int(length), capacity)
        for piece in range(pieces):
            packed.append((doc_id, piece, piece * capacity, capacity, shard, full, 0))
            full += 1
        if left or not pieces:
            rest.append((left, doc_id, pieces, source, cluster))
    for left, doc_id, piece, source, cluster in sorted(rest, key=lambda x: -x[0]):  # stable
        bin, place = bins.add(left, bit("source", source), bit("cluster", cluster))
        packed.append((doc_id, piece, piece * capacity, left, shard, full + bin, place))
    columns = [x.split()[0] for x in PACKED.split(", ")]
    return pd.DataFrame(packed, columns=columns).astype({"doc_id": "Int64"})


def pack(
    docs: DataFrame,
    length: Column | None = None,
    cluster: Column | None = None,
    source: str = "source",
    capacity: int = CAPACITY,
    per_source: int = 2,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The bin of every piece of every row of ``docs``.

    ``length`` defaults to the bytes of the text, ``cluster`` to a hash of the text without
    differences in white space. Only ids, lengths and hashes leave the scan.
    """
    length = F.coalesce(F.octet_length("text"), F.lit(0)) if length is None else length
    same = F.when(F.length(F.coalesce("text", F.lit(""))) > 0, F.xxhash64(normalised("text")))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        F.xxhash64(F.col(source)).alias("hash_of_source"),
        F.col(source).isNull().alias("no_source"),
        (same if cluster is None else cluster.cast("long")).alias("cluster"),
    ).select("doc_id", "length", F.when(~F.col("no_source"), F.col("hash_of_source")).alias("source"), "cluster")
    shards = max(1, -(-docs.count() // shard_rows))
    dealt = slim.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", F.lit("shard")), F.lit(shards)).cast("int"))
    dealt = dealt.withColumns({"source": F.col("source").cast("string"), "cluster": F.col("cluster").cast("string")})

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(rows, capacity, per_source)

    return dealt.groupBy("shard").applyInPandas(packed, PACKED)
