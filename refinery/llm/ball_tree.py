"""Exact top-k inner products by ball trees, with branch and bound.

Candidates are dealt to shards by a hash of their id, and each shard becomes a ball tree.
Queries are dealt to blocks in the same way. A task takes the trees of several shards, one
after the other, through one block of queries: of two children that is visited first which
has the higher upper bound (query times centre, plus length of the query times radius), only
for the queries whose kth score doesn't rule it out, and the kth scores reached so far pass
on from leaf to leaf and from tree to tree. Each task yields k rows for each of its queries;
the best k of those are the result.

Components become floor(64 * x), so scores are whole numbers and ties are exact; ties go to
the smaller id. Vectors that are null or hold null or non-finite components, and rows without
an id, take no part. Rows that share an id are each a candidate, but not for one another; a
query id with several rows has the best of the pairs of all of them, one row per pair. Only
vectors of equal length are compared. Fewer than k candidates give fewer rows; an empty table
gives none. Other columns may have any name. Scores have to fit into 64 bits.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refinery.llm.common import shuffle_partitions
from refinery.session import materialize

K = 20
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8_192, 2_048, 128
CHAIN = 4  # shards that one task takes through a block of queries
LOWEST = np.iinfo(np.int64).min


class BallTree:
    """A ball tree over the rows of ``vectors`` (whole numbers) with their ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.order = np.arange(len(ids))
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self.grow(vectors.astype(np.float64), 0, len(ids))
        self.ids, self.vectors = ids[self.order], vectors[self.order]

    def grow(self, points: np.ndarray, start: int, stop: int) -> int:
        own = points[self.order[start:stop]]
        centre = own.mean(axis=0)
        away = np.sqrt(((own - centre) ** 2).sum(axis=1))
        node = len(self.radii)
        self.centres.append(centre)
        self.radii.append(float(away.max()))
        self.spans.append((start, stop))
        self.children.append(None)
        if stop - start > LEAF_ROWS and away.max() > 0:
            one = own[away.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = np.argsort(own @ (other - one), kind="stable")
            self.order[start:stop] = self.order[start:stop][along]
            middle = (start + stop) // 2
            self.children[node] = (self.grow(points, start, middle), self.grow(points, middle, stop))
        return node


class TopK:
    """The best k candidates so far of a block of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.floats = vectors.astype(np.float64)
        self.lengths = np.sqrt((self.floats**2).sum(axis=1))
        self.scores = np.full((len(ids), k), LOWEST)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def products(self, rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Exact products: in floating point where all sums stay below 2^53."""
        mine = self.vectors[rows]
        theirs = vectors.T.astype(np.float64)
        most = float(np.abs(self.floats[rows]).max(initial=0)) * float(np.abs(theirs).max(initial=0)) * max(1, len(theirs))
        if most < 2**53:
            return (self.floats[rows] @ theirs).astype(np.int64)
        return mine.astype(np.int64) @ vectors.T.astype(np.int64)

    def bound(self, rows: np.ndarray, tree: BallTree, node: int) -> np.ndarray:
        reach = self.lengths[rows] * tree.radii[node]
        high = self.floats[rows] @ tree.centres[node] + reach
        return high + 1e-9 * (np.abs(high) + reach) + 1e-6  # above any error of rounding

    def search(self, tree: BallTree, node: int = 0, rows: np.ndarray | None = None) -> None:
        rows = np.arange(len(self.ids)) if rows is None else rows
        rows = rows[self.bound(rows, tree, node) >= self.scores[rows, -1]]
        if not len(rows):
            return
        pair = tree.children[node]
        if pair is None:
            self.take(rows, *tree.spans[node], tree)
            return
        left, right = self.bound(rows, tree, pair[0]), self.bound(rows, tree, pair[1])
        nearer = left >= right
        self.search(tree, pair[0], rows[nearer])
        self.search(tree, pair[1], rows)
        self.search(tree, pair[0], rows[~nearer])

    def take(self, rows: np.ndarray, start: int, stop: int, tree: BallTree) -> None:
        new = self.products(rows, tree.vectors[start:stop])
        ids = np.broadcast_to(tree.ids[start:stop], new.shape)
        new = np.where(ids == self.ids[rows, None], LOWEST, new)
        better = (new >= self.scores[rows, -1:]).any(axis=1)
        rows, new, ids = rows[better], new[better], ids[better]
        if not len(rows):
            return
        ids = np.where(new == LOWEST, np.iinfo(np.int64).max, ids)
        scores, found = np.hstack([self.scores[rows], new]), np.hstack([self.found[rows], ids])
        best = np.lexsort((found, ~scores), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, best, axis=1)
        self.found[rows] = np.take_along_axis(found, best, axis=1)

    def rows(self) -> pd.DataFrame:
        real = self.found.ravel() != np.iinfo(np.int64).max
        columns = {"query_id": np.repeat(self.ids, self.k), "vec_id": self.found.ravel(), "score": self.scores.ravel()}
        return pd.DataFrame({name: x[real] for name, x in columns.items()})


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """id and components of the vectors that take part, as whole numbers."""
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("x"))
    own = own.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
    return own.select("id", F.transform("x", lambda x: F.floor(x.cast("double") * 64)).alias("x"), F.size("x").alias("dim"))


def arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors, in the narrowest type that holds them."""
    pairs = sorted((int(i), tuple(x)) for i, x in zip(rows["id"], rows["x"]))
    ids = np.array([i for i, _ in pairs], dtype=np.int64)
    vectors = np.array([x for _, x in pairs], dtype=np.int64).reshape(len(ids), -1)
    most = int(max(vectors.max(initial=0), ~vectors.min(initial=0)))
    return ids, vectors.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def packed(rows: DataFrame, count: int, size: int, make, label: str) -> tuple[DataFrame, int]:
    """The rows dealt to parts of about ``size``, each as one object; and how many parts."""
    parts = max(1, -(-count // size))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        row = (int(rows["dim"].iloc[0]), int(rows["part"].iloc[0]), pickle.dumps(make(*arrays(rows))))
        return pd.DataFrame([row], columns=["dim", "part", "content"])

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    found = dealt.groupBy("dim", "part").applyInPandas(one, "dim int, part int, content binary")
    return materialize(found, label), parts


def top_k(
    vectors: DataFrame,
    every: int = 20,
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each vector whose id is
    divisible by ``every``, among all others.

    Every shard meets every block of queries, so the bytes that are shuffled fall as
    ``shard_rows`` and ``block_rows`` rise; a task holds one of each.
    """
    shard_rows, block_rows = shard_rows or SHARD_ROWS, block_rows or BLOCK_ROWS
    spark = vectors.sparkSession
    whole = materialize(whole_vectors(vectors, vec_id, embedding), "vectors")
    asked = whole.filter(F.col("id") % every == 0)
    trees, shards = packed(whole, whole.count(), shard_rows, BallTree, "trees")
    blocks, count = packed(asked, asked.count(), block_rows, lambda ids, x: (ids, x), "queries")
    trees = trees.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("block"), F.col("part").alias("shard"), F.col("content").alias("tree")
    )
    blocks = blocks.select("dim", F.col("part").alias("block"), F.col("content").alias("asked"))
    groups = max(1, -(-shards // CHAIN))
    work = trees.join(blocks, ["dim", "block"]).withColumn("chain", F.pmod(F.col("shard"), F.lit(groups)))
    # A task sees a chain of shards for one block in order, and holds one tree at a time.
    keys = ["dim", "block", "chain"]
    work = work.repartition(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys, "shard")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, None
        for batch in batches:
            for dim, block, chain, tree, asked in batch[[*keys, "tree", "asked"]].itertuples(index=False):
                if (dim, block, chain) != at:
                    if best is not None:
                        yield best.rows()
                    at, best = (dim, block, chain), TopK(*pickle.loads(asked), k)
                best.search(pickle.loads(tree))
        if best is not None:
            yield best.rows()

    found = work.mapInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
