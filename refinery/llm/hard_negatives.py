"""Hard negatives by shared lists of candidates, one list per cluster of anchors.

Anchors are clustered by direction. For a cluster with centre c, a candidate at angle t from
c and a cluster whose members lie within angle b of c, no member's product with the candidate
exceeds the lengths of both times cos(max(0, t - b)). So the candidates are sorted once per
cluster by length times that cosine, and every member walks the same list, until its next
bound shows that nothing further on can enter its result: the walk ends with a certificate,
not with a limit.

Two walks are made. The first finds the positives, the best rows of the anchor's label. The
second finds for each positive the best rows of other labels whose score lies between
``least`` and ``most`` hundredths of the positive's; the least score that counts is known
from the start, and rows above the range are passed over.

Clusters of more than ``BLOCK_ROWS`` anchors are dealt to several blocks, which then are
clusters with lists of their own. Candidates are dealt to shards, and a task walks the lists
of a chain of shards for one block; the results of all chains are joined and cut again. So
neither a hot label nor a hot vector is held by one task.

Components become floor(``scale`` * x), so scores are whole numbers and ties go to the
smaller id. Rows without an id or a label, and vectors that are null or hold null or
non-finite components, take no part; only vectors of equal length meet. Rows that share an id
are each a row: an anchor id with several rows mines for each of them, but no row of the
anchor's own id is among its candidates. Equal scores of rows with equal ids are told apart
by label. An anchor without positives, or a positive without negatives in range, gives no
rows; nor does an empty table. Scores have to fit into 64 bits. Other columns may have any
name.
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

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LEAST, MOST = 50, 95  # hundredths of the positive's score
SCALE = 256
#: Anchors that the centres are fitted on, at most, and centres, at most; every anchor is
#: then dealt to its nearest centre.
FIT_ROWS, CENTRES, ROUNDS = 4_096, 256, 8
BLOCK_ROWS, SHARD_ROWS, STEP = 256, 8_192, 512
CHAIN = 4  # shards whose lists one task walks for a block
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Rows:
    """Candidates or anchors as arrays, in the narrowest type that holds their components."""

    def __init__(self, rows: pd.DataFrame):
        x = np.array(rows["x"].tolist(), dtype=np.int64).reshape(len(rows), -1)
        most = int(max(x.max(initial=0), ~x.min(initial=0)))
        self.ids = rows["id"].to_numpy(dtype=np.int64)
        self.labels = rows["code"].to_numpy(dtype=np.int64)
        self.numbers = rows["number"].to_numpy(dtype=np.int64)
        self.x = x.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def lengths_of(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x**2).sum(axis=1))


def angles_to(centre: np.ndarray, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Angles to the unit vector ``centre``; a zero vector has any angle, here 0."""
    cosines = np.divide(x @ centre, lengths, out=np.ones(len(x)), where=lengths > 0)
    return np.arccos(np.clip(cosines, -1, 1))


class Cluster:
    """A block of anchors with the centre and the angle that bound all its members."""

    def __init__(self, rows: Rows):
        self.rows = rows
        self.x = rows.x.astype(np.float64)
        self.lengths = lengths_of(self.x)
        units = np.divide(self.x, self.lengths[:, None], out=np.zeros_like(self.x), where=self.lengths[:, None] > 0)
        middle = units.sum(axis=0)
        self.centre = middle / (np.sqrt(middle @ middle) or 1.0)
        away = angles_to(self.centre, self.x, self.lengths)[self.lengths > 0]
        self.width = float(away.max(initial=0)) + 1e-7  # above the rounding of arccos
        if not middle.any():
            self.width = np.pi

    def shared_list(self, shard: Rows) -> tuple[np.ndarray, np.ndarray]:
        """The order of the candidates by falling bound, and the bounds for a unit anchor."""
        x = shard.x.astype(np.float64)
        lengths = lengths_of(x)
        away = np.maximum(0, angles_to(self.centre, x, lengths) - self.width)
        bounds = lengths * np.cos(np.minimum(away, np.pi))
        bounds += 1e-9 * (1 + lengths)
        order = np.argsort(-bounds, kind="stable")
        return order, bounds[order]

    def products(self, members: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact products: in floating point where all sums stay below 2^53."""
        theirs = x.astype(np.float64)
        most = float(np.abs(self.x[members]).max(initial=0)) * float(np.abs(theirs).max(initial=0)) * max(1, theirs.shape[1])
        if most < 2**53:
            return (self.x[members] @ theirs.T).astype(np.int64)
        return self.rows.x[members].astype(np.int64) @ x.T.astype(np.int64)


class Best:
    """For each of several searches the k best candidates of scores from ``low`` to ``high``;
    a search belongs to one member of a cluster."""

    def __init__(self, members: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.members, self.low, self.high, self.k = members, low, high, k
        self.scores = np.full((len(members), k), LOWEST)
        self.ids = np.full((len(members), k), HIGHEST)
        self.labels = np.full((len(members), k), HIGHEST)

    def needed(self) -> np.ndarray:
        """The score that a candidate must reach to matter; an equal one may by its id."""
        return np.maximum(self.low, self.scores[:, -1])

    def walk(self, cluster: Cluster, shard: Rows, same_label: bool) -> int:
        """Every search walks the shared list to its certified end; returns the steps taken."""
        order, bounds = cluster.shared_list(shard)
        lengths = cluster.lengths[self.members]
        active, taken = np.arange(len(self.members)), 0
        for start in range(0, len(order), STEP):
            # What a member can still reach: its length times the bound of the next entry.
            reach = lengths[active] * bounds[start]
            reach += 1e-9 * np.abs(reach) + 1e-6
            active = active[reach >= self.needed()[active]]
            if not len(active):
                break
            at = order[start : start + STEP]
            members, place = np.unique(self.members[active], return_inverse=True)
            scores = cluster.products(members, shard.x[at])
            own = cluster.rows
            fits = (own.labels[members][:, None] == shard.labels[at]) == same_label
            fits &= own.ids[members][:, None] != shard.ids[at]
            scores, fits = scores[place], fits[place]
            fits &= (scores >= self.needed()[active][:, None]) & (scores <= self.high[active][:, None])
            taken += scores.size
            some = fits.any(axis=1)
            self.take(active[some], np.where(fits[some], scores[some], LOWEST), shard.ids[at], shard.labels[at])
        return taken

    def take(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        if not len(rows):
            return
        real = scores != LOWEST
        scores = np.hstack([self.scores[rows], scores])
        ids = np.hstack([self.ids[rows], np.where(real, ids, HIGHEST)])
        labels = np.hstack([self.labels[rows], np.where(real, labels, HIGHEST)])
        best = np.lexsort((labels, ids, ~scores), axis=-1)[:, : self.k]
        for name, held in (("scores", scores), ("ids", ids), ("labels", labels)):
            getattr(self, name)[rows] = np.take_along_axis(held, best, axis=1)

    def rows(self, **names: np.ndarray) -> pd.DataFrame:
        """The candidates found, beside what ``names`` says of their search."""
        real = self.ids.ravel() != HIGHEST
        columns = {name: np.repeat(values, self.k) for name, values in names.items()}
        columns |= {"id": self.ids.ravel(), "code": self.labels.ravel(), "score": self.scores.ravel()}
        return pd.DataFrame({name: values[real] for name, values in columns.items()})


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """id, code (a hash of the label), x, dim and number of the rows that take part. The
    number tells the rows of one id apart."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    own = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("x")
    )
    own = own.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", bad))
    return own.select(
        "id", "label", F.transform("x", lambda x: F.floor(x * scale)).alias("x"), F.size("x").alias("dim"),
        F.monotonically_increasing_id().alias("number"),
    )


def coded(rows: DataFrame) -> DataFrame:
    """Labels as numbers, one for each different label, so that no two share one."""
    labels = rows.select("label").distinct().select("label", F.monotonically_increasing_id().alias("code"))
    return rows.join(materialize(labels, "labels"), "label").select("id", "code", "x", "dim", "number")


def centres_of(anchors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Directions of cluster centres per vector length, by spherical k-means over at most
    ``FIT_ROWS`` anchors of the smallest hash; about a cluster for each full block."""
    sample = anchors.orderBy(F.xxhash64("id", "number"), "number").limit(FIT_ROWS).select("id", "dim", "x").toPandas()
    wanted = max(1, min(CENTRES, -(-count // BLOCK_ROWS)))
    found = {}
    for dim, rows in sample.sort_values("id", kind="stable").groupby("dim"):
        x = np.array(rows["x"].tolist(), dtype=np.float64).reshape(len(rows), -1)
        lengths = lengths_of(x)
        x = x[lengths > 0] / lengths[lengths > 0, None]
        if not len(x):
            continue
        centres = x[:: -(-len(x) // wanted)]
        for _ in range(ROUNDS):
            nearest = (x @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, x)
            long = lengths_of(sums)
            centres = np.where(long[:, None] > 0, sums / np.where(long > 0, long, 1)[:, None], centres)
        found[int(dim)] = centres
    return found


def blocks_of(anchors: DataFrame) -> DataFrame:
    """dim, block and the anchors of that block; a large cluster has several."""
    spark = anchors.sparkSession
    centres = spark.sparkContext.broadcast(centres_of(anchors, anchors.count()))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = []
            for dim, x in zip(batch["dim"], batch["x"]):
                own = centres.value.get(int(dim))
                near.append(0 if own is None else int((own @ np.asarray(x, dtype=np.float64)).argmax()))
            yield batch.assign(cluster=near)

    schema = "id long, code long, x array<long>, dim int, number long"
    dealt = materialize(anchors.select("id", "code", "x", "dim", "number").mapInPandas(deal, f"{schema}, cluster int"), "clusters")
    sizes = dealt.groupBy("dim", "cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts"))
    # No more rows than centres and vector lengths: Spark sees their size and broadcasts them.
    split = dealt.join(materialize(sizes, "cluster-sizes"), ["dim", "cluster"])
    split = split.withColumn("part", F.pmod(F.xxhash64("id", "number"), F.col("parts")).cast("int"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        row = (int(rows["dim"].iloc[0]), int(rows["cluster"].iloc[0]), int(rows["part"].iloc[0]), pickle.dumps(Rows(rows)))
        return pd.DataFrame([row], columns=["dim", "cluster", "part", "anchors"])

    packed = split.groupBy("dim", "cluster", "part").applyInPandas(pack, "dim int, cluster int, part int, anchors binary")
    return materialize(packed.select("dim", F.struct("cluster", "part").alias("block"), "anchors"), "blocks")


def shards_of(rows: DataFrame, count: int, shard_rows: int) -> tuple[DataFrame, int]:
    shards = max(1, -(-count // shard_rows))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        row = (int(rows["dim"].iloc[0]), int(rows["shard"].iloc[0]), pickle.dumps(Rows(rows)))
        return pd.DataFrame([row], columns=["dim", "shard", "candidates"])

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "number"), F.lit(shards)).cast("int"))
    return materialize(dealt.groupBy("dim", "shard").applyInPandas(pack, "dim int, shard int, candidates binary"), "shards"), shards


def walked(shards: DataFrame, blocks: DataFrame, chains: int, begin, schema: str) -> DataFrame:
    """Walk the lists of each chain of shards for each block of the same vector length.

    ``begin`` makes of a block's row its cluster, its searches, whether they want the
    anchor's label, and what their results are named by. A task holds one shard at a time."""
    others = [c for c in blocks.columns if c not in ("dim", "block")]
    work = shards.join(blocks, "dim").withColumn("chain", F.pmod(F.col("shard"), F.lit(chains)))
    keys = ["dim", "block", "chain"]
    work = work.repartition(shuffle_partitions(blocks.sparkSession), *keys).sortWithinPartitions(*keys, "shard")
    work = work.select(F.concat_ws("/", "dim", "block.cluster", "block.part", "chain").alias("key"), "candidates", *others)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            for key, candidates, *own in batch.itertuples(index=False):
                if key != at:
                    if state is not None:
                        yield state[1].rows(**state[3])
                    at, state = key, begin(*own)
                cluster, best, same_label, _ = state
                best.walk(cluster, pickle.loads(candidates), same_label)
        if state is not None:
            yield state[1].rows(**state[3])

    return work.mapInPandas(walk, schema)


def positives_of(shards: DataFrame, blocks: DataFrame, chains: int, positives: int) -> DataFrame:
    """dim, block, number (of the anchor), id and score of each anchor's positives."""

    def begin(content: bytes, block: dict, dim: int):
        cluster = Cluster(pickle.loads(content))
        n = len(cluster.rows.ids)
        best = Best(np.arange(n), np.full(n, LOWEST), np.full(n, HIGHEST), positives)
        return cluster, best, True, {"dim": np.full(n, dim), "cluster": np.full(n, block[0]), "part": np.full(n, block[1]), "number": cluster.rows.numbers}

    named = blocks.select("dim", "block", "anchors", F.array("block.cluster", "block.part").alias("name"), F.col("dim").alias("width"))
    found = walked(shards, named, chains, begin, "dim int, cluster int, part int, number long, id long, code long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    return ranked.select("dim", F.struct("cluster", "part").alias("block"), "number", "place", "id", "score")


def hard_negatives(
    vectors: DataFrame,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    shard_rows: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each
    row whose id is divisible by ``every`` and each of its positives, the negatives in range.

    Every shard meets every block of anchors, so the bytes that are shuffled fall as
    ``shard_rows`` and ``BLOCK_ROWS`` rise."""
    whole = materialize(whole_vectors(vectors, vec_id, embedding, label, scale), "vectors")
    rows = materialize(coded(whole), "coded")
    shards, count = shards_of(rows, rows.count(), shard_rows or SHARD_ROWS)
    chains = max(1, -(-count // CHAIN))
    blocks = blocks_of(rows.filter(F.col("id") % every == 0))
    pairs = materialize(positives_of(shards, blocks, chains, positives), "positives")
    listed = pairs.groupBy("dim", "block").agg(F.sort_array(F.collect_list(F.struct("number", "place", "id", "score"))).alias("pairs"))
    asked = materialize(blocks.join(listed, ["dim", "block"]), "asked")

    def begin(content: bytes, listed) -> tuple:
        cluster = Cluster(pickle.loads(content))
        own = pd.DataFrame([tuple(p.values()) if isinstance(p, dict) else tuple(p) for p in listed], columns=["number", "place", "id", "score"])
        at = {number: i for i, number in enumerate(cluster.rows.numbers.tolist())}
        members = np.array([at[n] for n in own["number"].tolist()])
        scores = [int(s) for s in own["score"]]
        # least * p <= 100 * s <= most * p, in whole numbers
        low = np.array([-(-least * s // 100) for s in scores], dtype=np.int64)
        high = np.array([most * s // 100 for s in scores], dtype=np.int64)
        best = Best(members, low, high, negatives)
        names = {"anchor_id": cluster.rows.ids[members], "number": own["number"].to_numpy(), "place": own["place"].to_numpy(), "positive_id": own["id"].to_numpy(), "positive_score": own["score"].to_numpy()}
        return cluster, best, False, names

    schema = "anchor_id long, number long, place int, positive_id long, positive_score long, id long, code long, score long"
    found = walked(shards, asked.select("dim", "block", "anchors", "pairs"), chains, begin, schema)
    order = Window.partitionBy("number", "place").orderBy(F.desc("score"), "id", "code")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x,
         row_number() OVER () AS number
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.number, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.x) = len(c.x)
),
positives AS (
  SELECT number, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.number, p.place ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.number = p.number AND NOT n.same
  WHERE p.place <= 5 AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
