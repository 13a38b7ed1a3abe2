from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from refinery.llm import ball_tree, conflict_packing
from refinery.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duckdb_over
from tests.conftest import TABLES
from tests.llm.cases import empty, messy


def plain_pack(rows, capacity, per_source):
    """Best fit by looking at every bin: rows of (doc_id, length, source, cluster)."""
    bins, placed = [], []
    rest = [(n % capacity if n % capacity or not n else 0, i, s, c, n) for i, n, s, c in rows]
    full = sum(n // capacity for _, n, _, _ in rows)
    rest = [r for r in rest if r[0] or not r[4]]
    for n, i, s, c, _ in sorted(rest, key=lambda r: -r[0]):
        fits = [
            (b["left"], at) for at, b in enumerate(bins)
            if b["left"] >= n and (c is None or c not in b["clusters"]) and (s is None or b["sources"][s] < per_source)
        ]
        at = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "sources": Counter(), "clusters": set()})
        bins[at]["left"] -= n
        bins[at]["sources"][s] += 1
        bins[at]["clusters"].add(c)
        placed.append((i, full + at))
    return placed


def test_one_shard_is_packed_as_plain_best_fit(spark):
    source = random.Random(8)
    rows = [(i, source.choice([0, 5, 30, 60, 90, 100, 150, 230]), source.choice(["a", "a", "b", "c", None]), source.choice([1, 2, 3, None])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, size int, source string, cluster long").withColumn("text", F.lit("x"))
    found = conflict_packing.pack(docs, F.col("size"), F.col("cluster"), capacity=100, per_source=2, shard_rows=10**6).collect()
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    last = {}
    for r in found:
        if r["length"] < 100:
            last[r["doc_id"]] = r["bin"]
    assert last == {i: b for i, b in plain_pack(ordered, 100, 2) if i in last}
    check(found, {i: (n, s, c) for i, n, s, c in rows}, 100, 2)


def check(found, docs, capacity, per_source):
    """Every unit is in one place, bins aren't overfull, and nothing conflicts."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        bins[r["shard"], r["bin"]].append(r)
    assert set(pieces) == set(docs)
    for i, own in pieces.items():
        assert sum(n for _, n in own) == docs[i][0]
        assert sorted(a for a, _ in own) == [k * capacity for k in range(len(own))]
    for own in bins.values():
        spans = sorted((r["place"], r["place"] + r["length"]) for r in own)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= capacity
        tails = [docs[r["doc_id"]] for r in own]
        assert max(Counter(s for _, s, _ in tails if s is not None).values(), default=0) <= per_source
        assert max(Counter(c for _, _, c in tails if c is not None).values(), default=0) <= 1


def test_packing_query(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    whole = {r["doc_id"]: (len(r["text"].encode()), r["source"], " ".join(r["text"].split(" "))) for r in docs}
    check(QUERIES["op2_conflict_packing"](spark, TABLES).collect(), whole, conflict_packing.CAPACITY, 2)


def test_packing_does_not_depend_on_order_and_splits_hot_sources(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 97 as int))").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("source")
    )
    one = conflict_packing.pack(docs, capacity=200, shard_rows=500)
    two = conflict_packing.pack(docs.orderBy(F.rand(3)), capacity=200, shard_rows=500)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.groupBy("shard").count().agg(F.max("count")).first()[0] < 1000


def test_awkward_rows_are_packed(spark):
    docs = messy(spark)
    found = conflict_packing.pack(docs)
    assert found.select("doc_id").distinct().count() == 12
    assert found.agg(F.sum("length")).first()[0] == docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert conflict_packing.pack(empty(spark)).count() == 0


def test_search_query(spark):
    assert difference(QUERIES["op5_ball_tree"](spark, TABLES), duckdb_over(TABLES), ORACLES["op5_ball_tree"]) == ""


def plain_search(rows, every, k):
    whole = [(i, [int(np.floor(v * 64)) for v in x]) for i, x in rows]
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        own = [x for i, x in whole if i == q]
        scores = sorted((-int(np.dot(x, y)), c) for x in own for c, y in whole if c != q and len(y) == len(x))
        out += [(q, at + 1, c, -s) for at, (s, c) in enumerate(scores[:k])]
    return out


def test_search_over_many_shards_with_ties(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 60)
    monkeypatch.setattr(ball_tree, "BLOCK_ROWS", 8)
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 7)
    monkeypatch.setattr(ball_tree, "CHAIN", 2)
    source = np.random.RandomState(6)
    rows = [(i, (source.randint(-3, 4, 6) / 64.0).tolist()) for i in range(500)]
    rows += [(i, [0.5] * 6) for i in range(500, 560)]
    found = ball_tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20, k=20)
    assert sorted(map(tuple, found.collect())) == sorted(plain_search(rows, 20, 20))


def test_search_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [3.0, -1.0]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, None), (None, [1.0, 1.0]), (5, [1.0]), (6, [0.25, 0.3]), (7, [9e5, 9e5]), (7, [9e5, 9e5]), (40, [])]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, dim int")
    usable = [(0, [1.0, 2.0]), (20, [3.0, -1.0]), (5, [1.0]), (6, [0.25, 0.3]), (7, [9e5, 9e5]), (7, [9e5, 9e5]), (40, [])]
    assert sorted(map(tuple, ball_tree.top_k(vectors).collect())) == sorted(plain_search(usable, 20, 20))
    assert ball_tree.top_k(vectors.limit(0)).count() == 0


def test_rows_that_share_an_id_are_each_a_candidate(spark, tmp_path):
    rows = [(0, [1.0, 1.0]), (1, [1.0, 0.0]), (1, [5.0, 5.0]), (1, [5.0, 5.0]), (2, [2.0, 2.0]), (20, [1.0, -1.0]), (20, [-1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ball_tree.top_k(vectors, k=20)
    assert [tuple(r) for r in found.filter("query_id = 0 AND rank <= 3").orderBy("rank").collect()] == [(0, 1, 1, 40960), (0, 2, 1, 40960), (0, 3, 2, 16384)]
    vectors.coalesce(1).write.parquet(f"{tmp_path}/e")
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    assert difference(found, connection, ORACLES["op5_ball_tree"]) == ""


def test_bounds_prune(monkeypatch):
    """On clustered vectors most leaves are never read."""
    source = np.random.RandomState(2)
    centres = source.randint(-300, 300, (40, 16))
    x = (centres[source.randint(40, size=8000)] + source.randint(-5, 6, (8000, 16))).astype(np.int64)
    tree = ball_tree.BallTree(np.arange(8000), x)
    best, taken = ball_tree.TopK(np.arange(20), x[:20], 20), []
    plain = ball_tree.TopK.take
    monkeypatch.setattr(ball_tree.TopK, "take", lambda self, rows, a, b, t: (taken.append(len(rows) * (b - a)), plain(self, rows, a, b, t)))
    best.search(tree)
    assert sum(taken) < 0.3 * 20 * 8000
