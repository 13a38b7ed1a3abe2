"""Hard negatives and whitening against plain versions."""

from __future__ import annotations

import numpy as np
import pytest

from refinery.llm import hard_negatives, whitening
from refinery.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duckdb_over
from tests.conftest import TABLES

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<double>, label int, x int, dim int, code string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c", 3) for r in rows], SCHEMA)


def test_negatives_query(spark):
    assert difference(QUERIES["op11_hard_negatives"](spark, TABLES), duckdb_over(TABLES), ORACLES["op11_hard_negatives"]) == ""


def plain_negatives(rows, every, positives=5, negatives=3):
    whole = [(i, [int(np.floor(v * 256)) for v in x], label) for i, x, label in rows]
    out = []
    for q, x, label in whole:
        if q % every:
            continue
        scored = sorted((-int(np.dot(x, y)), i, other) for i, y, other in whole if i != q and len(y) == len(x))
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(i, -s) for s, i, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(q, positive, at + 1, i, -p, s) for at, (i, s) in enumerate(inside[:negatives])]
    return sorted(out)


def vectors(count, seed, dim=6):
    source = np.random.RandomState(seed)
    centres = source.randn(4, dim)
    x = centres[source.randint(4, size=count)] * source.rand(count, 1) + source.randn(count, dim) * 0.05
    return [(i, (np.round(v * 16) / 256).tolist(), int(source.randint(3))) for i, v in enumerate(x)]


@pytest.mark.parametrize("block_rows", [4, 256])
def test_negatives_over_many_shards_with_ties(spark, monkeypatch, block_rows):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(hard_negatives, "STEP", 16)
    monkeypatch.setattr(hard_negatives, "CHAIN", 2)
    rows = vectors(500, 4) + [(i, [0.0625] * 6, i % 2) for i in range(500, 600)] + [(i, [0.0] * 6, i % 3) for i in range(600, 620)]
    found = hard_negatives.hard_negatives(frame(spark, rows), every=10, shard_rows=70)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 10)


def test_awkward_vectors_have_defined_negatives(spark):
    usable = [(0, [1.0, 2.0], 1), (0, [2.0, 1.0], 2), (50, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.75, 1.0], 2), (3, [0.75, 1.0], 1), (3, [0.75, 1.0], 2), (4, [1.0], 1), (100, [], 1), (-50, [3.0, -9e5], 2), (150, [1.0], 7)]
    rest = [(5, None, 1), (6, [None, 1.0], 1), (7, [NAN, 1.0], 1), (8, [INF, 1.0], 1), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1)]
    found = hard_negatives.hard_negatives(frame(spark, usable + rest))
    assert sorted(map(tuple, found.collect())) == plain_negatives(usable, 50)
    assert hard_negatives.hard_negatives(frame(spark, usable).limit(0)).count() == 0


def test_walks_end_early_on_tight_clusters():
    """The certificate spares most products where anchors and candidates are clustered."""
    import pandas as pd

    source = np.random.RandomState(3)
    centres = source.randint(-200, 200, (30, 16))
    x = centres[source.randint(30, size=6000)] + source.randint(-4, 5, (6000, 16))
    shard = hard_negatives.Rows(pd.DataFrame({"id": np.arange(6000), "code": np.arange(6000) % 2, "number": np.arange(6000), "x": x.tolist()}))
    near = (centres[0] + source.randint(-4, 5, (50, 16))).tolist()
    own = pd.DataFrame({"id": np.arange(-50, 0), "code": 0, "number": np.arange(50), "x": near})
    cluster = hard_negatives.Cluster(hard_negatives.Rows(own))
    n = len(own)
    best = hard_negatives.Best(np.arange(n), np.full(n, hard_negatives.LOWEST), np.full(n, hard_negatives.HIGHEST), 5)
    assert best.walk(cluster, shard, True) < 0.4 * n * 6000
    scores = np.array(near) @ x.T
    scores[:, 1::2] = -(10**9)
    assert (np.sort(scores, axis=1)[:, :-6:-1] == best.scores).all()


def test_labels_of_any_kind_and_a_hot_one(spark):
    rows = [(i, x, label if i % 3 else 9) for i, x, label in vectors(300, 9)]
    named = frame(spark, rows).selectExpr("vec_id AS key", "embedding AS v", "concat('name ', label) AS label")
    found = hard_negatives.hard_negatives(named, every=25, vec_id="key", embedding="v", shard_rows=50)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 25)


# Whitening


def plain_whitening(rows, components=16):
    """By numpy's eigenvalues of the covariance, for vectors of one length."""
    whole = [[int(np.floor(float(v) * 64)) + 1_000_000 for v in x] for _, x in rows]
    fit = np.array(sorted(set(map(tuple, whole))), dtype=object)
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(n * v - s) / n for v, s in zip(x, sums)] for x in fit])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    values, vectors_ = values[::-1][:components], vectors_[:, ::-1][:, :components]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(x, sums)) for x in whole]
    projected = np.array([[float(n * v - s) / n for v, s in zip(x, sums)] for x in whole]) @ vectors_ / np.sqrt(np.maximum(values, 1e-30))
    return n, deviations, projected, values / np.trace(centred.T @ centred / n)


def compare(found, rows, count=16, close=1e-9):
    n, deviations, projected, explained = plain_whitening(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert set(by_id) == {i for i, _ in rows}
    assert len(found) == len(rows) * count
    signs = {}
    for at, (i, _) in enumerate(rows):
        for k in range(count):
            r = by_id[i][k + 1][0]
            assert r["n"] == n and r["deviation"] == deviations[at]
            assert abs(r["explained"] / explained[k] - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9
            if abs(projected[at, k]) > 0.1:
                signs.setdefault(k, np.sign(projected[at, k] * r["whitened"]))
            assert abs(r["whitened"] - signs.get(k, 1) * projected[at, k]) < close or k not in signs


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TABLES}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(QUERIES["op13_qd_whitening"](spark, TABLES).collect(), rows)


def test_whitening_through_a_tree_of_triangles(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 7)
    source = np.random.RandomState(5)
    rows = [(i, x.tolist()) for i, x in enumerate(source.randn(400, 20) * np.exp(source.randn(20)))]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]  # one vector holds a third of all rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    compare(whitening.whiten(df).collect(), rows)


def test_awkward_vectors_are_whitened_or_left_out(spark):
    source = np.random.RandomState(2)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(source.randn(30, 3))]
    bad = [(40, None, 0), (41, [None, 1.0, 1.0], 0), (42, [NAN, 1.0, 1.0], 0), (43, [INF, 1.0, 1.0], 0), (44, [], 0), (45, [1e300, 0.0, 0.0], 0)]
    extra = [(None, rows[0][1], 0), (0, rows[0][1], 0), (50, [1.0, 2.0], 0), (51, [2.0, 4.0], 0), (52, [3.0, 6.5], 0), (60, [5.0], 0)]
    found = whitening.whiten(frame(spark, rows + bad + extra)).collect()
    wide = [r for r in found if r["n"] == 30]
    assert len(wide) == 32 * 3
    first = [(r["component"], r["deviation"], r["whitened"]) for r in wide if r["vec_id"] in (0, None)]
    assert len(first) == 9 and len(set(first)) == 3
    assert sorted({(r["vec_id"], r["component"]) for r in found if r["n"] == 3}) == [(i, k) for i in (50, 51, 52) for k in (1, 2)]
    assert not [r for r in found if r["vec_id"] in (40, 41, 42, 43, 44, 45, 60)]  # 60 alone has no variance
    assert whitening.whiten(frame(spark, rows).limit(0)).count() == 0


def test_whitening_of_alike_vectors(spark):
    """Rank below the number of dimensions: only directions with variance are components."""
    rows = [(i, [float(i % 5), float(i % 5) * 2, 1.0, float(i % 3)], 0) for i in range(60)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in found} == {1, 2} and {r["n"] for r in found} == {15}
    assert abs(sum({r["component"]: r["explained"] for r in found}.values()) - 1) < 1e-12
    compare(found, [(i, x) for i, x, _ in rows], 2)


def test_deviations_beyond_64_bits_are_null():
    centre = whitening.Centre(3, [9, 0])
    assert centre.deviations(np.array([[4, 1]])) == [9 + 9]
    big = whitening.Centre(10**9, [0, 0])
    assert big.deviations(np.array([[1 << 30, 1], [1, 1], [3, 0]])) == [None, 2 * 10**18, 9 * 10**18]


@pytest.mark.parametrize("squares", [
    np.ones(30), np.repeat([1.0, 4.0], 15), 1 + 1e-14 * np.arange(30), 10.0 ** -np.arange(30), np.arange(30.0), np.zeros(30), 1 + np.arange(30) ** 2.0,
])
def test_solver_on_hard_spectra(squares):
    turn = np.linalg.qr(np.random.RandomState(7).randn(30, 30))[0]
    r = np.linalg.qr(np.diag(np.sqrt(squares)) @ turn, mode="r")
    values, vectors_ = whitening.directions(r, 30)
    expected = np.sort(squares)[::-1][: len(values)]
    assert len(values) == min(30, (squares > 1e-24 * squares.max()).sum()) or squares.min() < 1e-20
    assert np.abs(values - expected).max(initial=0) <= 1e-13 * squares.max()
    assert np.abs(vectors_ @ vectors_.T - np.eye(len(values))).max(initial=0) < 1e-11
    assert np.abs(vectors_ @ r.T @ r @ vectors_.T - np.diag(values)).max(initial=0) < 1e-11 * max(1, squares.max())


def test_singular_values_are_relatively_right():
    """dqds loses no digits on graded bidiagonals, where squares of the matrix would."""
    from fractions import Fraction

    q, e = [1.0, 1e-8, 1e-16, 1e-24], [1e-4, 1e-12, 1e-20]
    product = 1
    for x in q:
        product *= Fraction(x)
    found = whitening.dqds(q, e)
    got = 1
    for x in found:
        got *= Fraction(x)
    assert abs(got / product - 1) < 1e-13 and found == sorted(found, reverse=True)
