"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Tasks centre their rows and reduce them, block by block, to a triangle R of at most d rows; a
tree of further QR steps reduces the triangles of all tasks to one, whose R'R is n times the
covariance. Householder reflections turn it into an upper bidiagonal, dqds finds its singular
values from squares without ever forming the covariance, and a twisted factorisation per
value gives the direction. The driver sees no row and no triangle, only sums, the directions
and how many triangles there are.

Entries are whole numbers, x = floor(``scale`` * entry) + ``offset``, so sums and centring
are exact: with S = n * m + r, n * x - S is n * (x - m) - r. The fit list holds each distinct
vector once; a vector that a third of all rows share is one row after the map side.

Vectors that are null or hold null or non-finite entries, or entries whose whole number
reaches 2^40, take no part. Rows without an id do, and keep their null id; repeated rows are
returned as often as they come, and count once in the fit. Vectors of unlike length are
whitened apart, each length with a fit of its own. Directions without variance have no scale
to divide by and are left out, so there are fewer components than asked for where vectors are
few or all alike; an empty table gives no rows. ``deviation`` is null where it does not fit
into 64 bits. Other columns are neither read nor returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.session import materialize

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
LARGEST = 1 << 40
FAN_IN = 16  # triangles that one task of the tree reduces
BLOCK = 2_048  # rows that are reduced, or projected, at a time
MODEL_BYTES = 64 << 20  # of models that are sent to tasks together
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
EPS = float(np.finfo(np.float64).eps)


# The solver: small dense work on one triangle.


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the QR decomposition of ``rows``, with at most as many rows as columns."""
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the right reflections V of ``r`` = U B V'."""
    d = r.shape[1]
    a = np.zeros((d, d))
    a[: len(r)] = r
    v = np.eye(d)
    for k in range(d):
        reflect(a[k:, k:])
        if k < d - 2:
            w = reflect(a[k:, k + 1 :].T)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def reflect(a: np.ndarray) -> np.ndarray:
    """Reflect the rows of ``a`` in place so that its first column ends after one entry;
    returns the unit vector of the reflection, or zeros if there is nothing to do."""
    w = a[:, 0].copy()
    if not np.any(w[1:]):
        return np.zeros(len(w))
    most = np.abs(w).max()
    w /= most
    length = math.copysign(math.sqrt(float(w @ w)), w[0])
    w[0] += length
    w /= math.sqrt(float(w @ w))
    a[:, 1:] -= np.outer(2 * w, w @ a[:, 1:])
    a[:, 0] = 0
    a[0, 0] = -length * most
    return w


def sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform: the new q and e and the pivots d, or None if ``shift`` exceeds
    the smallest value, so that a pivot is negative."""
    d, pivots, new_q, new_e = q[0] - shift, [], [], []
    for low, following in zip(e, q[1:]):
        pivots.append(d)
        if d < 0:
            return None
        top = d + low
        ratio = following / top
        new_q.append(top)
        new_e.append(low * ratio)
        d = d * ratio - shift
    pivots.append(d)
    return (new_q + [d], new_e, pivots) if d >= 0 else None


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Squares of the singular values of the bidiagonal with squared diagonal ``q`` and
    squared superdiagonal ``e``, descending.

    The pivots of a transform bound the smallest value from both sides: it lies between one
    over the sum of their reciprocals and the least of them. A shift half way is tried while
    the bounds are far apart, and a failed one becomes the upper bound; near the value the
    lower bound is the shift, which never fails and converges quadratically. A value that is
    exactly zero leaves through transforms without shift.
    """
    found: list[float] = []
    open_parts = [(list(q), list(e), 0.0)]
    while open_parts:
        q, e, sigma = open_parts.pop()
        low, high = 0.0, math.inf
        for _ in range(100 + 200 * len(q)):
            small = (i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS**2 * (sigma + min(q[i], q[i + 1])))
            if (at := next(small, None)) is not None:
                open_parts.append((q[: at + 1], e[:at], sigma))
                q, e, low, high = q[at + 1 :], e[at + 1 :], 0.0, math.inf
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            shift = low if high < 1.5 * low else (0.0 if high == math.inf else (low + high) / 2)
            step = sweep(q, e, shift)
            if step is None and shift > low:
                high = shift
                continue
            if step is None:  # rounding alone made the sure shift fail
                shift, step = 0.0, sweep(q, e, 0.0)
            q, e, pivots = step
            sigma += shift
            low, high = (1 / sum(1 / x for x in pivots), min(pivots)) if min(pivots) > 0 else (0.0, 0.0)
            low *= 1 - 1e-12
        else:
            raise ArithmeticError("the qd transforms do not converge")
    return sorted(found, reverse=True)


def twisted(a: np.ndarray, b: np.ndarray, value: float, against: list[np.ndarray]) -> np.ndarray:
    """The unit eigenvector of B'B (B with diagonal ``a``, superdiagonal ``b``) for ``value``,
    orthogonal to the vectors ``against``, which belong to values next to it.

    L D L' = B'B; its factorisations from the top (stationary) and from the bottom
    (progressive) with the value as shift meet where the twist is smallest. If that vector is
    already taken, the next twist gives another one of the same space.
    """
    n = len(a)
    d, ld = a * a, a[:-1] * b
    tiny = EPS * EPS * float(d.max()) + 1e-290
    s, lower = [-value], []
    for i in range(n - 1):
        pivot = d[i] + s[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        lower.append(ld[i] / pivot)
        s.append(lower[i] * (b[i] / a[i]) * s[i] - value)
    p, upper = [d[n - 1] - value], []
    for i in range(n - 2, -1, -1):
        pivot = b[i] * b[i] + p[-1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        upper.append(ld[i] / pivot)
        p.append(p[-1] * (d[i] / pivot) - value)
    p, upper = p[::-1], upper[::-1]
    twist = np.abs(np.array(s) + np.array(p) + value)
    best, most = np.zeros(n), -1.0
    for r in np.argsort(twist, kind="stable")[: 1 + 2 * len(against)]:
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -upper[i] * z[i]
        if not np.isfinite(z).all():
            continue
        z /= np.abs(z).max()
        z /= math.sqrt(float(z @ z))
        for _ in range(2):
            for other in against:
                z -= (z @ other) * other
        left = math.sqrt(float(z @ z))
        if left > most:
            best, most = z / (left or 1.0), left
        if left > 0.5:
            break
    return best


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues of R'R that are not zero, and their unit
    eigenvectors as rows."""
    d = r.shape[1]
    scale = float(np.abs(r).max(initial=0))
    if not scale:
        return np.zeros(0), np.zeros((0, d))
    a, b, v = bidiagonal(r / scale)
    norm = float(max(np.abs(a).max(), np.abs(b).max(initial=0)))
    a = np.where(np.abs(a) < EPS * norm, EPS * norm, a)  # below rounding, and divided by
    cuts = [0, *(i + 1 for i in range(d - 1) if abs(b[i]) <= EPS * EPS * norm), d]
    pairs = []
    for start, stop in zip(cuts, cuts[1:]):
        own_a, own_b = a[start:stop], b[start : stop - 1]
        pairs += [(x, start, stop) for x in dqds((own_a**2).tolist(), (own_b**2).tolist())]
    pairs.sort(key=lambda x: -x[0])
    floor = pairs[0][0] * (d * EPS) ** 2 * 16
    pairs = [x for x in pairs[:count] if x[0] > floor]
    values, vectors = [], []
    for value, start, stop in pairs:
        near = [z for z, other in zip(vectors, values) if other - value <= 1e-3 * value]
        part = np.zeros(d)
        part[start:stop] = twisted(a[start:stop], b[start : stop - 1], value, [z[start:stop] for z in near])
        values.append(value)
        vectors.append(part)
    rows = np.array(vectors).reshape(len(pairs), d) @ v.T
    rows /= np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return np.array(values) * scale * scale, rows


# The Spark side.


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str, scale: int, offset: int) -> DataFrame:
    """vec_id, x and dim of the rows that take part."""
    unfit = lambda c: F.coalesce(~(F.abs(F.floor(c * scale)) < LARGEST), F.lit(True)) | F.isnan(c)
    own = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    own = own.filter(F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", unfit))
    whole = F.transform("x", lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    return own.select("vec_id", whole.alias("x"), F.size("x").alias("dim"))


def by_length(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """The rows of each length in each block of a batch, with their matrix."""
    for batch in batches:
        for start in range(0, len(batch), BLOCK):
            for dim, rows in batch[start : start + BLOCK].groupby("dim"):
                yield int(dim), rows, np.stack(rows["x"].to_numpy()).astype(np.int64)


class Centre:
    """Size n and sums S of the fit list of one length: S is n * m + r, exactly."""

    def __init__(self, n: int, totals: list[int]):
        self.n = n
        self.m = np.array([t // n for t in totals], dtype=np.int64)
        self.r = np.array([t % n for t in totals], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.m).astype(np.float64) - self.r.astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S)^2 over the dimensions, as whole numbers."""
        high = (self.centred(x) * self.n) ** 2
        if high.sum(axis=1).max(initial=0) < 2.0**62:
            return (((x - self.m) * self.n - self.r) ** 2).sum(axis=1).tolist()
        steps = (x - self.m).astype(object) * self.n - self.r.astype(object)
        totals = (steps**2).sum(axis=1).tolist()
        return [t if t < 1 << 63 else None for t in totals]


def centres_of(fit: DataFrame) -> dict[int, Centre]:
    """The centre of each length. Tasks add up whole numbers; a row per length, dimension
    and task is shuffled."""

    def of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for dim, _, x in by_length(batches):
            own = held.setdefault(dim, [0, np.zeros(dim, dtype=np.int64)])
            own[0] += len(x)
            own[1] += x.sum(axis=0)
        for dim, (n, total) in held.items():
            yield pd.DataFrame({"dim": dim, "at": np.arange(dim), "n": n, "total": total})

    parts = fit.select("dim", "x").mapInPandas(of_task, "dim int, at int, n long, total long")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found: dict[int, list] = {}
    for row in parts.groupBy("dim", "at").agg(F.sum("n").alias("n"), total).collect():
        found.setdefault(row["dim"], []).append((row["at"], row["n"], int(row["total"])))
    return {dim: Centre(rows[0][1], [t for _, _, t in sorted(rows)]) for dim, rows in found.items()}


def as_bytes(rows: np.ndarray) -> bytes:
    return rows.astype("<f8").tobytes()


def triangles(fit: DataFrame, centres) -> DataFrame:
    """A triangle for each task and length, and a number to deal it by."""

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for dim, _, x in by_length(batches):
            own = centres.value[dim].centred(x)
            held[dim] = triangle(np.vstack([held[dim], own]) if dim in held else own)
        for dim, r in held.items():
            yield pd.DataFrame([(dim, as_bytes(r))], columns=["dim", "content"])

    found = fit.select("dim", "x").mapInPandas(reduce, "dim int, content binary")
    return materialize(found.withColumn("part", F.xxhash64("content")), "triangles")


def joined_triangle(rows: pd.DataFrame) -> tuple[int, np.ndarray]:
    dim = int(rows["dim"].iloc[0])
    r = np.zeros((0, dim))
    for content in rows["content"]:
        r = triangle(np.vstack([r, np.frombuffer(content, dtype="<f8").reshape(-1, dim)]))
    return dim, r


def few_triangles(parts: DataFrame) -> DataFrame:
    """The tree: groups of about ``FAN_IN`` triangles become one until few are left."""

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        dim, r = joined_triangle(rows)
        return pd.DataFrame([(dim, as_bytes(r))], columns=["dim", "content"])

    while (most := parts.groupBy("dim").count().agg(F.max("count")).first()[0]) > 2 * FAN_IN:
        groups = F.pmod("part", F.lit(-(-most // FAN_IN))).alias("group")
        smaller = parts.groupBy("dim", groups).applyInPandas(reduce, "dim int, content binary")
        parts = materialize(smaller.withColumn("part", F.xxhash64("content")), "triangles")
    return parts


class Model:
    """The whitening of one length, for blocks of its vectors."""

    def __init__(self, centre: Centre, vectors: list[float], squares: list[float], explained: list[float]):
        self.centre, self.count, self.explained = centre, len(squares), np.array(explained)
        self.across = np.array(vectors).reshape(self.count, len(centre.m)).T
        self.across /= np.sqrt(np.array(squares) / centre.n)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.across


def fitted(fit: DataFrame, components: int) -> dict[int, Model]:
    """The model of each length in ``fit``: as many numbers as directions have."""
    spark = fit.sparkSession
    centres = centres_of(fit)
    parts = few_triangles(triangles(fit, spark.sparkContext.broadcast(centres)))

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        dim, r = joined_triangle(rows)
        squares, vectors = directions(r, components)
        share = squares / float((r**2).sum()) if len(squares) else squares
        row = (dim, vectors.ravel().tolist(), squares.tolist(), share.tolist())
        return pd.DataFrame([row], columns=["dim", "vectors", "squares", "explained"])

    schema = "dim int, vectors array<double>, squares array<double>, explained array<double>"
    solved = parts.groupBy("dim").applyInPandas(solve, schema).collect()
    return {r["dim"]: Model(centres[r["dim"]], r["vectors"], r["squares"], r["explained"]) for r in solved}


def identity_errors(fit: DataFrame, models) -> dict[int, float]:
    """Per length, the largest entry of whitened's covariance over the fit list that is off
    the identity. Tasks sum products of centred values; the sums of all tasks are added."""

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for dim, _, x in by_length(batches):
            w = models.value[dim].whitened(x)
            own = held.setdefault(dim, [np.zeros(w.shape[1]), np.zeros((w.shape[1], w.shape[1]))])
            own[0] += w.sum(axis=0)
            own[1] += w.T @ w
        for dim, (one, two) in held.items():
            i, j = np.indices(two.shape)
            i, j = i.ravel(), j.ravel()
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "a": one[i], "b": one[j], "p": two.ravel()})

    cells = fit.select("dim", "x").mapInPandas(products, "dim int, i int, j int, a double, b double, p double")
    errors: dict[int, float] = {}
    for row in cells.groupBy("dim", "i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("p").alias("p")).collect():
        n = models.value[row["dim"]].centre.n
        off = abs(row["p"] / n - row["a"] / n * (row["b"] / n) - (row["i"] == row["j"]))
        errors[row["dim"]] = max(off, errors.get(row["dim"], 0.0))
    return errors


def shares_of(lengths: list[int], components: int) -> list[list[int]]:
    """The lengths in groups whose models together stay below ``MODEL_BYTES``; a longer one
    is a group by itself."""
    groups, room = [[]], MODEL_BYTES
    for dim in lengths:
        size = 8 * dim * (components + 4)
        if groups[-1] and size > room:
            groups.append([])
            room = MODEL_BYTES
        groups[-1].append(dim)
        room -= size
    return groups


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """A row per vector and component, from 1 by falling eigenvalue: vec_id, component, n
    (vectors of the fit list), deviation, whitened, explained and identity_error."""
    spark = vectors.sparkSession
    rows = materialize(whole_numbers(vectors, vec_id, embedding, scale, offset), "vectors")
    fit = materialize(rows.groupBy("dim", "x").agg(F.lit(1).alias("one")).select("dim", "x"), "fit-list")
    lengths = [r["dim"] for r in fit.select("dim").distinct().orderBy("dim").collect()]
    result = spark.createDataFrame([], WHITENED)
    for group in shares_of(lengths, components) if lengths else []:
        own = F.col("dim").isin(group) if len(group) < len(lengths) else F.lit(True)
        models = spark.sparkContext.broadcast(fitted(fit.filter(own), components))
        errors = identity_errors(fit.filter(own), models)
        result = result.unionByName(projected(rows.filter(own), models, errors))
    return result


def projected(rows: DataFrame, models, errors: dict[int, float]) -> DataFrame:
    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, own, x in by_length(batches):
            model = models.value[dim]
            k = model.count
            yield pd.DataFrame({
                "vec_id": pd.array(own["vec_id"], dtype="Int64").repeat(k),
                "component": np.tile(np.arange(1, k + 1), len(x)),
                "n": model.centre.n,
                "deviation": pd.array(model.centre.deviations(x), dtype="Int64").repeat(k),
                "whitened": model.whitened(x).ravel(),
                "explained": np.tile(model.explained, len(x)),
                "identity_error": errors.get(dim, 0.0),
            })

    return rows.mapInPandas(project, WHITENED)
