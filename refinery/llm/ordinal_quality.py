"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a set of hashed tokens: its words, its runs of signs, and a few tokens for its
shape. One weight for each hash value gives ``eta``, and ordered thresholds, shared by all
texts, turn it into probabilities of the grades: P(grade > k) = sigmoid(eta - theta_k).
Weights and thresholds are fitted together, by the likelihood of the grades, on a bounded
sample of labelled rows. Selection is by a tail probability, P(grade >= least).

Grades are whole numbers from 0, given as an expression over the labels of one document.
``label_grade``, that of the queries: 0 for quality 0, 1 for quality 1 in a toxic text, 2 for
quality 1 otherwise; of several labels of one document the lowest grade counts, and other
values of quality are no labels. Labels without a document, or without a grade, take no part.

Empty and null texts have no tokens but that of their emptiness; long ones are read whole.
Without labels, or with one grade only, nothing can be told: every tail probability is 1 (all
are kept). Rows are neither dropped nor merged, repeated ones included, but by
``select_quality``, which drops what isn't selected; an empty table gives an empty one.
``grade_column`` puts its result in place of a column of that name; elsewhere other columns
may have any name.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import Memo, fold
from refinery.llm.samples import labelled_texts

BITS = 18
#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 10_000
TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+|\d+")


def shape(text: str, tokens: list[str], different: int) -> list[str]:
    """Tokens for properties of the whole text, in steps."""
    count = len(tokens) or 1
    lines = text.split("\n")
    signs = sum(1 for t in tokens if not t[0].isalnum())
    repeats = sum(map(str.__eq__, tokens, tokens[1:]))
    capitals = sum(map(str.isupper, tokens))
    return [
        f"\0different {10 * different // count}",
        f"\0signs {10 * signs // count}",
        f"\0repeats {20 * repeats // count}",
        f"\0capitals {10 * capitals // count}",
        f"\0lines {10 * len(set(lines)) // len(lines)}",
        f"\0width {min(20, len(text) // count)}",
        f"\0size {count.bit_length()}",
    ]


def _place(token: str) -> int:
    return zlib.crc32(token.encode()) & ((1 << BITS) - 1)


_places = Memo(_place)


def hashed(text: str | None) -> np.ndarray:
    """The hash values of the different tokens of a text."""
    if not text:
        return np.array([_place("\0empty")])
    tokens = TOKEN.findall(text)
    words = {*map(str.lower, tokens)}
    own = [*words, *shape(text, tokens, len(words))]
    return np.fromiter(map(_places.__getitem__, own), dtype=np.int64, count=len(own))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class CumulativeLink:
    """Weights by hash value, and thresholds in ascending order; none, if nothing was fitted."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts) -> np.ndarray:
        """P(grade > k) for each text and threshold k."""
        eta = np.array([self.weights[h].sum() / np.sqrt(len(h)) for h in map(hashed, texts)])
        return sigmoid(eta.reshape(-1, 1) - self.thresholds)


def fit(texts, grades: np.ndarray, **settings) -> CumulativeLink:
    """``fit_sets`` on the token sets of texts."""
    return fit_sets([hashed(t) for t in texts], grades, **settings)


def fit_sets(sets: list[np.ndarray], grades: np.ndarray, rounds: int = 80, rate: float = 0.05, ridge: float = 1e-4) -> CumulativeLink:
    """Maximum likelihood with a ridge, by Adam over all rows at once.

    The first threshold is free, and each further one lies exp(gap) above that before it,
    which keeps them in order.
    """
    levels = int(grades.max(initial=0)) + 1
    if len(np.unique(grades)) < 2:
        return CumulativeLink(np.zeros(1 << BITS, dtype=np.float32), np.zeros(0))
    sizes = np.array([len(s) for s in sets])
    row, col = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    scale = np.repeat(1 / np.sqrt(sizes), sizes)
    used, col = np.unique(col, return_inverse=True)
    at_least = np.array([(grades > k).mean() for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    start = -np.log(at_least / (1 - at_least))
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    point = np.concatenate([np.zeros(len(used)), start[:1], gaps])
    mean, square = np.zeros_like(point), np.zeros_like(point)
    for step in range(1, rounds + 1):
        w, theta = point[: len(used)], point[len(used)] + np.concatenate([[0], np.cumsum(np.exp(point[len(used) + 1 :]))])
        eta = np.bincount(row, weights=w[col] * scale, minlength=len(sets))
        upper = sigmoid(np.concatenate([theta, [40.0]])[grades] - eta)
        lower = sigmoid(np.concatenate([[-40.0], theta])[grades] - eta)
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        slope = (up - low) / len(sets)  # of the loss, by eta
        by_theta = np.bincount(grades, weights=-up, minlength=levels)[:-1] + np.bincount(grades, weights=low, minlength=levels)[1:]
        by_theta /= len(sets)
        by_gap = np.cumsum(by_theta[::-1])[::-1]
        by_gap[1:] *= np.exp(point[len(used) + 1 :])
        grad = np.concatenate([np.bincount(col, weights=slope[row] * scale, minlength=len(used)) + ridge * w, by_gap])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        point = point - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[used] = point[: len(used)]
    theta = point[len(used)] + np.concatenate([[0], np.cumsum(np.exp(point[len(used) + 1 :]))])
    return CumulativeLink(weights, theta)


def label_grade() -> Column:
    return F.min(F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2)))


def learn(docs: DataFrame, labels: DataFrame, where: Column, rows: int = FIT_ROWS, grade: Column | None = None) -> CumulativeLink:
    """A model of the labels for which ``where`` holds (a condition on doc_id).

    Texts become sets of hash values in the tasks; the driver gets those of the sample, at
    most 2^18 numbers for each text however long it is."""
    sample = labelled_texts(docs, labels, label_grade() if grade is None else grade, where, rows)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = [hashed(t).astype("<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"].astype("int64"), "content": contents})

    found = sample.select("text", "label").mapInPandas(sets, "label long, content binary").toArrow()
    own = [np.frombuffer(x.as_buffer(), dtype="<i4") for x in found["content"]]
    return fit_sets(own, found["label"].to_numpy())


_models: dict[str, CumulativeLink] = {}


def grade_column(df: DataFrame, model: CumulativeLink, text: str = "text", to: str = "tails") -> DataFrame:
    """``df`` with the array of P(grade > k) of each text, empty if nothing was fitted."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    @F.pandas_udf("array<double>")
    def tails(texts: pd.Series) -> pd.Series:
        own = _models.get(name)
        if own is None:
            _models.clear()
            own = _models[name] = shared.value
        return pd.Series(list(own.tails(texts)), index=texts.index, dtype=object)

    return df.withColumn(to, tails(F.col(text)))


def expected_grade(tails: str) -> Column:
    return F.aggregate(F.col(tails), F.lit(0.0), lambda total, x: total + x)


def tail(tails: str, least: int) -> Column:
    """P(grade >= least); 1 where the model has no such grade."""
    return F.coalesce(F.try_element_at(F.col(tails), F.lit(least)), F.lit(1.0))


def quality_report(docs: DataFrame, labels: DataFrame, least: int = 1, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_prob and selected; labels of fold 0 of 5 are not
    learned from."""
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = learn(docs, labels, ~held)
    scored = grade_column(docs.select(F.col("doc_id").cast("long"), "text"), model)
    graded = scored.select("doc_id", held.alias("held_out"), expected_grade("tails").alias("expected_grade"), tail("tails", least).alias("tail_prob"))
    return graded.withColumn("selected", F.col("tail_prob") >= threshold)


def select_quality(docs: DataFrame, labels: DataFrame, least: int = 1, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with P(grade >= least) of at least ``threshold``, with their columns."""
    model = learn(docs, labels, F.lit(True))
    aside = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), F.col("text"))
    return grade_column(aside, model).filter(tail("tails", least) >= threshold).select("row.*")
