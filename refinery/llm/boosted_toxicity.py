"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features of a text are densities of words and word beginnings from a lexicon, how near
second-person words they stand, capitals, punctuation, and signs of obfuscation. The lexicon
is learned from the labels too: entries that are far commoner in toxic texts than in others.
Trees are boosted on four parts of the labelled rows, and the step from their score to a
probability is fitted on a fifth by isotonic regression.

Fitting is bounded: by ``MAX_LABELLED`` labelled rows, chosen by a hash of the id, and by the
``LEXICON`` entries that tell most. With fewer than ``APART`` labelled rows a fifth is too
little to calibrate on, and the steps are fitted on the training rows.

Empty and null texts are scored by their (zero) features, long ones whole. Without labels of
both kinds every score is the share of toxic labels, or 0 without any. A label is 0 or 1;
other values are none. Of several labels of one document the highest counts. Rows are neither
dropped nor merged, repeated ones included; an empty table gives an empty one. The score goes
in place of a column of its name; all other columns may have any name.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import MEMO_ENTRIES, Memo, fold
from refinery.llm.samples import MAX_LABELLED, labelled_texts
from refinery.session import materialize

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)  # lengths of word beginnings in the lexicon
LEXICON = 2_000  # entries, at most
APART = 500  # labelled rows from which on a part of them is kept for calibration
LEAST_TEXTS, LEAST_ODDS = 4, 2.0  # what makes an entry: toxic texts with it, log odds
NEAR = 4  # words between a lexicon word and one for the reader

YOU = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer "
    "tu te ti tes ton ta toi vous votre vos tú tus usted ustedes vosotros vuestro".split()
)
LOOKALIKE = str.maketrans("0134578@$!|+€", "oieastbasiite")

# Classes of the first 256 characters; what follows them counts as letters.
_LOWER, _UPPER, _DIGIT, _SPACE, _PUNCT = 1, 2, 3, 4, 5
_CLASS = np.array(
    [
        _SPACE if c.isspace() else _UPPER if c.isupper() else _DIGIT if c.isdigit() else _LOWER if c.isalpha() else _PUNCT
        for c in map(chr, range(256))
    ],
    dtype=np.int64,
)
FEATURES = 17


def entries(word: str) -> list[str]:
    """The lexicon entries that ``word`` could match: itself, and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) >= n)]


#: Characters of a token that is kept with what was found in it.
LONG = 40


class ToxicFeatures:
    """The dense features of a text under a lexicon of entries and their log odds."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.weight = Memo(self.weigh)
        self.disguise = Memo(self.disguised, MEMO_ENTRIES // 2)

    def weigh(self, word: str) -> float:
        return max((self.lexicon.get(x, 0.0) for x in entries(word)), default=0.0)

    def __call__(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * FEATURES
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        kind = np.where(points < 256, _CLASS[np.minimum(points, 255)], _LOWER)
        n = np.bincount(kind, minlength=6)
        letter = kind <= _UPPER
        chars, letters = len(points), max(1, int(letter.sum()))
        inner = letter[:-2] & ~letter[1:-1] & (kind[1:-1] != _SPACE) & letter[2:]
        inner &= ~np.isin(points[1:-1], (39, 45, 46, 8217))  # ' - . ’ are ordinary there
        triple = letter[2:] & (points[2:] == points[1:-1]) & (points[2:] == points[:-2])
        shout = (points[1:] == 33) & (points[:-1] == 33)

        words = WORD.findall(text.lower())
        count = max(1, len(words))
        weights = list(map(self.weight.__getitem__, words))
        hits = [i for i, w in enumerate(weights) if w]
        whole = sum(1 for i in hits if words[i] in self.lexicon)
        yours = [i for i, w in enumerate(words) if w in YOU]
        near = 0
        if hits and yours:
            gap = np.searchsorted(yours, hits)
            padded = np.array([-math.inf, *yours, math.inf])
            at = np.array(hits)
            near = int(((at - padded[gap] <= NEAR) | (padded[gap + 1] - at <= NEAR)).sum())
        hidden = self.hidden(text)
        return [
            100 * len(hits) / count,
            100 * whole / count,
            math.log1p(len(hits)),
            math.log1p(len({words[i] for i in hits})),
            max((weights[i] for i in hits), default=0.0),
            sum(weights[i] for i in hits) / count,
            100 * hidden / count,
            math.log1p(hidden),
            100 * len(yours) / count,
            100 * near / count,
            n[_UPPER] / letters,
            100 * n[_PUNCT] / chars,
            100 * n[_DIGIT] / chars,
            100 * int(inner.sum()) / count,
            100 * int(triple.sum()) / letters,
            100 * int(shout.sum()) / chars,
            math.log1p(len(words)),
        ]

    def hidden(self, text: str) -> int:
        """Tokens that match the lexicon only after look-alike signs and repeats are undone."""
        tokens = text.lower().split()
        # Long ones are not kept: the memo is bounded in entries, not in characters.
        return sum(self.disguise[x] if len(x) <= LONG else self.disguised(x) for x in tokens)

    def disguised(self, token: str) -> bool:
        token = token.strip(".,;:?!\"'()")
        if token.isalpha() and not re.search(r"(.)\1\1", token):
            return False
        plain = re.sub(r"(.)\1{2,}", r"\1", token.translate(LOOKALIKE))
        plain = "".join(c for c in plain if c.isalpha())
        return bool(plain and self.weight[plain] and not any(self.weight[w] for w in WORD.findall(token)))


def learn_lexicon(sample: DataFrame, size: int = LEXICON) -> dict[str, float]:
    """Entries of the toxic texts of ``sample`` with the highest log odds against the others."""
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    toxic, clean = int(totals["toxic"] or 0), int(totals["n"]) - int(totals["toxic"] or 0)

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, label in zip(batch["text"], batch["label"]):
                for entry in {x for word in set(WORD.findall(text.lower())) for x in entries(word)}:
                    counts.setdefault(entry, [0, 0])[int(label)] += 1
            yield pd.DataFrame([(k, *v) for k, v in counts.items()], columns=["entry", "clean", "toxic"])

    counted = sample.select("text", "label").mapInPandas(present, "entry string, clean long, toxic long")
    counted = counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = counted.filter(F.col("toxic") >= LEAST_TEXTS).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    best = best.orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "entry").limit(size)
    return {r["entry"]: float(r["odds"]) for r in best.select("entry", "odds").collect()}


_features: dict[str, ToxicFeatures] = {}


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: object = None
    steps: object = None
    constant: float = 0.0

    def with_features(self, df: DataFrame, text: str, to: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.lexicon)
        name = uuid.uuid4().hex

        @F.pandas_udf("array<double>")
        def features(texts: pd.Series) -> pd.Series:
            own = _features.get(name)
            if own is None:
                _features.clear()
                own = _features[name] = ToxicFeatures(shared.value)
            return texts.map(own, na_action=None)

        return df.withColumn(to, features(F.col(text)))

    def score(self, df: DataFrame, text: str = "text", to: str = "toxicity") -> DataFrame:
        """``df`` with the probability of label 1 in ``to``. Its columns are put aside as one
        while the models run, so that none of their names can clash."""
        if self.trees is None:
            return df.withColumn(to, F.lit(float(self.constant)))
        row = F.struct(*[F.col(f"`{x}`") for x in df.columns]).alias("row")
        aside = self.with_features(df.select(row), f"row.{text}", "dense")
        raw = self.trees.transform(aside.select("row", array_to_vector("dense").alias("features")))
        raw = raw.select("row", vector_to_array("probability")[1].alias("raw"))
        # Isotonic steps leave ties; a thousandth of the raw score orders them.
        calibrated = self.steps.transform(raw).select(
            "row.*", (0.999 * F.col("prediction") + 0.001 * F.col("raw")).alias(to)
        )
        return calibrated


def learn(docs: DataFrame, labels: DataFrame, where: Column, rows: int = MAX_LABELLED) -> ToxicityModel:
    """A model of the labels for which ``where`` holds (a condition on doc_id)."""
    sample = labelled_texts(docs, labels, F.max(F.when(F.col("toxic").isin(0, 1), F.col("toxic").cast("int"))), where, rows)
    kinds = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if set(kinds) != {0, 1}:
        total = sum(kinds.values())
        return ToxicityModel({}, constant=kinds.get(1, 0) / total if total else 0.0)
    model = ToxicityModel(learn_lexicon(sample))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("calibration")), F.lit(5)).alias("part")
    dense = model.with_features(sample, "text", "dense")
    dense = dense.select(part, F.col("label").cast("double").alias("label"), array_to_vector("dense").alias("features"))
    dense = materialize(dense, "toxic-features").coalesce(8)
    boosted = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, minInstancesPerNode=3, seed=7)
    model.trees = boosted.fit(dense.filter("part > 0"))
    raw = model.trees.transform(dense.filter("part = 0" if sum(kinds.values()) >= APART else "true"))
    raw = raw.select("label", vector_to_array("probability")[1].alias("raw"))
    model.steps = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return model


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted; labels of fold 0 of 5 are not learned from."""
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = learn(docs, labels, ~held)
    scored = model.score(docs.select(F.col("doc_id").cast("long"), "text"), to="score")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    model = learn(docs, labels, F.lit(True))
    aside = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row"), F.col("text"))
    return model.score(aside).filter(F.col("toxicity") < threshold).select("row.*")
