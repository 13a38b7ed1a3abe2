"""Language identification: known words first, shorter and shorter character n-grams after.

Every word that was seen in learning has a log frequency in each language. A word that was
not seen is scored by its 4-grams (with marks at both ends), by its 3-grams if none of those
is known, and so on down to single characters. The scores of all words of a text are added;
``score`` is the share of the best language in the softmax of the sums, each divided by the
square root of the number of words, as words of one text are far from independent.

Texts that are null or hold no letter are ``und`` with score 0; so are all texts if nothing
could be learned. Ties go to the language first in order. Long texts are read whole. Rows
are neither dropped nor merged, repeated ones included; an empty table gives an empty one.
``language_column`` puts its result in place of a column of that name; all other columns may
have any name.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import MEMO_ENTRIES, fold
from refinery.session import materialize

WORD = re.compile(r"[^\W\d_]+")
LONGEST_GRAM = 4

#: Documents of each language that are learned from, about; they are whole, and taken by the
#: hash of their id.
DOCS_PER_LANGUAGE = 10_000
#: Numbers for each count that a table of all languages may have.
DENSE = 8
#: Numbers a worker keeps of the words met lately: one for each word and language.
MEMO_NUMBERS = 8_000_000

COUNTED = pa.schema([("lang", pa.string()), ("key", pa.large_string()), ("size", pa.int32()), ("n", pa.int64())])


def grams(word: str, size: int) -> list[str]:
    marked = f"^{word}$" if size > 1 else word
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


class Keys:
    """Places of strings in the order of their checksums, in a few arrays: a dict takes many
    times the memory, and every worker holds one."""

    def __init__(self, keys: pa.LargeStringArray):
        content, ends = bytes(keys.buffers()[2] or b""), np.frombuffer(keys.buffers()[1] or bytes(8), dtype=np.int64)
        ends = ends[keys.offset : keys.offset + len(keys) + 1]
        parts = [content[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
        sums = np.fromiter(map(zlib.crc32, parts), dtype=np.uint32, count=len(parts))
        #: Where the keys given stand in the order of places.
        self.order = np.argsort(sums, kind="stable")
        sums = sums[self.order]
        # Plain arrays: single entries of theirs are read faster than those of numpy's.
        self.sums = array("I", sums.tobytes())
        self.content = b"".join([parts[i] for i in self.order])
        self.starts = array("Q", np.concatenate([[0], np.cumsum(np.diff(ends)[self.order])]).astype(np.uint64).tobytes())
        bits = min(32, len(parts).bit_length())
        self.shift = 32 - bits
        #: The first place for each value of the leading bits.
        self.first = array("Q", np.searchsorted(sums, np.arange(1 << bits, dtype=np.uint64) << np.uint64(self.shift)).astype(np.uint64).tobytes())

    def __len__(self) -> int:
        return len(self.sums)

    def get(self, key: str) -> int | None:
        content = key.encode()
        wanted = zlib.crc32(content)
        at, sums = self.first[wanted >> self.shift], self.sums
        while at < len(sums) and sums[at] <= wanted:
            if sums[at] == wanted and self.content[self.starts[at] : self.starts[at + 1]] == content:
                return at
            at += 1
        return None

    def __getitem__(self, key: str) -> int:
        found = self.get(key)
        if found is None:
            raise KeyError(key)
        return found


class Logs:
    """Log frequencies in every language, from the counts there are: a row for each place.
    Rows of many languages are made when they are asked for, as most of their counts are 0."""

    def __init__(self, places: np.ndarray, languages: np.ndarray, counts: np.ndarray, keys: int, width: int):
        order = np.argsort(places, kind="stable")
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=keys))])
        self.languages = languages[order].astype(np.min_scalar_type(width))
        self.counts = counts[order].astype(np.min_scalar_type(max(counts, default=0)))
        self.all = np.bincount(languages, counts, minlength=width) + 0.5 * keys + 1
        self.unseen = np.log(0.5 / self.all)
        self.rows = None
        if keys * width <= DENSE * len(counts):
            seen = np.zeros((keys, width))
            seen[places, languages] = counts
            self.rows = np.log((seen + 0.5) / self.all)
            self.starts = self.languages = self.counts = None

    def __getitem__(self, place: int | list[int]) -> np.ndarray:
        if self.rows is not None:
            return self.rows[place]
        if isinstance(place, list):
            return np.array([self[x] for x in place])
        part = slice(self.starts[place], self.starts[place + 1])
        at, row = self.languages[part], self.unseen.copy()
        row[at] = np.log((self.counts[part] + 0.5) / self.all[at])
        return row


class LanguageModel:
    """Log frequencies of words and n-grams, by language; all that were counted are kept."""

    def __init__(self, counts: pa.Table | list[tuple[str, str, int, int]]):
        """``counts``: language, word or n-gram, its length (0 for words), occurrences."""
        if not isinstance(counts, pa.Table):
            counts = pa.table([pa.array([x[i] for x in counts], kind) for i, kind in enumerate(COUNTED.types)], schema=COUNTED)
        counts = counts.cast(COUNTED)
        self.languages = sorted(pc.unique(counts["lang"]).to_pylist())
        self.tables: list[Keys] = []
        self.logs: list[Logs] = []
        for size in range(LONGEST_GRAM + 1):
            own = counts.filter(pc.equal(counts["size"], size))
            coded = pa.chunked_array(own["key"].chunks, pa.large_string()).combine_chunks().dictionary_encode()
            keys = Keys(coded.dictionary)
            places = np.empty(len(keys), dtype=np.int64)
            places[keys.order] = np.arange(len(keys))
            del keys.order
            at = pc.index_in(own["lang"], pa.array(self.languages, pa.string())).to_numpy()
            self.tables.append(keys)
            self.logs.append(Logs(places[coded.indices.to_numpy()], at, own["n"].to_numpy(), len(keys), len(self.languages)))

    def word(self, word: str) -> np.ndarray:
        found = self.tables[0].get(word)
        if found is not None:
            return self.logs[0][found]
        for size in range(LONGEST_GRAM, 0, -1):
            known = [p for g in grams(word, size) if (p := self.tables[size].get(g)) is not None]
            if known:
                return self.logs[size][known].mean(axis=0)
        return np.zeros(len(self.languages))


class LanguageScorer:
    """A model with the scores of words met lately, as rows of one array."""

    def __init__(self, model: LanguageModel, entries: int = MEMO_ENTRIES):
        self.model = model
        self.entries = min(entries, max(1, MEMO_NUMBERS // max(1, len(model.languages))))
        self.rows = np.zeros((1024, max(1, len(model.languages))))
        self.place = _Places(self)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not self.model.languages or not any(any(map(str.isalpha, w)) for w in words):
            return "und", 0.0
        if len(self.place) >= self.entries:
            self.place.clear()
        at = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
        total = self.rows[at].sum(axis=0) / math.sqrt(len(words))
        share = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(share[best] / share.sum())


class _Places(dict):
    def __init__(self, scorer: LanguageScorer):
        super().__init__()
        self.scorer = scorer

    def __missing__(self, word: str) -> int:
        scorer, at = self.scorer, len(self)
        if at == len(scorer.rows):
            scorer.rows = np.concatenate([scorer.rows, np.zeros_like(scorer.rows)])
        scorer.rows[at] = scorer.model.word(word)
        self[word] = at
        return at


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """A model of the rows of ``docs`` that have a text and a language.

    Words are counted in each task and then by language; those and their n-grams come to the
    driver, all of them: the sample of documents is what bounds them.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel([])
    steps = 1 << 20
    parts = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, math.ceil(steps * min(1, per_language / n)))])
    taken = rows.filter(F.pmod(F.xxhash64(F.coalesce("id", F.lit(""))), F.lit(steps)) < parts[F.col("lang")])

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for language, content in zip(batch["lang"], batch["text"]):
                counts.setdefault(language, Counter()).update(WORD.findall(content.lower()))
            if sum(map(len, counts.values())) > MEMO_ENTRIES:
                yield frame(counts)
                counts = {}
        yield frame(counts)

    def frame(counts: dict) -> pd.DataFrame:
        rows = [(language, key, n) for language, own in counts.items() for key, n in own.items()]
        return pd.DataFrame(rows, columns=["lang", "key", "n"])

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for language, key, n in zip(batch["lang"], batch["key"], batch["n"]):
                for size in range(1, LONGEST_GRAM + 1):
                    for g in grams(key, size):
                        counts[language, g, size] += n
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "key", "size", "n"])

    found = taken.select("lang", "text").mapInPandas(words, "lang string, key string, n long")
    found = materialize(found.groupBy("lang", "key").agg(F.sum("n").alias("n")), "words")
    parted = found.mapInPandas(pieces, "lang string, key string, size int, n long")
    parted = parted.groupBy("lang", "key", "size").agg(F.sum("n").alias("n"))
    both = found.withColumn("size", F.lit(0)).unionByName(parted)
    return LanguageModel(both.select("lang", "key", "size", "n").toArrow())


_scorers: dict[str, LanguageScorer] = {}


def language_column(df: DataFrame, model: LanguageModel, text: str = "text", to: str = "language") -> DataFrame:
    """``df`` with a struct ``to`` of lang_pred and score."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        scorer = _scorers.get(name)
        if scorer is None:
            _scorers.clear()
            scorer = _scorers[name] = LanguageScorer(shared.value)
        return pd.DataFrame([scorer(x) for x in texts], columns=["lang_pred", "score"])

    return df.withColumn(to, predict(F.col(text)))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score; documents of fold 2 of 4 are not learned from."""
    held: Column = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = learn(docs.filter(~held))
    scored = language_column(docs.select("doc_id", "text"), model)
    return scored.select(F.col("doc_id").cast("long"), held.alias("held_out"), "language.*")
