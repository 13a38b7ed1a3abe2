"""Token counts by heap-and-linked-list byte-pair merging.

A text becomes symbols, one for each character; the adjacent pair of the lowest rank
(leftmost among equals) is merged until no pair is in the vocabulary. The count is the
number of symbols less the number of merges, plus the bytes that stand in for characters
outside the vocabulary. No identifiers are made.

No piece of the vocabulary has a word mark after another character (checked on loading),
so merges never cross from one word into the next: each word is counted by itself, and
the counts of words met lately are kept.

Null texts count as empty and have no tokens. Rows are neither dropped nor merged, so
repeated rows and null ids keep their own result, and an empty table gives an empty one.
The count goes into the column that the caller names, in place of one of that name if there
is one; all other columns stay as they are. Texts of any length are counted whole: one
without spaces is a single word, which takes n log n steps and is not kept.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import MEMO_BYTES, WordMemo, shared_bytes, tokenizer_file

MARK = "▁"  # stands for a space inside pieces


class PieceCounter:
    """Counts the tokens that a sentencepiece BPE model with byte fallback would give."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor()
        processor.LoadFromSerializedProto(model)
        if processor.Normalize(" ﬁ\t") != f"{MARK}{MARK}ﬁ\t":
            raise ValueError("only models that keep texts as they are, with a leading mark")
        self.rank: dict[str, float] = {}
        for i in range(processor.vocab_size()):
            if not (processor.IsByte(i) or processor.IsControl(i) or processor.IsUnknown(i)):
                piece = processor.IdToPiece(i)
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses words")
                self.rank[piece] = -processor.GetScore(i)
        self.word = WordMemo(lambda word: self.merge(MARK + word), lambda count: 28, 2 * MEMO_BYTES)

    def merge(self, text: str) -> int:
        rank = self.rank.get
        part: list[str | None] = list(text)
        size = len(part)
        heap = []
        for i in range(size - 1):
            pair = part[i] + part[i + 1]
            if (at := rank(pair)) is not None:
                heap.append((at, i, pair))
        heapify(heap)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        merges = 0
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if part[i] is None or j >= size or part[i] + part[j] != pair:
                continue  # one of the two has been merged meanwhile
            merges += 1
            part[i], part[j] = pair, None
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                if (at := rank(wider := pair + part[k])) is not None:
                    heappush(heap, (at, i, wider))
            h = before[i]
            if h >= 0 and (at := rank(wider := part[h] + pair)) is not None:
                heappush(heap, (at, h, wider))
        unknown = sum(len(x.encode()) - 1 for x in part if x and len(x) == 1 and x not in self.rank)
        return size - merges + unknown

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            return sum(map(self.word.__getitem__, words))
        total, marks = 0, 0
        for word in words:  # several spaces in a row belong to the word after them
            if word and not marks:
                total += self.word[word]
            elif word:
                total += self.merge(MARK * (marks + 1) + word)
                marks = 0
            else:
                marks += 1
        return total + (self.merge(MARK * marks) if marks else 0)


_loaded: dict[int, PieceCounter] = {}


def count_tokens(df: DataFrame, text: str = "text", to: str = "n_tokens", model: str | None = None) -> DataFrame:
    """``df`` with the number of tokens of each text in a column ``to``."""
    shared = shared_bytes(df.sparkSession, model or tokenizer_file("piece_bpe_32k.model"))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        content = shared.value
        counter = _loaded.get(hash(content)) or _loaded.setdefault(hash(content), PieceCounter(content))
        return texts.map(counter, na_action=None).astype("int64")

    return df.withColumn(to, count(F.col(text)))


def count_report(docs: DataFrame, limit: int = 4096, model: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row."""
    counted = count_tokens(docs.select("doc_id", "text"), model=model)
    return counted.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
