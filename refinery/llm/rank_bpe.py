"""BPE encoding and decoding with a contiguous rank array.

A word is held as one string with a list of part boundaries and a list of the ranks of
adjacent parts. The lowest rank is found by scanning the list, the boundary between its
two parts is deleted, and the ranks on either side are looked up again. Words of more than
``SCAN_LIMIT`` symbols, for which repeated scans would take quadratic time, find their
lowest rank through a heap instead; the merges, and so the result, are the same.

A null text is empty: no tokens, and an empty text after decoding. Rows are neither
dropped nor merged, and an empty table gives an empty one. The result goes into the column
that the caller names, in place of one of that name if there is one; all other columns stay
as they are. Long texts are coded whole; what a worker keeps of words is bounded in bytes.

Only vocabularies that treat texts as this module does can be read: one with another
normaliser, another way to split, or a decoder is refused.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import chain, repeat

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import WordMemo, shared_bytes, tokenizer_file

SCAN_LIMIT = 256
WORD_BYTES, CHUNK_BYTES = 512 << 20, 256 << 20  # of what a worker keeps, as estimated

#: The number of ids, the ids joined by spaces, and what they decode to.
Coded = tuple[int, str, str]
BITS = 10  # of a merge, for the length of its left part
LEFT = (1 << BITS) - 1
NO_RANK = 1 << 60

# White space as the vocabulary's own pattern has it, and that pattern.
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")

# How the vocabularies that this module reads treat texts.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


def verify(spec: dict) -> None:
    """Refuse a vocabulary that treats texts otherwise: its ids would be others."""
    model, split, letters = spec["model"], *((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}])[:2]
    alike = [
        (spec["normalizer"] or {}).get("normalizers") == NORMALIZERS,
        len((spec["pre_tokenizer"] or {}).get("pretokenizers", [])) == 2,
        split.get("type") == "Split" and split.get("pattern") == SPLIT,
        split.get("behavior") == "Removed" and split.get("invert") is True,
        letters.get("type") == "ByteLevel" and not letters.get("use_regex") and not letters.get("add_prefix_space"),
        spec["decoder"] is None,
        model.get("type") == "BPE" and bool(model.get("end_of_word_suffix")),
        not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
        not any(x[flag] for x in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")),
    ]
    if not all(alike):
        raise ValueError("only vocabularies that lower-case, split and write bytes as this module does")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each of the 256 bytes.

    Fixed rule: printable bytes stand for themselves, the others take the code points from
    256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def ids_size(ids: tuple[int, ...]) -> int:
    """Bytes of a tuple of ids; the numbers are those of the vocabulary."""
    return 40 + 8 * len(ids)


def coded_size(found: Coded) -> int:
    return 160 + len(found[1]) + 2 * len(found[2])


def joined(parts: list[Coded]) -> Coded:
    return sum([x[0] for x in parts]), " ".join([x[1] for x in parts]), " ".join([x[2] for x in parts])


class RankCoder:
    """Encodes and decodes as a tokenizers file with word ends, lower case and byte letters."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        verify(spec)
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): at for at, pair in enumerate(model["merges"])}
        #: By what a merge gives: its rank, and in the last bits the length of its left part.
        self.merges = {a + b: at << BITS | len(a) for (a, b), at in self.ranks.items()}
        if len(self.merges) < len(self.ranks) or max(map(len, self.merges), default=0) > LEFT:
            raise ValueError("two merges give one entry, or one of more letters than are counted")
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added = added
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.first_letters = {x[:2] for x in added}
        self.token = dict(zip(self.ids.values(), self.ids)) | {i: x for x, i in added.items()}
        self.numbers = {i: str(i) for i in self.token}
        self.letters = dict(enumerate(byte_letters()))
        # A use of the coder fills one pair of these.
        self.word = WordMemo(self.encode_word, ids_size, WORD_BYTES)
        self.chunk = WordMemo(self.encode_chunk, ids_size, CHUNK_BYTES)
        self.coded_word = WordMemo(self.code_word, coded_size, WORD_BYTES)
        self.coded_chunk = WordMemo(self.code_chunk, coded_size, CHUNK_BYTES)

    def encode_word(self, word: str) -> tuple[int, ...]:
        letters = word.encode().decode("latin-1").translate(self.letters)
        if len(letters) > SCAN_LIMIT:
            return self.encode_long(letters)
        text, merge_of = letters + self.end, self.merges.get
        cut = [*range(len(letters)), len(text)]
        # All parts are single letters at first, so any entry of two of them is their merge.
        rank = list(map(merge_of, map(text.__getitem__, map(slice, cut, cut[2:])), repeat(NO_RANK)))
        while rank and (least := min(rank)) < NO_RANK:
            i = rank.index(least)
            del cut[i + 1], rank[i]
            if i < len(rank):
                x, y, z = cut[i : i + 3]
                found = merge_of(text[x:z], NO_RANK)
                rank[i] = found if found & LEFT == y - x else NO_RANK
            if i:
                x, y, z = cut[i - 1 : i + 2]
                found = merge_of(text[x:z], NO_RANK)
                rank[i - 1] = found if found & LEFT == y - x else NO_RANK
        return tuple([self.ids[text[a:b]] for a, b in zip(cut, cut[1:])])

    def encode_long(self, letters: str) -> tuple[int, ...]:
        part: list[str | None] = [*letters[:-1], letters[-1] + self.end]
        size, rank = len(part), self.ranks.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(size - 1) if (r := rank((part[i], part[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if part[i] != left or j >= size or part[j] != right:
                continue
            part[i], part[j] = left + right, None
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                if (r := rank((part[i], part[k]))) is not None:
                    heappush(heap, (r, i, part[i], part[k]))
            h = before[i]
            if h >= 0 and (r := rank((part[h], part[i]))) is not None:
                heappush(heap, (r, h, part[h], part[i]))
        return tuple([self.ids[x] for x in part if x is not None])

    def words(self, chunk: str) -> list[str]:
        """The words of text without spaces. Letters are lowered one by one, without regard
        to the end of a word, hence the sigma."""
        plain = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return WORDS.findall(plain)

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.word.__getitem__, self.words(chunk))))

    def code_word(self, word: str) -> Coded:
        """How many ids a word has, those as text, and what they decode to."""
        ids = self.encode_word(word)
        return len(ids), " ".join(map(self.numbers.__getitem__, ids)), self.decode(ids)

    def code_chunk(self, chunk: str) -> Coded:
        """The same for text without spaces, put together from its words."""
        parts = list(map(self.coded_word.__getitem__, self.words(chunk)))
        return parts[0] if len(parts) == 1 else joined(parts)

    def chunks(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """The text as added tokens (true, and that one) and chunks between spaces."""
        if self.split is None or not any(x in text for x in self.first_letters):
            yield False, text.split(" ")
            return
        for part in self.split.split(text):
            yield (True, [part]) if part in self.added else (False, part.split(" "))

    def encode(self, text: str | None) -> list[int]:
        found: list[int] = []
        for added, parts in self.chunks(text or ""):
            found += [self.added[parts[0]]] if added else chain.from_iterable(map(self.chunk.__getitem__, parts))
        return found

    def coded(self, text: str | None) -> Coded:
        """The number of ids of a text, its ids joined by spaces, and what they decode to.
        Chunk by chunk, as both join what the chunks give."""
        found: list[Coded] = []
        for added, parts in self.chunks(text or ""):
            if added:
                found.append((1, str(self.added[parts[0]]), parts[0]))
            else:
                found += map(self.coded_chunk.__getitem__, parts)
        return joined([x for x in found if x[0]])

    def decode(self, ids: Sequence[int]) -> str:
        """The tokens joined by spaces, which is what a vocabulary without a decoder gives."""
        return " ".join(map(self.token.__getitem__, ids))


_loaded: dict[int, RankCoder] = {}


def coder(content: bytes) -> RankCoder:
    return _loaded.get(hash(content)) or _loaded.setdefault(hash(content), RankCoder(content))


def encode_column(df: DataFrame, text: str = "text", to: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` with the ids of each text in an array column ``to``."""
    shared = shared_bytes(df.sparkSession, vocabulary or tokenizer_file("word_bpe_49k.json"))

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        return texts.map(coder(shared.value).encode, na_action=None)

    return df.withColumn(to, encode(F.col(text)))


def decode_column(df: DataFrame, ids: str = "ids", to: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``df`` with the text of each array of ids in a column ``to``; null ids give an empty text."""
    shared = shared_bytes(df.sparkSession, vocabulary or tokenizer_file("word_bpe_49k.json"))

    @F.pandas_udf("string")
    def decode(arrays: pd.Series) -> pd.Series:
        back = coder(shared.value).decode
        return arrays.map(lambda x: "" if x is None else back(x.tolist() if hasattr(x, "tolist") else x), na_action=None)

    return df.withColumn(to, decode(F.col(ids)))


def coding_report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text of each row.

    Encodes, decodes the ids, and digests both in one pass, so that neither the ids nor the
    decoded text leave the task.
    """
    shared = shared_bytes(docs.sparkSession, vocabulary or tokenizer_file("word_bpe_49k.json"))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        own = coder(shared.value)
        rows = []
        for text in texts:
            count, ids, decoded = own.coded(text)
            rows.append((count, sha256(ids), sha256(decoded)))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = docs.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
