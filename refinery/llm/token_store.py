"""Token ids in directly addressable codes.

Each id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every id, level
1 the next chunk of those ids that need one, and so on. A bitmap beside each level says
which of its entries go on in the next, and a rank directory (set bits before every 512th
entry) turns a place in one level into the place in the next. So any id is found by its
position alone, without decoding its neighbours.

A *segment* is one such code over the ids of many documents, as one block of bytes that
describes itself (``pack``, ``Segment``). A store is a table of segments in ascending order
of document: one row per segment with its task, its number in the task and its counts, and
the bytes. Rows are written by Spark's own writer, which any store accepts that Spark does,
and which keeps nothing of tasks that were lost.

Documents are ordered by id, null ids first; rows of equal id by their text. A null text is
empty and holds the end id alone. Repeated rows are stored as often as they come. An empty
table gives an empty store.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refinery.llm.common import shared_bytes, shuffle_partitions, tokenizer_file
from refinery.llm.rank_bpe import byte_letters
from refinery.session import materialize, scratch_path

MAGIC = b"DACIDS01"
BLOCK = 512  # entries for each count in a rank directory
SEGMENT_TOKENS = 1 << 20
SEGMENT_SCHEMA = "task int, segment int, before long, n_docs long, n_tokens long, payload binary"
# Fixed value: how byte-level files split texts before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ONES = np.array([bin(x).count("1") for x in range(256)], dtype=np.int64)


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The segment of ``ids``; document ``doc_ids[i]`` has the next ``lengths[i]`` of them."""
    known = np.array([x is not None for x in doc_ids], dtype=np.uint8)
    named = np.array([x or 0 for x in doc_ids], dtype="<i8")
    ends = np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8")
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        whole = np.zeros(-(-len(bits) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.uint8)
        whole[: len(bits)] = bits
        counts = _ONES[whole].reshape(-1, BLOCK // 8).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
        levels.append((rest.astype(np.uint8), whole, ranks))
        rest = rest[more] >> 8
    head = np.array([len(doc_ids), len(ids), len(levels), *(len(x[0]) for x in levels)], dtype="<i8")
    parts = [MAGIC, head.tobytes(), known.tobytes(), named.tobytes(), ends.tobytes()]
    parts += [x.tobytes() for level in levels for x in level]
    return b"".join(parts)


class Segment:
    """A packed segment: ``segment[i]`` is one id, ``segment.slice(a, b)`` an array of them."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a segment of token ids")
        self.payload, self.at = payload, 8
        docs, tokens, levels = self.take("<i8", 3)
        sizes = self.take("<i8", int(levels))
        self.known = self.take("u1", int(docs)).astype(bool)
        self.named = self.take("<i8", int(docs))
        self.ends = self.take("<i8", int(docs) + 1)
        self.tokens = int(tokens)
        self.levels = []
        for size in sizes.tolist():
            blocks = -(-size // BLOCK)
            self.levels.append((self.take("u1", size), self.take("u1", blocks * BLOCK // 8), self.take("<i8", blocks + 1)))

    def take(self, kind: str, count: int) -> np.ndarray:
        found = np.frombuffer(self.payload, dtype=kind, count=count, offset=self.at)
        self.at += found.nbytes
        return found

    def rank(self, level: int, place: int) -> int:
        """Set bits before ``place``: one directory entry and the bytes of one block."""
        _, bits, ranks = self.levels[level]
        block, byte = place // BLOCK, place // 8
        ones = int(ranks[block]) + int(_ONES[bits[block * BLOCK // 8 : byte]].sum())
        return ones + (int(_ONES[bits[byte] & ((1 << place % 8) - 1)]) if place % 8 else 0)

    def __len__(self) -> int:
        return self.tokens

    def __getitem__(self, place: int) -> int:
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[place]) << (8 * level)
            if not bits[place // 8] >> (place % 8) & 1:
                break
            place = self.rank(level, place)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids of a run of places, each level read only where the run lies."""
        values = np.zeros(max(0, stop - start), dtype=np.uint32)
        which, a, b = np.arange(len(values)), start, stop
        for level, (chunks, bits, _) in enumerate(self.levels):
            if a >= b:
                break
            values[which] |= chunks[a:b].astype(np.uint32) << (8 * level)
            run = np.unpackbits(bits[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
            which = which[run.astype(bool)]
            a, b = self.rank(level, a), self.rank(level, a) + len(which)
        return values

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, place in the segment and token ids of each document."""
        for i in range(len(self.named)):
            a, b = int(self.ends[i]), int(self.ends[i + 1])
            yield (int(self.named[i]) if self.known[i] else None), a, self.slice(a, b)


class ByteEncoder:
    """Ids of a byte-level tokenizers file.

    Where the file is a plain one (texts as they are, the usual pattern, merges in the order
    of their ids, and every entry what its own bytes merge to) its pairs are handed to the
    coder of ``tiktoken``, which gives the same ids from whole texts several times faster and
    keeps nothing of them. Any other file is left to the ``tokenizers`` library.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(content)
        self.library = Tokenizer.from_str(content.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.coder = plain_coder(spec, self.library)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if self.coder is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.coder.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def plain_coder(spec: dict, library):
    """The coder for a plain file, or None."""
    from tiktoken import Encoding

    split, model = spec["pre_tokenizer"] or {}, spec["model"]
    odd = [spec["normalizer"], split.get("add_prefix_space"), model.get("dropout"), model.get("byte_fallback")]
    odd += [model.get("continuing_subword_prefix"), model.get("end_of_word_suffix")]
    odd += [x[flag] for x in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")]
    if any(odd) or split.get("type") != "ByteLevel" or not split.get("use_regex") or model.get("type") != "BPE":
        return None
    vocab, added = model["vocab"], {x["content"]: x["id"] for x in spec["added_tokens"]}
    merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model["merges"]]
    byte = {letter: value for value, letter in enumerate(byte_letters())}
    own = {token: i for token, i in vocab.items() if token not in added}
    if None in merged or merged != sorted(set(merged)) or not all(c in byte for token in own for c in token):
        return None
    if any(len(library.model.tokenize(token)) != 1 for token in own):
        return None  # an entry that merging never reaches, but that a look-up would find
    ranks = {bytes(map(byte.__getitem__, token)): i for token, i in own.items()}
    return Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=added)


_loaded: dict[int, ByteEncoder] = {}


def write_store(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    vocabulary: str | None = None,
    segment_tokens: int = SEGMENT_TOKENS,
) -> None:
    """Encode every text, append ``end_id`` to each, and write the segments to ``path``.

    Texts are dealt out by ranges of their id, encoded where they then lie, and packed in
    that order. A segment ends with the document that brings it to ``segment_tokens``.
    """
    spark = docs.sparkSession
    shared = shared_bytes(spark, vocabulary or tokenizer_file("byte_bpe_50k.json"))
    end = np.array([end_id], dtype="<u4")

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        content = shared.value
        encode = _loaded.get(hash(content)) or _loaded.setdefault(hash(content), ByteEncoder(content))
        task, number = TaskContext.get().partitionId(), 0
        held, names, lengths, size, before = [], [], [], 0, 0
        for batch in batches:
            for known, name, content_text in zip(batch["known"], batch["doc_id"], batch["text"]):
                ids = encode(content_text)
                held += [ids, end]
                names.append(int(name) if known else None)
                lengths.append(len(ids) + 1)
                size += lengths[-1]
                if size >= segment_tokens:
                    yield one(task, number, before, held, names, lengths, size)
                    before, number = before + size, number + 1
                    held, names, lengths, size = [], [], [], 0
        if held:
            yield one(task, number, before, held, names, lengths, size)

    def one(task, number, before, held, names, lengths, size) -> pd.DataFrame:
        row = (task, number, before, len(names), size, pack(np.concatenate(held), names, lengths))
        return pd.DataFrame([row], columns=["task", "segment", "before", "n_docs", "n_tokens", "payload"])

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = named.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(order[0], "text")
    filled = dealt.select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text")
    filled.mapInPandas(segments, SEGMENT_SCHEMA).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The stored segments with ``base``, the number of ids before each.

    A segment says how many ids its task wrote before it, so that only a row per writing task
    is summed and joined: no more rows than the store was written with tasks.
    """
    stored = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    tasks = stored.groupBy(F.col("task").alias("of")).agg(F.sum("n_tokens").alias("all"))
    earlier = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    tasks = materialize(tasks.select("of", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("earlier")), "task-bases")
    joined = stored.join(F.broadcast(tasks), F.col("task") == F.col("of"))
    return joined.select("task", "segment", "payload", (F.col("before") + F.col("earlier")).alias("base"))


def store_report(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the stored segments alone."""

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for base, payload in zip(batch["base"], batch["payload"]):
                rows = [
                    (name, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for name, at, ids in Segment(payload).documents()
                ]
                found = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield found.astype({"doc_id": "Int64"})

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_store(spark, path).select("base", "payload").mapInPandas(documents, schema)


def roundtrip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to a new store and report on what is read back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_store(docs, path, vocabulary=vocabulary)
    return store_report(docs.sparkSession, path)
