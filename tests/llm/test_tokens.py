from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from refinery.llm import piece_count, rank_bpe, token_store
from refinery.llm.queries import QUERIES
from refinery.session import scratch_path
from tests.conftest import TABLES
from tests.llm.cases import empty, messy, texts_of

PIECES = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
WORDS = Tokenizer.from_file(path("word_bpe_49k.json"))
BYTES = Tokenizer.from_file(path("byte_bpe_50k.json"))

ODD = [
    "", " ", "   ", "  a", "a  b ", "▁x ▁ ▁▁y", "日本𠀀 x\x00", "É́ é", "ΑΣ ΣΑΣ", "a<|endoftext|> b<|startoftext|>",
    "<s> </s>", "a\tb\nc\x1cd\x85e", "'S it's I'LL 123 ½²", "x" * 3000, "ab" * 700, "İI", "é" * 300 + " 😀😀", " " * 40 + "z",
    "a <|endoftext|> b", "\n\n  a\n b", "don't  stop\r\n", "ǅ ﬁ", "a　b c", "x \x1cy",
]


def noise(count: int) -> list[str]:
    source, letters = random.Random(3), "aeiou tsn.,'▁ \n\té日<|>ΣÀ1２"
    return ["".join(source.choice(letters) for _ in range(source.randint(1, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts():
    return ODD + noise(500) + [t for _, t in texts_of(TABLES)]


def content(name: str) -> bytes:
    with open(path(name), "rb") as file:
        return file.read()


def test_counts_are_those_of_the_library(texts):
    counter = piece_count.PieceCounter(content("piece_bpe_32k.model"))
    assert [counter(t) for t in texts] == [len(PIECES.encode(t)) for t in texts]
    assert counter(None) == 0


def test_codes_are_those_of_the_library(texts):
    coder = rank_bpe.RankCoder(content("word_bpe_49k.json"))
    for text in texts:
        ids = WORDS.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids
        assert coder.decode(ids) == WORDS.decode(ids, skip_special_tokens=False)


def test_long_words_merge_like_short_ones(monkeypatch):
    coder = rank_bpe.RankCoder(content("word_bpe_49k.json"))
    word = "banananationalisationsandstrength" * 7
    scanned = coder.encode_word(word)
    monkeypatch.setattr(rank_bpe, "SCAN_LIMIT", 0)
    assert coder.encode_word(word) == scanned


def test_byte_ids_are_those_of_the_library(texts):
    encoder = token_store.ByteEncoder(content("byte_bpe_50k.json"))
    for text in texts:
        assert np.frombuffer(encoder(text), "<u4").tolist() == BYTES.encode(text, add_special_tokens=False).ids


def test_segments_give_access_to_every_id():
    ids = np.random.RandomState(0).randint(0, 1 << 20, 3000).astype(np.uint32)
    ids[::3] %= 200
    segment = token_store.Segment(token_store.pack(ids, [5, None, 7], [1000, 0, 2000]))
    assert [segment[i] for i in range(len(segment))] == ids.tolist()
    assert (segment.slice(511, 2051) == ids[511:2051]).all()
    assert [(d, a, x.tolist()) for d, a, x in segment.documents()] == [
        (5, 0, ids[:1000].tolist()), (None, 1000, []), (7, 1000, ids[1000:].tolist())
    ]
    with pytest.raises(IndexError):
        segment[3000]


def test_count_query(spark):
    found = {r["doc_id"]: r for r in QUERIES["op3_piece_count"](spark, TABLES).collect()}
    assert len(found) == len(texts_of(TABLES))
    for doc_id, text in texts_of(TABLES):
        n = len(PIECES.encode(text))
        assert tuple(found[doc_id])[1:] == (len(text.encode()), n, n > 4096)


def test_coding_query(spark):
    found = {r["doc_id"]: r for r in QUERIES["op8_rank_bpe"](spark, TABLES).collect()}
    for doc_id, text in texts_of(TABLES):
        ids = WORDS.encode(text, add_special_tokens=False).ids
        back = WORDS.decode(ids, skip_special_tokens=False)
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def plain_store(rows):
    start = 0
    for doc_id, text in rows:
        ids = BYTES.encode(text or "", add_special_tokens=False).ids + [0]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_store_query(spark):
    found = sorted(map(tuple, QUERIES["op9_token_store"](spark, TABLES).collect()))
    assert found == list(plain_store(texts_of(TABLES)))


def test_store_of_many_small_segments(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    folder = scratch_path(spark, "small-segments")
    token_store.write_store(docs, folder, segment_tokens=500)
    found = sorted(map(tuple, token_store.store_report(spark, folder).collect()))
    assert found == list(plain_store(texts_of(TABLES)))


def test_awkward_rows(spark):
    docs = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counted = sorted(((r["doc_id"] or -1, r["n_tokens"]) for r in piece_count.count_report(docs).collect()))
    assert counted == sorted((i or -1, len(PIECES.encode(t or ""))) for i, t in rows)
    coded = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rank_bpe.coding_report(docs).collect())
    assert coded == sorted((i or -1, len(WORDS.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    stored = sorted((tuple(r) for r in token_store.roundtrip(docs).collect()), key=lambda r: r[1])
    assert sorted(r[2:] for r in stored) == sorted(r[2:] for r in plain_store(ordered))
    assert [r[0] for r in stored] == [r[0] for r in ordered]
    assert [r[1] for r in stored] == [sum(x[2] for x in stored[:i]) for i in range(len(stored))]


def test_columns_of_ids_and_back(spark):
    docs = messy(spark)
    both = rank_bpe.decode_column(rank_bpe.encode_column(docs, to="codes"), ids="codes", to="back")
    assert set(docs.columns) < set(both.columns)
    for row in both.collect():
        ids = WORDS.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["codes"] == ids and row["back"] == WORDS.decode(ids, skip_special_tokens=False)


def test_no_rows(spark):
    none = empty(spark)
    assert piece_count.count_report(none).count() == 0
    assert rank_bpe.coding_report(none).count() == 0
    assert token_store.roundtrip(none).count() == 0


def test_memos_are_bounded_in_bytes():
    """Texts without spaces, as in Chinese, are not kept; nor do short words pile up."""
    source = random.Random(1)
    texts = ["".join(chr(source.randrange(0x4E00, 0x9FA5)) for _ in range(source.choice((40, 2000)))) for _ in range(5000)]
    counter, coder = piece_count.PieceCounter(content("piece_bpe_32k.model")), rank_bpe.RankCoder(content("word_bpe_49k.json"))
    memos = [counter.word, coder.word, coder.chunk, coder.coded_word, coder.coded_chunk]
    for memo in memos:
        memo.budget = memo.room = 200_000
    for text in texts:
        counter(text), coder.encode(text), coder.coded(text)
        for memo in memos:
            for half in (memo, memo.older):
                assert sum(4 * len(k) + 160 + memo.size(v) for k, v in half.items()) <= 200_000
    assert all(len(k) <= 64 for memo in memos for k in [*memo, *memo.older])


def test_coded_texts_are_ids_and_their_decoding(texts):
    coder = rank_bpe.RankCoder(content("word_bpe_49k.json"))
    for text in [None, *texts]:
        ids = coder.encode(text)
        assert coder.coded(text) == (len(ids), " ".join(map(str, ids)), coder.decode(ids))


def test_other_vocabularies_are_refused():
    import json

    spec = json.loads(content("word_bpe_49k.json"))
    for change in ({"normalizer": None}, {"decoder": {"type": "ByteLevel"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError, match="only vocabularies"):
            rank_bpe.RankCoder(json.dumps(spec | change).encode())
    with pytest.raises(ValueError, match="only vocabularies"):
        rank_bpe.RankCoder(content("byte_bpe_50k.json"))


def test_plain_byte_files_go_to_the_quick_coder_and_others_to_the_library(texts):
    import json

    spec = json.loads(content("byte_bpe_50k.json"))
    assert token_store.ByteEncoder(content("byte_bpe_50k.json")).coder is not None
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other = token_store.ByteEncoder(json.dumps(spec).encode())
    assert other.coder is None
    library = Tokenizer.from_str(json.dumps(spec))
    for text in texts[:40]:
        assert other(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_column_of_the_target_name_is_replaced(spark):
    docs = messy(spark).select("doc_id", "text", "n_tokens", "ids", "decoded")
    counted = piece_count.count_tokens(docs)
    assert counted.columns.count("n_tokens") == 1 and dict(counted.dtypes)["n_tokens"] == "bigint"
    both = rank_bpe.decode_column(rank_bpe.encode_column(docs))
    assert dict(both.dtypes)["ids"] == "array<int>" and both.filter("decoded = 'k'").count() == 0
    assert [r["n_tokens"] for r in both.select("n_tokens").distinct().collect()] == ["f"]
