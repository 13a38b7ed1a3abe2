"""Awkward documents that every operator has to cope with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refinery.llm.common import reach_package

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, digest string, row string, label string, key int, node int, keys string, n_tokens string, tails string, dense string, gone string, ids string, decoded string, language string, toxicity string, id string, stay string, rows string, stays string, payload string"

TEXTS = [
    (1, "The cat sat on the mat, and the dog did not mind it at all."),
    (2, "The  cat sat\ton the mat, and the dog did not mind it at all."),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, "x" * 5000),
    (7, "word " * 20000),
    (8, "Ünïcödé ΑΣ 日本語 😀 <|endoftext|> </s> ▁x \x1c \x00 　end"),
    (9, "123 456 --- !!!"),
    (10, "one"),
    (10, "one"),
    (11, "The cat sat on the mat, and the dog did not mind it at all."),
    (None, "a document without an id that has a few words"),
    (None, None),
]


def messy(spark: SparkSession) -> DataFrame:
    reach_package(spark)
    extra = ["a", "b", "c", "d", 1, 2, *"efghijklmnopqr"]
    rows = [(i, t, "en" if i and i % 2 else None, f"s{(i or 0) % 3}" if i != 9 else None, None, *extra) for i, t in TEXTS]
    return spark.createDataFrame(rows, COLUMNS)


def empty(spark: SparkSession) -> DataFrame:
    return messy(spark).limit(0)


def texts_of(folder: str) -> list[tuple]:
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
