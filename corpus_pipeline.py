"""From raw documents to packed training data, as stages of Spark jobs.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All
but the last return the columns of the documents they were given.

``python corpus_pipeline.py TABLES OUT`` writes the packed pieces of TABLES/documents.parquet
to OUT.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import boosted_toxicity, conflict_packing, digest_index, ordinal_quality, piece_count, tensor_dedup
from refinery.llm.common import table
from refinery.session import delete, open_session, scratch_path, temporary

#: Tokens in a bin of the last stage.
CONTEXT = 4096


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of less than 0.5."""
    return boosted_toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of at least the middle grade with a probability of 0.5 or more."""
    return ordinal_quality.select_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return digest_index.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 on five-word shingles, that of the smallest id."""
    return tensor_dedup.drop_near(docs, words=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin of ``CONTEXT`` tokens, and the place in it, of every piece of every document."""
    counted = piece_count.count_tokens(docs.select("doc_id", "text", "source"))
    return conflict_packing.pack(counted, length=F.col("n_tokens"), capacity=CONTEXT)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: Trained models, links and best-fit bins are beyond SQL; the tests hold each stage against
#: a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``, each stored and read again.

    What a stage has stored on its way goes when the stage ends, and its result when the next
    one has been stored; that of the last stage is left for the caller, who may run this
    inside ``temporary``.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with temporary(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs


if __name__ == "__main__":
    session = open_session("corpus")
    with temporary(session):
        run(session, sys.argv[1]).write.parquet(sys.argv[2])
