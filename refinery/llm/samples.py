"""A bounded sample of labelled rows, for fitting a classifier.

Only fitting may use it: whatever is scored is scored over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.session import materialize

#: Labelled rows that a classifier is fitted on, at most.
MAX_LABELLED = 20_000


def labelled_texts(docs: DataFrame, labels: DataFrame, value: Column, where: Column, rows: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text and ``value`` (as ``label``) of at most ``rows`` labelled documents.

    ``value`` is an aggregate over the labels of one document; documents without one, or for
    which ``where`` does not hold, are left out. The rows taken are those of the smallest
    hash of the id, whatever the size of the input. Their ids are so few that they can be
    sent to all tasks, which spares shuffling the texts of all documents.
    """
    usable = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    usable = usable.agg(value.alias("label")).filter(where & F.col("label").isNotNull())
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = materialize(chosen.select(F.col("doc_id").alias("id"), "label"), "labelled-ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    return materialize(found.select("doc_id", "text", "label"), "labelled")
