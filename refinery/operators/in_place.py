"""Choosing rows of stored tables by where they lie, so that only addresses are moved.

An address is a hash of the file's path and the row's number in the file, which Spark's Parquet
reader gives. Addresses become bits, 1,024 rows to a block, that are sent to all tasks: some
0.2 bytes per row of the table. A row that would have been moved with all its columns is then
kept or passed over where it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.session import materialize

#: Rows of a table up to which its addresses are sent to all tasks, as about 200 MB of bits.
IN_PLACE_ROWS = 1_000_000_000

_WORDS = 16
_BLOCK = 64 * _WORDS


def addressed(rows: DataFrame) -> DataFrame:
    """``rows``, projected or filtered from a stored Parquet table, with ``_file`` and ``_row``.
    A table of a thousand files has two with one hash in 1 of 10^13 cases."""
    return rows.withColumns({"_file": F.xxhash64("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def bits_of(addresses: DataFrame) -> DataFrame:
    """A set of addresses as stored blocks of bits; repeated ones count once."""
    blocks = addresses.select("_file", F.expr(f"_row DIV {_BLOCK}").alias("_block"), "_row")
    words = [
        F.expr(f"bit_or(IF(_row DIV 64 % {_WORDS} = {word}, shiftleft(1L, CAST(_row % 64 AS INT)), 0L))")
        for word in range(_WORDS)
    ]
    # Dealt out before they are merged: a task that holds few rows of a block would move all its words.
    dealt = blocks.repartition("_file", "_block")
    return materialize(dealt.groupBy("_file", "_block").agg(F.array(*words).alias("_bits")), "bits")


def chosen(rows: DataFrame, bits: DataFrame, keep: bool = True) -> DataFrame:
    """The rows of a stored table that are at the addresses in ``bits``, or else the others."""
    here = addressed(rows).withColumn("_block", F.expr(f"_row DIV {_BLOCK}"))
    marked = here.join(F.broadcast(bits), ["_file", "_block"], "left")
    word = F.get("_bits", F.expr(f"CAST(_row DIV 64 % {_WORDS} AS INT)"))
    hit = F.coalesce(F.getbit(word, F.expr("CAST(_row % 64 AS INT)")) == 1, F.lit(False))
    return marked.filter(hit if keep else ~hit).select(*rows.columns)
