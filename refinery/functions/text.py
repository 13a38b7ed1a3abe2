"""Text standardisation: padding, case and broken encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# UTF-8 punctuation and letters that were once decoded as Windows-1252,
# with their repair. The two-character quote must follow the longer ones it prefixes.
ENCODING_REPAIRS = [
    ("â€™", "'"),
    ("â€œ", '"'),
    ("â€", '"'),
    ("Ã©", "é"),
    ("\x00", ""),
]

# What is matched regardless of case, and what only loses its padding.
LOWERED_COLUMNS = ["category", "status", "region"]
TRIMMED_COLUMNS = ["order_id", "customer_id", "product_id", "customer_name", "product_name"]


def repair_encoding(text: Column | str, lowered: bool = False) -> Column:
    """Undo the known mis-decodings by literal replacement, in order.

    ``lowered`` says the text has already been lower-cased: lowering also changes the
    broken sequences, so they are looked for in that form. Text without any character
    they start with, which is nearly all of it, is only scanned for those. The repair is a
    lambda, which Spark keeps out of the loop that it generates for a stage: the JVM does
    not compile a loop of more than 8,000 bytes, and the repairs of eight columns over a
    wide projection are beyond that.
    """
    text = F.col(text) if isinstance(text, str) else text
    repairs = [(b.lower() if lowered else b, right) for b, right in ENCODING_REPAIRS]

    def repaired(broken_text: Column) -> Column:
        for broken, right in repairs:
            broken_text = F.replace(broken_text, F.lit(broken), F.lit(right))
        return broken_text

    suspect = F.lit(False)
    for first in sorted({broken[0] for broken, _ in repairs}):
        suspect = suspect | F.contains(text, F.lit(first))
    return F.when(suspect, F.get(F.transform(F.array(text), repaired), F.lit(0))).otherwise(text)


def trimmed(column: str) -> Column:
    return repair_encoding(F.trim(column))


def trimmed_lower(column: str) -> Column:
    return repair_encoding(F.lower(F.trim(column)), lowered=True)
