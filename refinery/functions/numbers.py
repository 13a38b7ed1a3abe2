"""Numbers from text, and sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_int(text: Column | str) -> Column:
    """Whole number in ``text``, decimals cut off; null when it is not a number."""
    text = F.col(text) if isinstance(text, str) else text
    decimal = F.contains(text, F.lit(".")) & text.rlike(r"^\s*[+-]?\d+\.\d*\s*$")
    whole = F.when(decimal, F.substring_index(text, ".", 1)).otherwise(text)
    return whole.try_cast("int")


def parse_double(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return text.try_cast("double")


def sum_cents(amount: Column | str) -> Column:
    """Sum of amounts that carry at most two decimals, rounded to two.

    Adding doubles gives a different last digit for every task order, so the sum runs
    over decimals. Amounts no such decimal can hold are added as doubles.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    exact = amount.try_cast("decimal(20,2)")
    beyond = F.sum(F.when(exact.isNull(), amount))
    return F.round(F.coalesce(F.sum(exact).cast("double") + beyond, F.sum(exact).cast("double"), beyond), 2)
