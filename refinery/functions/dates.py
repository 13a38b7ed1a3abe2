"""Order dates written in several formats, and the calendar parts derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unify_date_text(raw: Column | str) -> Column:
    """Without padding and with one separator."""
    return F.replace(F.trim(raw), F.lit("/"), F.lit("-"))


def date_parts(text: Column | str) -> Column:
    """The pieces between the separators."""
    return F.split(F.ltrim(text, F.lit(" \t")), "-")


def date_from_parts(parts: Column, day_first: bool = False) -> Column:
    """The date the pieces spell, or null.

    Year-first text is unambiguous. Year-last text is read month-first unless its first
    number can only be a day; ``day_first`` turns that preference round. A year has four
    digits, and whatever follows the date (a time, a remark) is ignored.

    The length of the first piece picks the reading, so one cast is tried per row and
    hardly any fails: a failed parse raises and catches inside Spark, which costs more
    than all the rest of the step.
    """
    first, second, rest = (F.get(parts, F.lit(i)) for i in range(3))
    if day_first:
        first_is_day = ~_beyond_twelve(second)
    else:
        first_is_day = _beyond_twelve(first)
    month = F.when(first_is_day, second).otherwise(first)
    day = F.when(first_is_day, first).otherwise(second)
    year_last = _dashed(F.regexp_extract(rest, r"^\d{4}(?!\d)", 0), month, day)
    year_first = _dashed(first, second, F.regexp_extract(rest, r"^\d{1,2}(?!\d)", 0))
    return (
        F.when(F.length(first) == 4, year_first)
        .when(F.length(first) <= 2, year_last)
        .try_cast("date")
    )


def _beyond_twelve(number: Column) -> Column:
    return (F.length(number) == 2) & (number > "12")


def _dashed(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, F.lit("-"), month, F.lit("-"), day)


def date_key(date: Column | str) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
