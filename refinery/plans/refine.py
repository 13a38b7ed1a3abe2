"""Raw order text to the clean table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.operators import cleaning
from refinery.schemas import CLEAN


def refine(
    raw: DataFrame,
    run_at: datetime | None = None,
    day_first: bool = False,
    blank_is_missing: bool = True,
    padded_keys_differ: bool = False,
    stored: bool = False,
) -> DataFrame:
    """Deduplicate, require keys, standardise, parse, fill, flag and derive.

    One shuffle, for the deduplication; the rest is a projection over its result. The
    filter on the business key applies to whole groups, so Catalyst moves it before the
    shuffle. The one on the customer stays behind it, for a missing customer decides
    which duplicate is kept. Keys that differ in padding alone are one key, or the result
    would hold it twice; ``padded_keys_differ`` compares them as written. ``stored`` says
    that ``raw`` is a stored table: then only keys and the rows that share one are shuffled.
    """
    rows = raw if padded_keys_differ else cleaning.clean_keys(raw)
    rows = cleaning.keep_one_per_stored_key(rows) if stored else cleaning.keep_one_per_key(rows)
    rows = cleaning.require_keys(rows, blank_is_missing=blank_is_missing)
    rows = cleaning.clean_text(rows)
    rows = cleaning.parse_dates(rows, day_first)
    rows = cleaning.cast_numbers(rows)
    rows = cleaning.fill_defaults(rows)
    rows = cleaning.flag_missing_dates(rows)
    rows = cleaning.flag_amount_mismatch(rows)
    rows = cleaning.add_order_period(rows)
    rows = cleaning.stamp(rows, "processed_at", run_at)
    return rows.select(*[F.col(c) for c in CLEAN.names])
