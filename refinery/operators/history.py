"""What the attributes of an id were, and when: intervals, and lookups as of a date.

A dimension holds one set of attributes per id. Joining all sets that an id ever had
multiplies the fact; an interval per set and a lookup by date does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def history(
    rows: DataFrame, key: str, attributes: Sequence[str], day: str = "order_date"
) -> DataFrame:
    """One row per id and stretch of days over which its attributes stay the same: key,
    attributes, ``version`` (from 1), ``valid_from`` and ``valid_to`` (inclusive; null while
    it lasts).

    The attributes of a day are the highest of those seen on it, null ones first. Days without
    rows belong to the stretch before them. Rows without a day count only for ids that have no
    other; their one version has no ``valid_from``. Rows are reduced to one per id and day,
    merged before the shuffle, so an id with a third of all rows is a row per day and task.
    """
    seen = rows.groupBy(key, F.col(day).alias("_day")).agg(F.max(F.struct(*attributes)).alias("_state"))
    order = Window.partitionBy(key).orderBy(F.col("_day").asc_nulls_first())
    # Undated rows come first. They stand for an id if nothing follows.
    last = F.lead("_state").over(order).isNull() & (F.row_number().over(order) == 1)
    seen = seen.withColumn("_alone", last).filter(F.col("_day").isNotNull() | F.col("_alone"))
    before = F.lag("_state").over(order)
    first = F.row_number().over(order) == 1
    starts = seen.withColumn("_starts", first | ~before.eqNullSafe(F.col("_state"))).filter("_starts")
    return starts.select(
        key,
        *[F.col(f"_state.{a}").alias(a) for a in attributes],
        F.row_number().over(order).alias("version"),
        F.col("_day").alias("valid_from"),
        F.date_sub(F.lead("_day").over(order), 1).alias("valid_to"),
    )


def as_of(
    rows: DataFrame,
    intervals: DataFrame,
    key: str,
    columns: Sequence[str],
    day: str = "order_date",
) -> DataFrame:
    """``rows`` with ``columns`` of the interval that holds its day: one row each, whatever
    the number of versions; null where the id has no history.

    A row before the first interval takes the first one, a row without a day the last. The
    intervals of an id do not overlap and leave no day out, so at most one fits. The join is
    on the key, where Spark splits a hot one, and the day decides among the few intervals.
    """
    order = Window.partitionBy(key).orderBy(F.col("valid_from").asc_nulls_first())
    forever = F.lit("9999-12-31").cast("date")
    sides = intervals.select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(f"_{c}") for c in columns],
        F.when(F.row_number().over(order) > 1, F.col("valid_from")).alias("_from"),
        F.coalesce("valid_to", forever).alias("_to"),
    )
    at = F.coalesce(F.col(day), forever)
    fits = (F.col(key) == F.col("_key")) & _from_on(at) & (at <= F.col("_to"))
    joined = rows.join(sides, fits, "left").drop("_key", "_from", "_to")
    named = [c for c in rows.columns if c not in columns]
    return joined.select(*named, *[F.col(f"_{c}").alias(c) for c in columns])


def _from_on(at: Column) -> Column:
    return F.col("_from").isNull() | (F.col("_from") <= at)
