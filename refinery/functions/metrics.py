"""Business metrics of one order line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds and labels of the size and revenue classes.
ORDER_SIZES = [(1, "single"), (5, "small"), (20, "medium")]  # bound included
LARGEST_SIZE = "large"
REVENUE_BANDS = [(50, "low"), (500, "medium"), (5000, "high")]  # bound excluded
HIGHEST_BAND = "enterprise"
HIGH_VALUE_ABOVE = 500
MISMATCH_TOLERANCE = 0.01


def line_total() -> Column:
    return F.round(F.col("quantity") * F.col("unit_price"), 2)


def amount_mismatch() -> Column:
    return F.abs(F.col("total_amount") - F.col("calculated_total")) > MISMATCH_TOLERANCE


def discount_amount() -> Column:
    return F.round(F.col("revenue") - F.col("total_amount"), 2)


def discount_rate() -> Column:
    share = (F.col("revenue") - F.col("total_amount")) / F.col("revenue")
    return F.when(F.col("revenue") > 0, F.round(share, 4)).otherwise(0.0)


def average_unit_price() -> Column:
    return F.round(F.col("total_amount") / F.greatest("quantity", F.lit(1)), 2)


def order_size() -> Column:
    return _first_match(
        [(F.col("quantity") <= bound, label) for bound, label in ORDER_SIZES], LARGEST_SIZE
    )


def revenue_band() -> Column:
    return _first_match(
        [(F.col("total_amount") < bound, label) for bound, label in REVENUE_BANDS], HIGHEST_BAND
    )


def is_high_value() -> Column:
    return F.col("total_amount") > HIGH_VALUE_ABOVE


def _first_match(cases: list[tuple[Column, str]], otherwise: str) -> Column:
    chain = F
    for condition, label in cases:
        chain = chain.when(condition, label)
    return chain.otherwise(otherwise)


# Those after the first may use it.
METRICS = {
    "revenue": line_total,
    "discount_amount": discount_amount,
    "discount_rate": discount_rate,
    "avg_unit_price": average_unit_price,
    "is_high_value": is_high_value,
    "order_size_bucket": order_size,
    "revenue_band": revenue_band,
}
METRIC_COLUMNS = list(METRICS)
