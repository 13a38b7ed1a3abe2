"""The fact table: surrogate-key lookups, metrics and the reports over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import metrics
from refinery.functions.dates import date_key
from refinery.functions.numbers import sum_cents
from refinery.operators.cleaning import stamp
from refinery.schemas import FACT_SALES


def with_customer_key(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Left lookup. No broadcast is forced in any of these joins: a dimension grows with
    the data, so Spark decides by the size of the stored table or of the shuffled side,
    and otherwise sorts, merges and splits hot keys adaptively."""
    return rows.join(customers.select("customer_id", "customer_sk"), "customer_id", "left")


def with_customer_key_in_place(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """The same lookup as a merge of tables that are bucketed alike by customer: neither
    is moved, whatever its size (``publish_bucketed``)."""
    lookup = customers.select("customer_id", "customer_sk").hint("merge")
    return rows.join(lookup, "customer_id", "left")


def with_product_key(rows: DataFrame, products: DataFrame) -> DataFrame:
    return rows.join(products.select("product_id", "product_sk"), "product_id", "left")


def with_region_key(rows: DataFrame, regions: DataFrame) -> DataFrame:
    lookup = regions.select(F.col("region_name").alias("region"), "region_sk")
    return rows.join(lookup, "region", "left")


def with_date_key(rows: DataFrame) -> DataFrame:
    """The key is a function of the date, so no join is needed to find it."""
    return rows.withColumn("date_sk", date_key("order_date"))


def with_date_key_lookup(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """The same through the calendar: null also where the calendar lacks the date."""
    return rows.join(calendar.select("order_date", "date_sk"), "order_date", "left")


def on_days(fact: DataFrame, calendar: DataFrame, *columns: str) -> DataFrame:
    """The fact rows of the days in ``calendar``, a filtered date dimension, with ``columns``
    of theirs.

    The month columns of the fact are its partitions, so they are joined as well as the key:
    the days that are left tell Spark, when the query runs, which partitions to read."""
    days = calendar.select("date_sk", F.col("year").alias("_year"), F.col("month").alias("_month"), *columns)
    same = (fact["order_year"] == F.col("_year")) & (fact["order_month"] == F.col("_month"))
    same &= fact["date_sk"] == days["date_sk"]
    return fact.join(days, same).select(*[fact[c] for c in fact.columns], *columns)


def with_metrics(rows: DataFrame) -> DataFrame:
    first, *others = metrics.METRICS.items()
    priced = rows.withColumn(first[0], first[1]())
    return priced.withColumns({name: metric() for name, metric in others})


def build_fact(
    clean: DataFrame,
    dims: Mapping[str, DataFrame],
    run_at: datetime | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """One fact row per clean row. Where dimensions are too large to be broadcast, rows are
    moved for the customer first: the lines of an order stay side by side and compress.
    ``partition_by`` brings rows together by these columns before the metrics are added, which
    then are not moved; such a fact is written as ``dealt``."""
    rows = with_region_key(clean, dims["dim_region"])
    rows = with_customer_key(rows, dims["dim_customer"])
    rows = with_product_key(rows, dims["dim_product"])
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows = with_metrics(with_date_key(rows))
    return stamp(rows, "processed_at_gold", run_at).select(*FACT_SALES.names)


def revenue_by_band(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("revenue_band")
        .agg(F.count("*").alias("orders"), sum_cents("revenue").alias("total_revenue"))
        .orderBy("revenue_band")
    )


def orders_by_month(fact: DataFrame, first: int | None = None) -> DataFrame:
    """Rows per month, undated ones first; ``first`` keeps the earliest so many months."""
    months = fact.groupBy("order_year", "order_month").count()
    ordered = months.orderBy("order_year", "order_month")
    return ordered if first is None else ordered.limit(first)
