"""Surrogate keys, dimensions, fact and reports."""

from __future__ import annotations

from datetime import date

from hypothesis import HealthCheck, given
from hypothesis import settings as bounds
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from refinery.operators import dimensions, fact
from refinery.operators.keys import dense_key, dense_key_of_versions
from refinery.plans.refine import refine
from refinery.plans.star import CONTRACTS, build_star
from refinery.session import materialize
from refinery.sources.derived_orders import raw_orders
from tests.conftest import TABLES, rows_of
from tests.test_cleaning import raw_frame


def ranked(frame, key="k"):
    rank = F.dense_rank().over(Window.orderBy(F.asc_nulls_first(key))).cast("long")
    return frame.withColumn("sk", rank)


def test_keys_follow_string_order_nulls_first(spark):
    frame = spark.createDataFrame([(v,) for v in ["CUST9", "CUST10", None, "CUST100"]], "k string")
    keys = {r["k"]: r["sk"] for r in dense_key(frame, "k", "sk").collect()}
    assert keys == {None: 1, "CUST10": 2, "CUST100": 3, "CUST9": 4}


def test_numbering_leaves_its_input_as_it_was(spark):
    frame = spark.createDataFrame([("b",), ("a",)], "k string")
    assert rows_of(dense_key(frame, "k", "sk")) == rows_of(dense_key(frame, "k", "sk"))
    assert frame.schema.names == ["k"]


def test_keys_equal_a_global_rank_over_many_tasks(spark, settings):
    settings(
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="13",
    )
    frame = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"))
    keyed = dense_key(frame, "k", "sk")
    assert keyed.select(F.shiftright("sk", 0)).distinct().count() == 5000
    assert rows_of(keyed) == rows_of(ranked(frame))


@bounds(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.one_of(st.none(), st.text("aé\U0001f600 Z0", max_size=4)), max_size=30))
def test_keys_of_any_text(spark, keys):
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    assert rows_of(dense_key(frame, "k", "sk")) == rows_of(ranked(frame))


def test_versions_share_their_key(spark):
    frame = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 2), (None, 1), ("c", 3)], "k string, v int"
    )
    assert rows_of(dense_key_of_versions(frame, "k", "sk").select("k", "v", "sk")) == rows_of(
        ranked(frame)
    )


def conflicting(spark):
    return refine(
        raw_frame(
            spark,
            {"order_id": "O1", "region": "north", "order_date": "2024-01-05"},
            {"order_id": "O2", "region": "south", "order_date": "2024-03-05"},
            {"order_id": "O3", "region": "west", "order_date": None},
            {"order_id": "O4", "customer_id": "C0", "region": "atlantis", "order_date": None},
        )
    )


def test_one_customer_row_with_the_latest_attributes(spark):
    customers = dimensions.dim_customer(conflicting(spark))
    assert rows_of(customers) == [(1, "C0", "Ann", "atlantis"), (2, "C1", "Ann", "south")]


def test_all_versions_on_request(spark):
    customers = dimensions.dim_customer(conflicting(spark), all_versions=True)
    assert rows_of(customers.select("customer_sk", "region")) == [
        (1, "atlantis"), (2, "north"), (2, "south"), (2, "west"),
    ]


def test_regions(spark):
    regions = dimensions.dim_region(conflicting(spark))
    assert rows_of(regions) == [
        (1, "atlantis", "ATLANTIS", "Unknown Zone"),
        (2, "north", "NORTH", "North Zone"),
        (3, "south", "SOUTH", "South Zone"),
        (4, "west", "WEST", "West Zone"),
    ]
    renamed = dimensions.dim_region(conflicting(spark), {"atlantis": "Sea"})
    assert {r["geo_zone"] for r in renamed.collect()} == {"Sea", "Unknown Zone"}


def test_calendar(spark):
    days = ["2024-03-02", "2024-03-03", "2024-03-01", "2024-02-29", "2024-12-31", "2021-01-01"]
    rows = refine(
        raw_frame(spark, {"order_id": "none", "order_date": "?"},
                  *[{"order_id": d, "order_date": d} for d in days])
    )
    calendar = {r["order_date"]: r for r in dimensions.dim_date(rows).collect()}
    assert len(calendar) == len(days)
    leap = calendar[date(2024, 2, 29)]
    assert (leap["date_sk"], leap["month_name"], leap["day_name"]) == (20240229, "February", "Thursday")
    assert (leap["is_month_end"], leap["is_month_start"], leap["quarter"]) == (True, False, 1)
    assert calendar[date(2024, 3, 1)]["is_month_start"]
    assert calendar[date(2024, 3, 2)]["is_weekend"] and calendar[date(2024, 3, 2)]["day_of_week"] == 7
    assert calendar[date(2024, 3, 3)]["is_weekend"] and calendar[date(2024, 3, 3)]["day_of_week"] == 1
    assert calendar[date(2024, 12, 31)]["week_of_year"] == 1
    assert calendar[date(2021, 1, 1)]["week_of_year"] == 53


def test_star_of_the_generated_orders(spark):
    clean = materialize(refine(raw_orders(spark, TABLES)), "clean")
    star = build_star(clean)
    for name, df in star.items():
        assert df.columns == CONTRACTS[name].names
    sales = star["fact_sales"]
    assert sales.count() == clean.count()
    nulls = sales.filter("customer_sk is null or product_sk is null or region_sk is null").count()
    assert nulls == 0
    assert sales.filter("date_sk is null").count() == clean.filter("is_date_missing").count()
    by_lookup = fact.with_date_key_lookup(clean, star["dim_date"])
    assert rows_of(by_lookup.groupBy("date_sk").count()) == rows_of(
        sales.groupBy("date_sk").count()
    )


def test_result_does_not_depend_on_input_order(spark, settings):
    raw = materialize(raw_orders(spark, TABLES), "raw")
    expected = rows_of(build_star(refine(raw))["fact_sales"].drop("processed_at", "processed_at_gold"))
    settings(spark__sql__shuffle__partitions="3")
    turned = raw.orderBy(F.xxhash64(*raw.columns)).repartition(4)
    again = build_star(refine(turned))["fact_sales"].drop("processed_at", "processed_at_gold")
    assert rows_of(again) == expected


def test_reports(spark):
    rows = fact.with_metrics(conflicting(spark))
    assert rows_of(fact.revenue_by_band(rows)) == [("low", 4, 40.0)]
    months = fact.orders_by_month(rows).collect()
    assert [tuple(r) for r in months] == [(None, None, 2), (2024, 1, 1), (2024, 3, 1)]
    assert fact.orders_by_month(rows, first=1).count() == 1
