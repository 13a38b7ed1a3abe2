"""What the planner makes of the operators."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from refinery.operators import checks, cleaning, dimensions, fact, publish
from refinery.plans.catalog import QUERIES
from refinery.plans.refine import refine
from refinery.plans.star import build_star
from refinery.schemas import CLEAN, PARTITION_COLUMNS
from refinery.session import materialize
from refinery.sources.derived_orders import raw_orders
from refinery.sources.files import write_table
from tests.conftest import TABLES, plan_of


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(raw_orders(spark, TABLES), "raw")


@pytest.fixture(scope="module")
def clean(raw):
    return materialize(refine(raw), "clean")


@pytest.fixture(scope="module")
def star(clean):
    return build_star(clean)


def exchanges(plan: str) -> int:
    tree = plan.split("\n\n")[0]
    return sum("Exchange" in line and "Broadcast" not in line for line in tree.splitlines())


def test_refine_shuffles_once_and_filters_before(raw):
    plan = plan_of(refine(raw))
    assert exchanges(plan) == 1
    assert "partial_min" in plan
    tree = plan.split("\n\n")[0]
    assert tree.rindex("Filter") > tree.rindex("Exchange")


def test_no_python_in_any_plan(raw, star):
    for df in [refine(raw), *star.values()]:
        assert "Python" not in plan_of(df)


def test_no_dimension_passes_through_one_task(star):
    for df in star.values():
        assert "SinglePartition" not in plan_of(df)


def test_dimension_rows_are_reduced_by_hash_before_the_shuffle(clean):
    versions = dimensions.attribute_versions(clean, "customer_id", ["customer_name", "region"])
    plan = plan_of(versions)
    assert "partial_max" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<customer_id:string,customer_name:string,region:string,order_date:date>" in plan


def test_fact_reads_only_its_columns(star):
    plan = plan_of(star["fact_sales"])
    assert "order_date_raw" not in plan and "product_name" not in plan


def test_small_stored_dimensions_are_broadcast_by_size(star, clean, settings):
    dims = {k: v for k, v in star.items() if k != "fact_sales"}
    assert plan_of(fact.build_fact(clean, dims)).count("BroadcastHashJoin LeftOuter") >= 3
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(fact.build_fact(clean, dims))
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_month_filter_reads_only_its_partitions(clean, tmp_path):
    table = publish.publish(clean, CLEAN, f"{tmp_path}/t", PARTITION_COLUMNS)
    plan = plan_of(table.filter((F.col("order_year") == 1997) & (F.col("order_month") <= 6)))
    assert "PartitionFilters: [isnotnull(order_year" in plan


def test_a_large_partition_is_written_by_many_tasks(spark, clean, tmp_path, settings):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    month = F.length("region") * 0
    one_month = clean.withColumns({"order_year": month + 2024, "order_month": month + 1})
    write_table(materialize(one_month.repartition(8), "month"), f"{tmp_path}/t", PARTITION_COLUMNS)
    assert len(spark.read.parquet(f"{tmp_path}/t").inputFiles()) > 1


def test_hot_values_are_counted_before_the_orphan_join(clean, star, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(checks.check_orphans(clean, {"customer_id": star["dim_customer"].select("customer_id")}))
    tree = plan.split("\n\n")[0]
    join = next(i for i, line in enumerate(tree.splitlines()) if "LeftAnti" in line)
    assert any("HashAggregate" in line for line in tree.splitlines()[join:])


def test_checks_scan_once(star):
    plan = plan_of(checks.quality_summary(star["fact_sales"]))
    assert plan.split("\n\n")[0].count("Scan parquet") <= 4  # the fact and its three lookups


def test_a_hot_business_key_leaves_each_task_as_one_row(spark, raw):
    hot = raw.withColumns({"order_id": F.lit("O"), "product_id": F.lit("P")}).repartition(8)
    kept = cleaning.keep_one_per_key(hot)
    assert kept.count() == 1
    assert "partial_min" in plan_of(kept)


def test_a_hot_customer_is_split_when_the_dimension_is_too_large_to_broadcast(
    clean, star, settings
):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
    )
    hot = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3)) == 0
    rows = materialize(
        clean.withColumn("customer_id", F.when(hot, "CUST0000001").otherwise(F.col("customer_id")))
        .repartition(8),
        "hot",
    )
    keyed = fact.with_customer_key(rows, star["dim_customer"])
    assert len(keyed.collect()) == rows.count()
    assert "SortMergeJoin(skew=true)" in plan_of(keyed)


def test_an_upsert_plans_to_read_only_touched_partitions(clean, tmp_path):
    table = publish.publish(clean, CLEAN, f"{tmp_path}/t", PARTITION_COLUMNS)
    folders = ["order_year=1997/order_month=3", "order_year=__HIVE_DEFAULT_PARTITION__/order_month=__HIVE_DEFAULT_PARTITION__"]
    touched = table.filter(publish._folder(PARTITION_COLUMNS).isin(folders))
    assert "PartitionFilters: [concat_ws" in plan_of(touched)
    assert touched.select(F.input_file_name()).distinct().count() == 2


@pytest.mark.parametrize("query", ["require_keys", "refine_rough"])
def test_no_generated_loop_is_too_long_for_the_jvm_to_compile(spark, settings, query):
    """Beyond 8,000 bytes a method is interpreted, which takes several times as long."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="2k")
    with contextlib.redirect_stdout(io.StringIO()) as text:
        QUERIES[query](spark, TABLES).explain("codegen")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) <= 8000
