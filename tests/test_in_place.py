"""What moves less must give the same rows."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from refinery.functions import metrics
from refinery.operators import cleaning, fact, in_place, publish
from refinery.plans import catalog
from refinery.plans.star import build_dims
from refinery.schemas import BUSINESS_KEY, PARTITION_COLUMNS
from refinery.session import materialize, packed, scratch_path
from refinery.sources import derived_orders, versions
from refinery.sources.files import write_table
from tests.conftest import TABLES, plan_of, rows_of

DAY = datetime(2024, 1, 1)
COLUMNS = "k string, p string, v int, at timestamp"


def table(spark, rows):
    return materialize(spark.createDataFrame(rows, COLUMNS).repartition(3), "t")


@pytest.fixture
def odd(spark):
    """A table with repeated and missing keys, and a batch with older, equal, undated and
    repeated versions."""
    held = [(f"k{i % 40}", f"p{i}", i, DAY + timedelta(days=i % 3)) for i in range(120)]
    held += [("k1", "p1", 7, DAY), ("k2", "p2", 8, None), (None, "p3", 9, DAY), ("k4", None, 10, DAY)]
    late = [(k, p, 1000 + v, at and at + timedelta(days=v % 3 - 1)) for k, p, v, at in held[::2]]
    late += [(k, p, 2000 + v, at) for k, p, v, at in late[::3]]
    late += [("k2", "p2", 1, None), (None, "p3", 2, DAY), (None, "p3", 3, DAY), ("k4", None, 4, None), ("new", "p", 5, DAY), ("new", "p", 5, DAY)]
    return table(spark, held), table(spark, late)


def test_rows_are_chosen_by_address(spark):
    rows = materialize(spark.range(0, 9000, 1, 4), "numbers")
    at = in_place.addressed(rows).filter("id % 7 = 0 OR id > 8000").select("_file", "_row")
    bits = in_place.bits_of(at.unionByName(at))
    assert sorted(r[0] for r in in_place.chosen(rows, bits).collect()) == [i for i in range(9000) if i % 7 == 0 or i > 8000]
    assert in_place.chosen(rows, bits, keep=False).count() == 9000 - in_place.chosen(rows, bits).count()
    assert in_place.chosen(rows, in_place.bits_of(at.limit(0))).count() == 0


@pytest.mark.parametrize("order_by", ["at", None])
def test_a_large_batch_is_merged_in_place(spark, odd, monkeypatch, settings, order_by):
    held, late = odd
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plain = publish.upsert(held, late, ["k", "p"], order_by)
    monkeypatch.setattr(publish, "SMALL_BATCH", 0)
    merged = publish.upsert(held, late, ["k", "p"], order_by, stored=True)
    assert rows_of(merged) == rows_of(plain)
    assert "hashpartitioning(k" in plan_of(plain)
    if order_by:  # no two rows share a time, but for few
        assert "SortMergeJoin" not in plan_of(merged)


def test_partitions_and_versions_are_merged_in_place(spark, tmp_path, monkeypatch):
    clean = catalog._stored(spark, TABLES)
    results = []
    for limit in (publish.SMALL_BATCH, 0):
        monkeypatch.setattr(publish, "SMALL_BATCH", limit)
        path = f"{tmp_path}/{limit}"
        publish.publish(clean, catalog.CLEAN, f"{path}/t", PARTITION_COLUMNS)
        publish.publish_version(clean, catalog.CLEAN, f"{path}/v", PARTITION_COLUMNS)
        batch = catalog._versions(clean)
        results.append(rows_of(publish.upsert_table(spark, f"{path}/t", catalog.CLEAN, batch)))
        for part in (catalog._even(), ~catalog._even()):
            merged = publish.upsert_version(spark, f"{path}/v", catalog.CLEAN, batch.filter(part))
        results.append(rows_of(merged))
        assert versions.current(spark, f"{path}/v").number == 3
    assert results[0] == results[1] == results[2] == results[3]


def test_many_repeated_keys_move_only_their_rows(spark, monkeypatch):
    rows = materialize(derived_orders.raw_orders(spark, TABLES, "rough"), "raw")
    plain = cleaning.keep_one_per_key(cleaning.clean_keys(rows))
    monkeypatch.setattr(cleaning, "REPEATED_KEYS", 0)
    few = cleaning.keep_one_per_stored_key(cleaning.clean_keys(rows))
    assert rows_of(few) == rows_of(plain)
    assert "Union" in plan_of(few)


@pytest.mark.parametrize("variant", ["settled", "moved", "rough"])
def test_raw_orders_are_those_of_the_text(spark, variant):
    assert derived_orders._JOINS in derived_orders.RAW_ORDERS_SQL
    tables = {name: spark.read.parquet(f"{TABLES}/{name}.parquet") for name in derived_orders.TABLES}
    text = derived_orders.raw_orders_sql(variant, **{name: "{" + name + "}" for name in tables})
    assert rows_of(derived_orders.raw_orders(spark, TABLES, variant)) == rows_of(spark.sql(text, **tables))


def test_customers_are_found_per_order(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(derived_orders.raw_orders(spark, TABLES))
    assert "hashpartitioning(o_custkey" in plan and "l_orderkey" not in plan.split("hashpartitioning(o_custkey")[1].split("\n")[0]
    joins = [line for line in plan.splitlines() if line.startswith("Left keys")]
    assert sum("l_orderkey" in line for line in joins) == 1 and sum("o_custkey" in line or "c_custkey" in line for line in joins) == 1


def test_a_fact_is_dealt_out_before_its_metrics(spark):
    clean = catalog._stored_in_place(spark, TABLES)
    dims = build_dims(clean)
    plain, dealt = (fact.build_fact(clean, dims, catalog.RUN_AT, by) for by in ((), PARTITION_COLUMNS))
    assert rows_of(plain) == rows_of(dealt)
    path = scratch_path(spark, "fact")
    write_table(dealt, path, PARTITION_COLUMNS, dealt=True)
    assert len(os.listdir(path)) > 5
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    moved = plan.split("RebalancePartitions")[1]
    assert not any(metric in moved for metric in metrics.METRIC_COLUMNS if metric != "calculated_total")


def test_stored_tables_are_packed_well(spark, tmp_path):
    path = packed(spark.range(3), "t").inputFiles()[0]
    assert path.endswith(".zstd.parquet")
    write_table(spark.range(3), f"{tmp_path}/t")
    assert any(name.endswith(".zstd.parquet") for name in os.listdir(f"{tmp_path}/t"))


@pytest.mark.parametrize("query", ["roundtrip_csv", "roundtrip_csv_rough", "build_fact_rough", "join_customer_bucketed", "publish_fact", "quarter_by_calendar", "incremental_upsert_version"])
def test_only_rows_that_share_a_key_are_moved_for_it(spark, monkeypatch, query):
    used = []
    plain = cleaning.keep_one_per_stored_key
    monkeypatch.setattr(cleaning, "keep_one_per_stored_key", lambda rows, *a: used.append(1) or plain(rows, *a))
    getattr(catalog, query)(spark, TABLES)
    assert used and BUSINESS_KEY
