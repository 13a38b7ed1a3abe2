"""What a failed or late load leaves behind."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from refinery.operators import checks, publish
from refinery.plans import pipeline
from refinery.plans.refine import refine
from refinery.schemas import CLEAN, DIM_REGION, PARTITION_COLUMNS, RAW
from refinery.session import delete, scratch_path, shared_root, temporary
from refinery.sources.files import read_csv, read_table, write_csv
from tests.conftest import rows_of
from tests.test_cleaning import raw_frame

AT = datetime(2024, 6, 1)
NORTH = (1, "north", "NORTH", "North Zone")


def regions(spark, *rows):
    return spark.createDataFrame(list(rows), "region_sk long, region_name string, region_code string, geo_zone string")


@pytest.fixture
def broken(spark):
    return regions(spark, (2, "south", "SOUTH", "z"), (None, "x", "X", "x"))


def test_a_failed_publish_keeps_the_old_table(spark, tmp_path, broken):
    path = f"{tmp_path}/t"
    publish.publish(regions(spark, NORTH), DIM_REGION, path)
    with pytest.raises(Exception, match="region_sk is required"):
        publish.publish(broken, DIM_REGION, path)
    assert rows_of(read_table(spark, path, DIM_REGION)) == [NORTH]
    assert os.listdir(tmp_path) == ["t"]


def test_a_failed_catalog_publish_keeps_the_old_table(spark, broken):
    spark.sql(f"CREATE DATABASE kept LOCATION '{scratch_path(spark, 'db')}'")
    publish.publish_to_catalog(regions(spark, NORTH), DIM_REGION, "kept.region")
    with pytest.raises(Exception, match="region_sk is required"):
        publish.publish_to_catalog(broken, DIM_REGION, "kept.region")
    assert rows_of(spark.table("kept.region")) == [NORTH]
    assert [t.name for t in spark.catalog.listTables("kept")] == ["region"]
    spark.sql("DROP DATABASE kept CASCADE")


def test_a_star_that_fails_at_the_fact_keeps_the_old_one(spark, tmp_path, monkeypatch):
    clean, star = f"{tmp_path}/clean", f"{tmp_path}/star"
    first = refine(raw_frame(spark, {"order_id": "A"}), AT)
    publish.publish(first, CLEAN, clean, PARTITION_COLUMNS)
    before = {k: rows_of(v) for k, v in pipeline.star_layer(spark, clean, star, AT).items()}
    more = refine(raw_frame(spark, {"order_id": "A"}, {"order_id": "B", "customer_id": "A0"}), AT)
    publish.publish(more, CLEAN, clean, PARTITION_COLUMNS)
    plain = pipeline.build_fact
    broken = F.raise_error(F.lit("no fact"))
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "build_fact", lambda *a: plain(*a).withColumn("status", broken.cast("string")))
        with pytest.raises(Exception, match="no fact"):
            pipeline.star_layer(spark, clean, star, AT)
    assert {k: rows_of(v) for k, v in pipeline.read_star(spark, star).items()} == before
    assert sorted(os.listdir(tmp_path)) == ["clean", "star"]
    assert pipeline.star_layer(spark, clean, star, AT)["dim_customer"].count() == 2


def test_a_replacement_that_never_ended_is_undone(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish.publish(regions(spark, NORTH), DIM_REGION, path)
    os.rename(path, f"{path}.replaced")
    publish.restore(spark, path)
    assert rows_of(read_table(spark, path, DIM_REGION)) == [NORTH]


def test_the_latest_version_wins(spark, tmp_path):
    def version(status, days, order="A"):
        return refine(raw_frame(spark, {"order_id": order, "status": status}), AT + timedelta(days=days))

    table = version("new", 0).unionByName(version("kept", 0, "B"))
    batch = version("completed", 1).unionByName(version("returned", 30)).unionByName(version("late", -9, "B"))
    expected = [("A", "returned"), ("B", "kept")]
    assert rows_of(publish.upsert(table, batch).select("order_id", "status")) == expected
    path = f"{tmp_path}/t"
    publish.publish(table, CLEAN, path, PARTITION_COLUMNS)
    for _ in range(2):
        after = publish.upsert_table(spark, path, CLEAN, batch)
        assert rows_of(after.select("order_id", "status")) == expected
    assert rows_of(publish.upsert(table, batch, order_by=None).select("order_id"))[1:] == [("B",)]


@pytest.mark.parametrize("upsert", [publish.upsert_table, publish.upsert_version])
def test_a_large_batch_is_joined_once(spark, tmp_path, monkeypatch, upsert):
    def version(status, days, order="A", date="2024-01-05"):
        return refine(raw_frame(spark, {"order_id": order, "status": status, "order_date": date}), AT + timedelta(days=days))

    table = version("new", 0).unionByName(version("kept", 0, "B")).unionByName(version("new", 0, "C", "2024-03-01"))
    undated = version("undated", 0, "C").withColumn("processed_at", F.lit(None).cast("timestamp"))
    batch = version("completed", 1).unionByName(version("returned", 30)).unionByName(version("late", -9, "B"))
    batch = batch.unionByName(undated).unionByName(version("first", -1, "D", "2024-04-01"))
    found, stored, keep = [], [], publish.materialize
    monkeypatch.setattr(publish, "materialize", lambda df, label: (stored.append(label), keep(df, label))[1])
    for limit in (publish.SMALL_BATCH, 0):
        monkeypatch.setattr(publish, "SMALL_BATCH", limit)
        path = f"{tmp_path}/t{limit}"
        publish.publish(table, CLEAN, path, PARTITION_COLUMNS)
        stored.clear()
        found.append([rows_of(upsert(spark, path, CLEAN, batch)) for _ in range(2)] + [rows_of(publish.upsert(table, batch))])
    assert stored == ["batch", "newest"] * 3  # neither what was met nor what was merged
    assert all(rows == found[0][0] for rows in found[0] + found[1])
    assert sorted((r[0], r[11]) for r in found[0][0]) == [("A", "returned"), ("B", "kept"), ("C", "undated"), ("D", "first")]


def test_padding_does_not_make_another_key(spark):
    rows = raw_frame(spark, {"order_id": " O1"}, {"order_id": "O1 "}, {"order_id": "O2"})
    assert refine(rows, AT).count() == 2 and refine(rows, AT, padded_keys_differ=True).count() == 3
    assert checks.layer_counts(rows).first()["deduplicated_rows"] == 2


def test_blanks_and_nulls_stay_apart_in_csv(spark, tmp_path):
    rows = raw_frame(spark, {"customer_name": "", "status": None}, {"customer_name": " ", "status": "a\nb"})
    write_csv(rows, f"{tmp_path}/t")
    back = read_csv(spark, f"{tmp_path}/t", RAW, pattern="*.csv", multi_line=True, keep_blanks=True)
    assert rows_of(back) == rows_of(rows)


def test_casts_that_lose_something_are_refused(spark):
    halves = regions(spark, NORTH).withColumn("region_sk", F.lit(2.7))
    with pytest.raises(Exception, match="does not cast"):
        publish.conform(halves, DIM_REGION).collect()
    whole = regions(spark, NORTH).withColumn("region_sk", F.lit(2.0))
    assert publish.conform(whole, DIM_REGION).first()["region_sk"] == 2
    assert checks.check_contract(halves, DIM_REGION).filter("column = 'region_sk'").first()["cast_failures"] == 1


def test_reports_hold_every_month(spark, tmp_path):
    dates = [{"order_id": f"O{i}", "order_date": f"{2000 + i // 12}-{i % 12 + 1:02d}-01"} for i in range(30)]
    publish.publish(refine(raw_frame(spark, *dates), AT), CLEAN, f"{tmp_path}/c", PARTITION_COLUMNS)
    star = pipeline.star_layer(spark, f"{tmp_path}/c", f"{tmp_path}/s", AT)
    found = pipeline.report(star)
    assert found["months"].count() == 30
    assert dict(map(tuple, found["tables"].collect()))["fact_sales"] == 30


HEAD = ",".join(RAW.names) + "\n"


def test_batch_reports_and_incremental_mode(spark, tmp_path):
    raw, clean = tmp_path / "raw", f"{tmp_path}/clean"
    raw.mkdir()
    (raw / "a.csv").write_text(HEAD + "A,K1,Ann,P1,Pen,T,1,1,1,2024-01-01,n,s\nA,K1\nB,K1,Bo,P1,Pen,T,1,1,1,2024-01-02,n,s\n")
    assert pipeline.clean_layer(spark, str(raw), clean, AT, incremental=True).count() == 2
    found = pipeline.raw_report(spark, str(raw))
    assert found["steps"].first()["raw_rows"] == 2
    assert rows_of(found["broken"]) == [("A,K1", 1)]
    assert found["contract"].count() == len(set(CLEAN.names))
    table = read_table(spark, clean, CLEAN)
    assert [r["customer_id"] for r in pipeline.clean_report(table)["customer_conflicts"].collect()] == ["K1"]
    (raw / "a.csv").write_text(HEAD + "B,K1,Bo,P1,Pen,T,1,1,1,2024-01-02,n,back\nC,K1,Bo,P1,Pen,T,1,1,1,2024-02-02,n,s\n")
    later = pipeline.clean_layer(spark, str(raw), clean, AT + timedelta(days=1), incremental=True)
    assert rows_of(later.select("order_id", "status")) == [("A", "s"), ("B", "back"), ("C", "s")]


def test_records_with_keys_stay_whatever_their_number_of_fields(spark, tmp_path):
    raw, clean = tmp_path / "raw", f"{tmp_path}/clean"
    raw.mkdir()
    whole, short, lost = "A,K1,Ann,P1,Pen,T,1,1,1,2024-01-01,n,s,extra", "B,K1,Bo,P1", "C,K1"
    (raw / "a.csv").write_text("\n".join([HEAD.strip() + ",more", whole, short, lost, ""]))
    found = pipeline.clean_layer(spark, str(raw), clean, AT)
    assert rows_of(found.select("order_id", "product_name", "quantity")) == rows_of(
        refine(raw_frame(spark, {"order_id": "A", "product_name": "Pen", "quantity": "1", "product_id": "P1"}), AT)
        .select("order_id", "product_name", "quantity")
    ) + rows_of(
        refine(read_csv(spark, str(raw)).filter("order_id = 'B'"), AT).select("order_id", "product_name", "quantity")
    )
    aside = spark.read.parquet(pipeline.broken_path(clean))
    assert rows_of(aside.select("record", "kept")) == [(whole, True), (short, True), (lost, False)]
    steps = pipeline.raw_report(spark, str(raw))["steps"].first()
    assert (steps["records_read"], steps["raw_rows"], steps["clean_rows"]) == (3, 2, 2)
    assert (steps["broken_records_left_out"], steps["broken_records_kept"]) == (1, 2)
    pipeline.clean_layer(spark, str(raw), clean, AT + timedelta(days=1), incremental=True)
    assert spark.read.parquet(pipeline.broken_path(clean)).count() == 6


def test_scratch_is_gone_when_a_batch_ends(spark, tmp_path):
    table = f"{tmp_path}/c"
    rows = refine(raw_frame(spark, {"order_id": "A"}, {"order_id": "B"}), AT)
    before = set(os.listdir(shared_root(spark)))
    publish.publish(rows, CLEAN, table, PARTITION_COLUMNS)
    pipeline.star_layer(spark, table, f"{tmp_path}/s", AT)
    publish.upsert_table(spark, table, CLEAN, rows)
    assert set(os.listdir(shared_root(spark))) == before
    with temporary(spark):
        path = scratch_path(spark, "x")
        spark.range(1).write.parquet(path)
    assert not os.path.exists(path)
    delete(spark, path)


def test_orphans_take_one_scan(spark, tmp_path):
    rows = publish.publish(refine(raw_frame(spark, {"order_id": "A"}), AT), CLEAN, f"{tmp_path}/t")
    keys = {k: spark.createDataFrame([], f"{k} string") for k in ("customer_id", "product_id")}
    found = checks.check_orphans(rows, keys)
    assert tuple(found.first()) == (1, 1)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 2  # initial and final plan


def test_nothing_guesses_the_size_of_the_cluster():
    root = os.path.dirname(os.path.dirname(checks.__file__))
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name), encoding="utf-8").read()
                assert "defaultParallelism" not in text and ".rdd" not in text
