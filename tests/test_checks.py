"""Quality checks and contracts."""

from __future__ import annotations

import pytest

from refinery.operators import checks
from refinery.operators.publish import conform, publish
from refinery.plans.refine import refine
from refinery.schemas import CLEAN, DIM_REGION, RAW
from tests.conftest import rows_of
from tests.test_cleaning import raw_frame


def test_layer_counts(spark):
    raw = raw_frame(
        spark, {}, {}, {"status": "x"}, {"order_id": "O2", "customer_id": None},
        {"order_id": "O3", "customer_id": " "}, {"order_id": None}, {"order_id": "O4"},
    )
    counts = checks.layer_counts(raw).first()
    assert tuple(counts) == (7, 5, 2)
    assert counts["clean_rows"] == refine(raw).count()
    assert tuple(checks.layer_counts(raw.limit(0)).first()) == (0, 0, 0)


def test_null_and_mismatch_counts(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1, 1, True, False), (None, 1, None, 1, False, True), (1, 1, None, 1, False, True)],
        "customer_sk long, product_sk long, date_sk int, region_sk long, "
        "total_amount_mismatch boolean, is_date_missing boolean",
    )
    assert checks.check_null_keys(fact).first()[0] == 2
    assert checks.check_amount_mismatch(fact).first()[0] == 1
    summary = checks.quality_summary(fact).first().asDict()
    assert summary == {
        "fact_rows": 3, "null_key_rows": 2, "null_customer_sk": 1, "null_product_sk": 0,
        "null_date_sk": 2, "null_region_sk": 0, "mismatch_rows": 1, "missing_date_rows": 2,
    }


def test_orphans(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), (None, 9)], "k string, n int")
    allowed = {
        "k": spark.createDataFrame([("b",)], "id string"),
        "n": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    assert checks.check_orphans(rows, allowed).first().asDict() == {"orphan_k": 2, "orphan_n": 2}
    assert tuple(checks.check_orphans(rows.limit(0), allowed).first()) == (0, 0)


def test_conflicting_keys(spark):
    clean = refine(raw_frame(spark, {}, {"order_id": "O2", "region": "south"},
                             {"order_id": "O3", "customer_id": "C2"}))
    found = checks.dim_key_conflicts(clean, "customer_id", ["customer_name", "region"])
    assert rows_of(found) == [("C1", 2)]


def test_contract_report(spark):
    raw = raw_frame(spark, {"quantity": "n/a"}, {"quantity": None, "order_date": "2024-01-05"})
    report = {r["column"]: r for r in checks.check_contract(raw.withColumn("x", raw.status), CLEAN).collect()}
    assert (report["quantity"]["cast_failures"], report["quantity"]["nulls"]) == (1, 1)
    assert report["order_date"]["cast_failures"] == 1
    assert (report["order_year"]["state"], report["order_year"]["nulls"]) == ("missing", 2)
    assert report["x"]["state"] == "undeclared"
    assert len(report) == len(set(CLEAN.names) | {"x"})


REGION = [(1, "north", "NORTH", "North Zone")]


def test_columns_are_matched_by_name(spark):
    turned = spark.createDataFrame(REGION, DIM_REGION).select(*reversed(DIM_REGION.names))
    assert conform(turned, DIM_REGION).columns == DIM_REGION.names
    assert rows_of(conform(turned, DIM_REGION)) == REGION


def test_drift_in_names_is_refused(spark):
    region = spark.createDataFrame(REGION, DIM_REGION)
    with pytest.raises(ValueError, match="geo_zone"):
        conform(region.drop("geo_zone"), DIM_REGION)
    extra = region.withColumn("surplus", region.geo_zone)
    with pytest.raises(ValueError, match="surplus"):
        conform(extra, DIM_REGION)
    assert conform(extra, DIM_REGION, allow_undeclared=True).columns == DIM_REGION.names


def test_bad_values_fail_the_publishing_job(spark, tmp_path):
    text = spark.createDataFrame([("1", "n", "N", "z")], "region_sk string, region_name string, region_code string, geo_zone string")
    assert rows_of(publish(text, DIM_REGION, f"{tmp_path}/good")) == [(1, "n", "N", "z")]
    wrong = text.withColumn("region_sk", text.region_name)
    with pytest.raises(Exception, match="does not cast"):
        publish(wrong, DIM_REGION, f"{tmp_path}/wrong")
    absent = text.selectExpr("cast(null as long) region_sk", "region_name", "region_code", "geo_zone")
    with pytest.raises(Exception, match="region_sk is required"):
        publish(absent, DIM_REGION, f"{tmp_path}/absent")


def test_raw_columns_are_all_text():
    assert {f.dataType.simpleString() for f in RAW} == {"string"}
