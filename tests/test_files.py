"""CSV and Parquet layers, upserts, and the whole batch over files."""

from __future__ import annotations

import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from refinery.operators import publish
from refinery.plans.pipeline import clean_layer, report, star_layer
from refinery.plans.refine import refine
from refinery.schemas import CLEAN, DIM_REGION, PARTITION_COLUMNS, RAW
from refinery.session import scratch_path, shared_root
from refinery.sources.files import read_csv, read_table, write_csv, write_table
from tests.conftest import rows_of
from tests.test_cleaning import raw_frame

AT = datetime(2024, 6, 1)

SAMPLE = '''order_id,customer_id,customer_name,product_id,product_name,category,quantity,unit_price,total_amount,order_date,region,status
A1,K1,  Ann Lee ,P1,"Pen, ""fine""",Tools,2,5.00,10.00,05-01-2024,North,completed
A1,K1,  Ann Lee ,P1,"Pen, ""fine""",Tools,2,5.00,10.00,05-01-2024,North,completed
A2,,Bob,P2,Desk,FURNITURE,1,450,450,13-01-2024,West,pending
A3,K3,JosÃ©,P3,Lamp,  Furniture  ,,34.50,,2024/02/29,south,  shipped
A4,K1,Ann Lee,P2,Desk,furniture,2,450,800,not known,NORTH,Completed
'''


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    (path / "orders.csv").write_text(SAMPLE, encoding="utf-8")
    return str(path)


def test_raw_scan(spark, sample):
    rows = read_csv(spark, sample)
    assert rows.schema == RAW and rows.count() == 5
    first = rows.first()
    assert first["customer_name"] == "  Ann Lee " and first["product_name"] == 'Pen, "fine"'
    assert rows.filter("customer_id is null").count() == 1


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        ",".join(RAW.names) + '\nA1,K1,"Ann\nLee",P1,Pen,T,1,1,1,2024-01-01,n,s\n'
    )
    assert read_csv(spark, str(tmp_path), multi_line=True).first()["customer_name"] == "Ann\nLee"


def test_corrupt_records_are_kept_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(RAW.names) + "\nA1,K1\n" + ",".join("abcdefghijkl") + "\n")
    rows = read_csv(spark, str(tmp_path), corrupt_column="broken").collect()
    assert sorted(str(r["broken"]) for r in rows) == ["A1,K1", "None"]


def test_csv_round_trip_keeps_padding_quotes_and_types(spark, tmp_path):
    rows = raw_frame(spark, {"customer_name": '  "q", x '}, {"customer_name": None})
    write_csv(rows, f"{tmp_path}/raw", max_records_per_file=1)
    assert rows_of(read_csv(spark, f"{tmp_path}/raw", pattern="*.csv")) == rows_of(rows)
    clean = refine(rows, AT)
    write_csv(clean, f"{tmp_path}/clean")
    assert rows_of(read_csv(spark, f"{tmp_path}/clean", CLEAN)) == rows_of(clean)


def monthly(spark):
    dates = {"A": "2024-01-05", "B": "2024-01-06", "C": "2024-02-01", "D": "?"}
    return refine(
        raw_frame(spark, *[{"order_id": o, "order_date": d} for o, d in dates.items()]), AT
    )


def test_partitioned_table(spark, tmp_path):
    table = publish.publish(monthly(spark), CLEAN, f"{tmp_path}/t", PARTITION_COLUMNS)
    assert rows_of(table) == rows_of(monthly(spark))
    january = monthly(spark).filter("order_month = 1").withColumn("status", F.lit("x"))
    write_table(january, f"{tmp_path}/t", PARTITION_COLUMNS, only_partitions_present=True)
    spark.catalog.refreshByPath(f"{tmp_path}/t")
    again = read_table(spark, f"{tmp_path}/t", CLEAN)
    assert again.count() == 4 and again.filter("status = 'x'").count() == 2
    write_table(january, f"{tmp_path}/t", PARTITION_COLUMNS)
    spark.catalog.refreshByPath(f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t", CLEAN).count() == 2


def test_upsert_moves_rows_between_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    before = publish.publish(monthly(spark), CLEAN, path, PARTITION_COLUMNS)
    batch = refine(
        raw_frame(
            spark,
            {"order_id": "C", "order_date": "2024-01-09"},  # February is left empty
            {"order_id": "D", "order_date": "2024-03-09"},  # and so are the undated
            {"order_id": "E", "order_date": "2024-04-01"},
        ),
        AT,
    )
    expected = rows_of(publish.upsert(before, batch))
    assert len(expected) == 5
    after = publish.upsert_table(spark, path, CLEAN, batch)
    assert rows_of(after) == expected
    again = publish.upsert_table(spark, path, CLEAN, batch)
    assert rows_of(again) == expected


def test_upsert_touches_no_other_partition(spark, tmp_path):
    path = f"{tmp_path}/t"
    publish.publish(monthly(spark), CLEAN, path, PARTITION_COLUMNS)
    february = f"{path}/order_year=2024/order_month=2"
    files = set(os.listdir(february))
    batch = monthly(spark).filter("order_id = 'A'").withColumn("status", F.lit("returned"))
    after = publish.upsert_table(spark, path, CLEAN, batch)
    assert set(os.listdir(february)) == files
    assert {r["order_id"]: r["status"] for r in after.collect()} == {
        "A": "returned", "B": "done", "C": "done", "D": "done",
    }


def test_catalog_table(spark):
    region = spark.createDataFrame([(1, "n", "N", "z")], DIM_REGION)
    spark.sql(f"CREATE DATABASE refinery_tests LOCATION '{scratch_path(spark, 'db')}'")
    name = "refinery_tests.dim_region"
    for _ in range(2):
        stored = publish.publish_to_catalog(region, DIM_REGION, name)
    assert rows_of(stored) == [(1, "n", "N", "z")]
    spark.sql("DROP DATABASE refinery_tests CASCADE")


def session_like(master: str, folder: str | None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_lies_in_the_folder_the_cluster_names():
    named = session_like("yarn", "hdfs:///shared/")
    assert shared_root(named) == "hdfs:///shared"
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    assert scratch_path(named, "x") != scratch_path(named, "x")


def test_only_a_local_session_may_use_its_own_disk():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(session_like("spark://host:7077", None))
    assert shared_root(session_like("local[8]", None))


def test_whole_batch(spark, sample, tmp_path):
    clean = clean_layer(spark, sample, f"{tmp_path}/clean", AT)
    assert rows_of(clean.select("order_id", "customer_name", "quantity", "is_date_missing")) == [
        ("A1", "Ann Lee", 2, False), ("A3", "José", 0, False), ("A4", "Ann Lee", 2, True),
    ]
    star = star_layer(spark, f"{tmp_path}/clean", f"{tmp_path}/star", AT)
    sizes = {name: df.count() for name, df in star.items()}
    assert sizes == {
        "dim_customer": 2, "dim_product": 3, "dim_date": 2, "dim_region": 2, "fact_sales": 3,
    }
    found = {name: df.collect() for name, df in report(star).items()}
    assert found["quality"][0].asDict() == {
        "fact_rows": 3, "null_key_rows": 1, "null_customer_sk": 0, "null_product_sk": 0,
        "null_date_sk": 1, "null_region_sk": 0, "mismatch_rows": 1, "missing_date_rows": 1,
    }
    assert set(found["orphans"][0]) == {0}
    assert [tuple(r) for r in found["bands"]] == [("high", 1, 900.0), ("low", 2, 10.0)]
    assert [tuple(r) for r in found["months"]] == [(None, None, 1), (2024, 2, 1), (2024, 5, 1)]
    again = star_layer(spark, f"{tmp_path}/clean", f"{tmp_path}/star", AT)
    assert again["fact_sales"].count() == 3
