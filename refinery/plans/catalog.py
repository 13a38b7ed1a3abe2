"""Every operator as a named query over the generated tables.

Each entry takes (session, folder) and returns a DataFrame. Audit timestamps are left
out of the results: they differ from run to run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from refinery import schemas
from refinery.functions import metrics, text
from refinery.operators import checks, cleaning, dimensions, fact, history, publish
from refinery.plans.pipeline import star_layer, stored_counts
from refinery.plans.refine import refine
from refinery.plans.star import build_star
from refinery.schemas import (
    AUDIT_COLUMNS,
    CLEAN,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_REGION,
    FACT_SALES,
    ORDER_LINE,
    PARTITION_COLUMNS,
    RAW,
)
from refinery.session import materialize, packed, scratch_path, temporary
from refinery.sources.derived_orders import raw_orders
from refinery.sources.files import read_csv, read_table, write_csv
from refinery.sources.ledger import LOADED, ingest
from refinery.sources.versions import read_version

Query = Callable[[SparkSession, str], DataFrame]

# One fixed run time, so that equal queries compile to equal code.
RUN_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


# Status, last digits of the order id and days since the run, of versions in a later batch.
VERSIONS = [
    ("returned", ("0", "2", "4", "6", "8"), 1),
    ("shipped", ("0", "4"), 2),
    ("lost", ("1", "2", "6"), -1),
]


# First and last days of two loads, of which the later one has new ids and lacks old ones.
LOADS = [("1992-01-01", "1992-12-31"), ("1993-07-01", "1994-06-30")]


def _refined(spark: SparkSession, folder: str, variant: str = "settled") -> DataFrame:
    return refine(raw_orders(spark, folder, variant), RUN_AT)


def _refined_in_place(spark: SparkSession, folder: str, variant: str = "settled") -> DataFrame:
    """The same from stored raw orders, for queries that move or write much afterwards: fewer
    bytes are moved, for a little more time."""
    return refine(packed(raw_orders(spark, folder, variant), "raw"), RUN_AT, stored=True)


def _stored(spark: SparkSession, folder: str, variant: str = "settled") -> DataFrame:
    """The clean table on disk, for queries that read it more than once."""
    return materialize(_refined(spark, folder, variant), "clean")


def _publish_clean(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The clean table published at ``path`` by its partitions."""
    with temporary(spark):
        return publish.publish(_refined_in_place(spark, folder), CLEAN, path, PARTITION_COLUMNS)


def _stored_in_place(spark: SparkSession, folder: str, variant: str = "settled") -> DataFrame:
    """The same from stored raw orders."""
    return packed(_refined_in_place(spark, folder, variant), "clean")


def _star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return build_star(_stored(spark, folder), RUN_AT)


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder)["fact_sales"]


def _measures(spark: SparkSession, folder: str) -> DataFrame:
    """Clean rows with the metrics, for reports that need no surrogate key."""
    return fact.with_metrics(_refined(spark, folder))


def _without_audit(rows: DataFrame) -> DataFrame:
    return rows.drop(*AUDIT_COLUMNS)


# Scans and sinks


def scan_raw(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "raw-csv")
    write_csv(raw_orders(spark, folder), path)
    return read_csv(spark, path)


def scan_clean(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-table")
    publish.publish(_refined(spark, folder), CLEAN, path)
    return _without_audit(read_table(spark, path, CLEAN))


def roundtrip_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-csv")
    with temporary(spark):
        write_csv(_refined_in_place(spark, folder), path, max_records_per_file=100_000)
    return _without_audit(read_csv(spark, path, CLEAN, pattern="*.csv"))


def partition_pruned_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-partitioned")
    table = publish.publish(_refined(spark, folder), CLEAN, path, PARTITION_COLUMNS)
    half_year = table.filter((F.col("order_year") == 1997) & (F.col("order_month") <= 6))
    return _without_audit(half_year)


def publish_fact(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    with temporary(spark):
        star = build_star(_stored_in_place(spark, folder), RUN_AT, PARTITION_COLUMNS)
        sales = publish.publish(star["fact_sales"], FACT_SALES, path, PARTITION_COLUMNS, dealt=True)
    return _without_audit(sales)


def publish_star(spark: SparkSession, folder: str) -> DataFrame:
    """The fact of a star schema that was published as a whole, twice."""
    clean, star = scratch_path(spark, "clean-table"), scratch_path(spark, "star")
    _publish_clean(spark, folder, clean)
    star_layer(spark, clean, star, RUN_AT)
    return _without_audit(star_layer(spark, clean, star, RUN_AT)["fact_sales"])


def _database(spark: SparkSession) -> str:
    """A new database of the catalog, in the shared folder."""
    name = f"refinery_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


def publish_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension in the session's catalog, replaced by a later one."""
    database = _database(spark)
    regions = materialize(dim_region(spark, folder), "regions")
    publish.publish_to_catalog(regions.limit(1), DIM_REGION, f"{database}.dim_region")
    return publish.publish_to_catalog(regions, DIM_REGION, f"{database}.dim_region")


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of a stored star schema, from the footers of its files."""
    clean, star = scratch_path(spark, "clean-table"), scratch_path(spark, "star")
    _publish_clean(spark, folder, clean)
    star_layer(spark, clean, star, RUN_AT)
    return stored_counts(spark, star)


def quarantine_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders under a typed contract: every row, accepted or with what is wrong with it."""
    path = scratch_path(spark, "order-lines")
    rows = raw_orders(spark, folder).select(*ORDER_LINE.names)
    accepted = publish.publish_version(rows, ORDER_LINE, path, quarantine=True)
    rejects = publish.read_rejects(spark, path)
    record = F.from_json("record", StructType([RAW[c] for c in ORDER_LINE.names]))
    told = F.transform("problems", lambda p: F.concat_ws(":", p["column"], p["value"], p["reason"]))
    refused = rejects.select(record.alias("row"), F.concat_ws("; ", told).alias("problems"))
    return accepted.select(
        "order_id", "customer_id", "product_id", F.col("quantity").cast("string").alias("quantity"),
        F.lit("accepted").alias("verdict"), F.lit("").alias("problems"),
    ).unionByName(refused.select("row.order_id", "row.customer_id", "row.product_id", "row.quantity", F.lit("rejected").alias("verdict"), "problems"))


def scan_new_files(spark: SparkSession, folder: str) -> DataFrame:
    """Two drops of files into one folder, which is loaded after each and once more."""
    source, path = scratch_path(spark, "drops"), scratch_path(spark, "loaded")
    rows = materialize(raw_orders(spark, folder), "raw")
    for drop in (_even(), ~_even()):
        write_csv(rows.filter(drop), source, append=True)
        ingest(spark, source, path, pattern="*.csv")
    ingest(spark, source, path, pattern="*.csv")
    return read_version(spark, path, LOADED)


def table_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Of what a stored table reads as, beside whether that is what was written."""
    path = scratch_path(spark, "marked")
    columns = ["order_id", "customer_id", "product_id", "quantity", "order_date", "is_date_missing", "order_date_raw", "category"]
    publish.publish_version(_refined(spark, folder), CLEAN, path, PARTITION_COLUMNS, mark=columns)
    return publish.check_mark(spark, path, CLEAN)


def publish_dim_date(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dim-date")
    return publish.publish(dim_date(spark, folder), DIM_DATE, path)


def incremental_upsert_version(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches merged into a versioned table, each as its next version."""
    path = scratch_path(spark, "clean-versions")
    with temporary(spark):
        clean = publish.publish_version(_refined_in_place(spark, folder), CLEAN, path, PARTITION_COLUMNS, ["order_id"], ["order_id"])
    versions = _versions(clean)  # of the first version, whose files stay
    publish.upsert_version(spark, path, CLEAN, versions.filter(_even()))
    return _without_audit(publish.upsert_version(spark, path, CLEAN, versions.filter(~_even())))


def _even() -> Column:
    return F.substring("order_id", -1, 1).isin("0", "2", "4", "6", "8")


def _returned(clean: DataFrame) -> DataFrame:
    """A later batch: the orders with an even last digit come back as returned."""
    return clean.filter(_even()).withColumn("status", F.lit("returned"))


def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored_in_place(spark, folder)
    return _without_audit(publish.upsert(clean, _returned(clean), stored=True))


def incremental_upsert_table(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-upserted")
    clean = _publish_clean(spark, folder, path)
    return _without_audit(publish.upsert_table(spark, path, CLEAN, _returned(clean)))


def _versions(clean: DataFrame) -> DataFrame:
    """A batch with several versions of some keys, some of them older than the table."""
    parts = [
        clean.filter(F.substring("order_id", -1, 1).isin(*digits)).withColumns(
            {"status": F.lit(status), "processed_at": F.col("processed_at") + F.expr(f"INTERVAL {days} DAYS")}
        )
        for status, digits, days in VERSIONS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def incremental_upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored_in_place(spark, folder)
    return _without_audit(publish.upsert(clean, _versions(clean), stored=True))


def incremental_upsert_latest_table(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clean-upserted")
    clean = _publish_clean(spark, folder, path)
    return _without_audit(publish.upsert_table(spark, path, CLEAN, _versions(clean)))


# Cleaning


def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_copies(raw_orders(spark, folder))


def dedup_business_key(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.keep_one_per_key(raw_orders(spark, folder))


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_text(raw_orders(spark, folder))


def repair_encoding(spark: SparkSession, folder: str) -> DataFrame:
    repaired = text.repair_encoding("customer_name").alias("customer_name")
    return raw_orders(spark, folder).select("order_id", "product_id", repaired)


def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.parse_dates(raw_orders(spark, folder)).select(
        "order_id", "product_id", "order_date_raw", "order_date_clean", "order_date"
    )


def cast_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cast_numbers(raw_orders(spark, folder)).select(
        "order_id", "product_id", "quantity", "unit_price", "total_amount"
    )


def require_keys(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.require_keys(cleaning.clean_text(raw_orders(spark, folder)))


def fill_defaults(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.fill_defaults(cleaning.cast_numbers(raw_orders(spark, folder)))


def flag_missing_dates(spark: SparkSession, folder: str) -> DataFrame:
    dated = cleaning.parse_dates(raw_orders(spark, folder))
    return cleaning.flag_missing_dates(dated).select(
        "order_id", "product_id", "order_date_raw", "order_date", "is_date_missing"
    )


def flag_amount_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    numeric = cleaning.fill_defaults(cleaning.cast_numbers(raw_orders(spark, folder)))
    return cleaning.flag_amount_mismatch(numeric).select(
        "order_id", "product_id", "quantity", "unit_price", "total_amount",
        "calculated_total", "total_amount_mismatch",
    )


def refined(spark: SparkSession, folder: str) -> DataFrame:
    return _without_audit(_refined(spark, folder))


def refine_rough(spark: SparkSession, folder: str) -> DataFrame:
    return _without_audit(_refined(spark, folder, "rough"))


def build_fact_rough(spark: SparkSession, folder: str) -> DataFrame:
    return _without_audit(build_star(_stored_in_place(spark, folder, "rough"), RUN_AT)["fact_sales"])


def roundtrip_csv_rough(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "rough-csv")
    with temporary(spark):
        write_csv(_refined_in_place(spark, folder, "rough"), path)
    rows = read_csv(spark, path, CLEAN, pattern="*.csv", multi_line=True, keep_blanks=True)
    return _without_audit(rows)


# Dimensions


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_customer(_refined(spark, folder))


def dim_customer_moved(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_customer(_refined(spark, folder, "moved"))


def dim_customer_versions(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_customer(_stored(spark, folder, "moved"), all_versions=True)


def dim_customer_stable(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension of a second load with ids that the first lacked, and without some of
    its ids; numbers are those of the first load where it had the id."""
    clean, registry = _stored(spark, folder), scratch_path(spark, "keys")
    loads = [clean.filter(F.col("order_date").between(*map(F.lit, days))) for days in LOADS]
    for load in loads:
        dimension = dimensions.dim_customer(load, registry=registry)
    return dimension


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    return history.history(_refined(spark, folder, "moved"), "customer_id", ["customer_name", "region"])


def fact_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Every clean row with the attributes that its customer had on its day."""
    clean = _stored(spark, folder, "moved")
    intervals = materialize(history.history(clean, "customer_id", ["customer_name", "region"]), "history")
    columns = ["version", "customer_name", "region"]
    keyed = history.as_of(clean.drop("customer_name", "region"), intervals, "customer_id", columns)
    return keyed.select("order_id", "product_id", "customer_id", "order_date", *columns)


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_product(_refined(spark, folder))


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_date(_refined(spark, folder))


def dim_region(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dim_region(_refined(spark, folder))


def dim_region_by_table(spark: SparkSession, folder: str) -> DataFrame:
    """Zones from a table: of the regions that nations of a place lie in, the first by name."""
    clean = _stored(spark, folder)
    nations, regions = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("nation", "region"))
    names = F.array(*map(F.lit, ["north", "south", "east", "west", "central", "northeast", "northwest", "southeast", "southwest"]))
    place = F.get(names, (F.col("n_nationkey") % 10).cast("int"))
    zones = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return dimensions.dim_region(clean, zones.select(place.alias("region_name"), F.col("r_name").alias("geo_zone")))


def distinct_regions(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.distinct_regions(_refined(spark, folder))


# Fact


def join_customer_sk(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored(spark, folder)
    joined = fact.with_customer_key(clean, dimensions.dim_customer(clean))
    return joined.select("order_id", "product_id", "customer_id", "customer_sk")


def join_customer_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The lookup between catalog tables that are bucketed alike: nothing is moved."""
    clean, database = _stored_in_place(spark, folder), _database(spark)
    customers, buckets = dimensions.dim_customer(clean), publish.buckets_for(clean, 8)
    rows = publish.publish_bucketed(clean, CLEAN, f"{database}.clean", "customer_id", buckets)
    customers = publish.publish_bucketed(customers, DIM_CUSTOMER, f"{database}.dim_customer", "customer_id", buckets)
    joined = fact.with_customer_key_in_place(rows, customers)
    return joined.select("order_id", "product_id", "customer_id", "customer_sk")


def quarter_by_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Sales on the weekends of one quarter, chosen by the calendar alone."""
    star = build_star(_stored_in_place(spark, folder), RUN_AT, PARTITION_COLUMNS)
    path = scratch_path(spark, "fact")
    sales = publish.publish(star["fact_sales"], FACT_SALES, path, PARTITION_COLUMNS, dealt=True)
    days = materialize(star["dim_date"], "dim-date").filter("year = 1997 AND quarter = 2 AND is_weekend")
    return _without_audit(fact.on_days(sales, days, "day_name"))


def join_product_sk(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored(spark, folder)
    joined = fact.with_product_key(clean, dimensions.dim_product(clean))
    return joined.select("order_id", "product_id", "product_sk")


def join_region_sk(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored(spark, folder)
    joined = fact.with_region_key(clean, dimensions.dim_region(clean))
    return joined.select("order_id", "product_id", "region", "region_sk")


def join_date_sk(spark: SparkSession, folder: str) -> DataFrame:
    clean = _stored(spark, folder)
    joined = fact.with_date_key_lookup(clean, materialize(dimensions.dim_date(clean), "dim-date"))
    return joined.select("order_id", "product_id", "order_date", "date_sk")


def build_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _without_audit(_fact(spark, folder))


def fact_projection(spark: SparkSession, folder: str) -> DataFrame:
    return _fact(spark, folder).select(
        *schemas.SURROGATE_KEYS, *schemas.BUSINESS_KEY, "order_date", "status"
    )


def fact_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _measures(spark, folder).select(
        "order_id", "product_id", "quantity", "unit_price", "total_amount", *metrics.METRIC_COLUMNS
    )


# Reports and checks


def revenue_by_band(spark: SparkSession, folder: str) -> DataFrame:
    return fact.revenue_by_band(_measures(spark, folder))


def orders_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return fact.orders_by_month(_refined(spark, folder))


def first_24_months(spark: SparkSession, folder: str) -> DataFrame:
    return fact.orders_by_month(_refined(spark, folder), first=24)


def check_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_null_keys(_fact(spark, folder))


def check_amount_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_amount_mismatch(_refined(spark, folder))


def quality_summary(spark: SparkSession, folder: str) -> DataFrame:
    return checks.quality_summary(_fact(spark, folder))


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    return checks.layer_counts(raw_orders(spark, folder))


def check_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """All rows against the natural keys known before 2000, in dimensions of that time."""
    clean = _stored(spark, folder)
    earlier = clean.filter(F.col("order_date") < F.lit("2000-01-01").cast("date"))
    keys = ["customer_id", "product_id", "order_date", "region"]
    return checks.check_orphans(clean, {key: earlier.select(key).distinct() for key in keys})


def dim_key_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    clean = _refined(spark, folder, "moved")
    return checks.dim_key_conflicts(clean, "customer_id", ["customer_name", "region"])


def check_contract(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_contract(raw_orders(spark, folder).select(*RAW.names), CLEAN)


def check_contract_lossy(spark: SparkSession, folder: str) -> DataFrame:
    """Fractions where integers are declared, and times where dates are."""
    half = F.when(F.substring("order_id", -1, 1).isin("0", "2", "4", "6", "8"), 1).otherwise(0)
    rows = _refined(spark, folder).select(
        "order_id",
        (F.col("quantity") + half / 2).alias("quantity"),
        F.timestamp_add("HOUR", half, F.col("order_date").cast("timestamp")).alias("order_date"),
    )
    return checks.check_contract(rows, StructType([CLEAN[c] for c in rows.columns]))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        scan_raw, scan_clean, roundtrip_csv, partition_pruned_scan, publish_fact,
        publish_star, publish_catalog, table_counts, incremental_upsert_latest,
        incremental_upsert_latest_table, refine_rough, build_fact_rough, roundtrip_csv_rough,
        check_contract_lossy, publish_dim_date, incremental_upsert, incremental_upsert_table,
        dedup_rows, dedup_business_key, clean_text, repair_encoding, parse_dates,
        cast_numbers, require_keys, fill_defaults, flag_missing_dates, flag_amount_mismatch,
        dim_customer, dim_customer_moved, dim_customer_versions, dim_product, dim_date,
        dim_region, distinct_regions, join_customer_sk, join_product_sk, join_region_sk,
        join_date_sk, build_fact, fact_projection, fact_metrics, revenue_by_band,
        orders_by_month, first_24_months, check_null_keys, check_amount_mismatch,
        quality_summary, layer_counts, check_orphans, dim_key_conflicts, check_contract,
        dim_customer_stable, quarantine_rejects, scan_new_files, incremental_upsert_version,
        quarter_by_calendar, join_customer_bucketed, customer_history, fact_as_of,
        table_fingerprint, dim_region_by_table,
    ]
} | {"refine": refined}
