"""Column contracts of every layer; the one place where names and types live.

A required column is declared not nullable: publishing a null in it fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOLEAN, DATE, TIMESTAMP = BooleanType(), DateType(), TimestampType()


def _table(required: Sequence[str] = (), **columns: DataType) -> StructType:
    return StructType([StructField(c, t, c not in required) for c, t in columns.items()])


# The column names, types and order every consumer relies on.
RAW = _table(
    order_id=STRING, customer_id=STRING, customer_name=STRING,
    product_id=STRING, product_name=STRING, category=STRING,
    quantity=STRING, unit_price=STRING, total_amount=STRING,
    order_date=STRING, region=STRING, status=STRING,
)

CLEAN = _table(
    required=["order_id", "customer_id", "product_id"],
    order_id=STRING, customer_id=STRING, customer_name=STRING,
    product_id=STRING, product_name=STRING, category=STRING,
    quantity=INT, unit_price=DOUBLE, total_amount=DOUBLE,
    order_date_raw=STRING, region=STRING, status=STRING,
    order_date_clean=STRING, order_date=DATE, is_date_missing=BOOLEAN,
    calculated_total=DOUBLE, total_amount_mismatch=BOOLEAN,
    order_year=INT, order_month=INT, processed_at=TIMESTAMP,
)

# What an order line has to be before it is cleaned, for a load that takes only whole ones.
ORDER_LINE = _table(
    required=["order_id", "customer_id", "product_id"],
    order_id=STRING, customer_id=STRING, product_id=STRING,
    quantity=INT, unit_price=DOUBLE, order_date=DATE,
)

# Records with too few or too many fields; those kept are in the clean table's input too.
BROKEN_RECORDS = _table(
    order_id=STRING, record=STRING, kept=BOOLEAN, processed_at=TIMESTAMP,
)

# The ledger of a table: the files its rows came from.
FILES_READ = _table(path=STRING, modified=TIMESTAMP, bytes=LONG)

# What a table's rows add up to, whatever their order.
FINGERPRINT = _table(rows=LONG, digest=STRING)

DIM_CUSTOMER = _table(
    required=["customer_sk"],
    customer_sk=LONG, customer_id=STRING, customer_name=STRING, region=STRING,
)

DIM_PRODUCT = _table(
    required=["product_sk"],
    product_sk=LONG, product_id=STRING, product_name=STRING, category=STRING,
)

DIM_DATE = _table(
    required=["date_sk"],
    date_sk=INT, order_date=DATE, year=INT, quarter=INT, month=INT, month_name=STRING,
    week_of_year=INT, day_of_month=INT, day_of_week=INT, day_name=STRING,
    is_weekend=BOOLEAN, is_month_start=BOOLEAN, is_month_end=BOOLEAN,
)

DIM_REGION = _table(
    required=["region_sk"],
    region_sk=LONG, region_name=STRING, region_code=STRING, geo_zone=STRING,
)

FACT_SALES = _table(
    customer_sk=LONG, product_sk=LONG, date_sk=INT, region_sk=LONG,
    order_id=STRING, customer_id=STRING, product_id=STRING,
    order_date=DATE, order_year=INT, order_month=INT, status=STRING,
    quantity=INT, unit_price=DOUBLE, total_amount=DOUBLE, calculated_total=DOUBLE,
    revenue=DOUBLE, discount_amount=DOUBLE, discount_rate=DOUBLE, avg_unit_price=DOUBLE,
    is_high_value=BOOLEAN, order_size_bucket=STRING, revenue_band=STRING,
    is_date_missing=BOOLEAN, total_amount_mismatch=BOOLEAN,
    processed_at=TIMESTAMP, processed_at_gold=TIMESTAMP,
)

BUSINESS_KEY = ["order_id", "product_id"]
REQUIRED_KEYS = ["order_id", "customer_id", "product_id"]
SURROGATE_KEYS = ["customer_sk", "product_sk", "date_sk", "region_sk"]
PARTITION_COLUMNS = ["order_year", "order_month"]
AUDIT_COLUMNS = ["processed_at", "processed_at_gold"]
