"""The four dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions.dates import date_key
from refinery.operators.keys import dense_key, dense_key_of_versions, stable_key
from refinery.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_REGION
from refinery.session import materialize

# The zone of each region. Extend by passing another mapping.
GEO_ZONES = {
    "north": "North Zone",
    "south": "South Zone",
    "east": "East Zone",
    "west": "West Zone",
    "central": "Central Zone",
    "northeast": "North Zone",
    "northwest": "North Zone",
    "southeast": "South Zone",
    "southwest": "South Zone",
}
NO_ZONE = "Unknown Zone"


def attribute_versions(clean: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Each distinct combination of key and attributes, with the last date it was seen.

    A hash aggregation over a fixed-width value, merged before the shuffle: the order
    rows are reduced to dimension size where they are read.
    """
    return clean.groupBy(key, *attributes).agg(F.max("order_date").alias("_seen"))


def latest_version(versions: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key: the version seen last; undated ones only if there is no other.

    Versions last seen on the same day are told apart by their attributes.
    """
    newest = F.max(F.struct("_seen", *attributes)).alias("_newest")
    return versions.groupBy(key).agg(newest).select(
        key, *[F.col(f"_newest.{a}").alias(a) for a in attributes]
    )


def dim_customer(
    clean: DataFrame, all_versions: bool = False, registry: str | None = None
) -> DataFrame:
    return _entity(clean, "customer_id", "customer_sk", all_versions, DIM_CUSTOMER.names, registry)


def dim_product(
    clean: DataFrame, all_versions: bool = False, registry: str | None = None
) -> DataFrame:
    return _entity(clean, "product_id", "product_sk", all_versions, DIM_PRODUCT.names, registry)


def _entity(
    clean: DataFrame, key: str, name: str, all_versions: bool, columns: list[str], registry: str | None
) -> DataFrame:
    """One row per key, or with ``all_versions`` one per distinct set of attributes.

    In the second form a key with conflicting attributes occupies several rows under
    one number, and joining on it multiplies the fact rows. With a ``registry`` an id keeps
    its number from run to run.
    """
    attributes = [c for c in columns if c not in (key, name)]
    if all_versions:
        distinct = clean.select(key, *attributes).distinct()
        if registry:
            return stable_key(distinct, key, name, registry).select(*columns)
        return dense_key_of_versions(distinct, key, name).select(*columns)
    rows = latest_version(attribute_versions(clean, key, attributes), key, attributes)
    if registry:
        return stable_key(materialize(rows, "latest"), key, name, registry).select(*columns)
    return dense_key(rows, key, name).select(*columns)


def distinct_regions(clean: DataFrame) -> DataFrame:
    return clean.select(F.col("region").alias("region_name")).distinct()


def geo_zone(region: Column | str, zones: Mapping[str, str] = GEO_ZONES) -> Column:
    """The zone of a region; a mapping of this size travels as a literal."""
    if not zones:
        return F.lit(NO_ZONE)
    lookup = F.create_map(*[F.lit(text) for pair in zones.items() for text in pair])
    return F.coalesce(F.element_at(lookup, region), F.lit(NO_ZONE))


def dim_region(
    clean: DataFrame, zones: Mapping[str, str] | DataFrame = GEO_ZONES, registry: str | None = None
) -> DataFrame:
    """One row per region. ``zones`` is a mapping, which travels as a literal, or a table
    (region_name, geo_zone) of any size, which is joined; of several zones of one region the
    first in order counts."""
    regions = distinct_regions(clean)
    if registry:
        numbered = stable_key(materialize(regions, "regions"), "region_name", "region_sk", registry)
    else:
        numbered = dense_key(regions, "region_name", "region_sk")
    if isinstance(zones, DataFrame):
        known = zones.groupBy(F.col("region_name").alias("_name")).agg(F.min("geo_zone").alias("_zone"))
        numbered = numbered.join(known, F.col("region_name") == F.col("_name"), "left")
        zone = F.coalesce("_zone", F.lit(NO_ZONE))
    else:
        zone = geo_zone(F.col("region_name"), zones)
    return numbered.withColumns(
        {"region_code": F.upper("region_name"), "geo_zone": zone}
    ).select(*DIM_REGION.names)


def dim_date(clean: DataFrame) -> DataFrame:
    """The calendar of the dates that occur; gaps are not filled."""
    day = F.col("order_date")
    days = clean.select(day).filter(day.isNotNull()).distinct()
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        (F.dayofmonth(day) == 1).alias("is_month_start"),
        (F.last_day(day) == day).alias("is_month_end"),
    ).select(*DIM_DATE.names)
