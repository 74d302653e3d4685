"""Orphans, linkage, coverage and small data-quality queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent
from fieldstay.functions.times import Clock, hour_field
from fieldstay.plans.common import count_all

EARTH_RADIUS_M = 6378168.0


def without_match(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose ``left`` value has no row in ``other`` (NULL never has one)."""
    keys = other.select(F.col(right).alias(left)).where(F.col(left).isNotNull())
    return df.join(keys, left, "left_anti")


def unmatched_properties(properties: DataFrame, photos: DataFrame) -> DataFrame:
    """Properties without any photo."""
    rows = without_match(properties, photos, "id", "property_pk")
    return rows.select("id", "property_id", "region_code", "property_name")


def orphans(df: DataFrame, properties: DataFrame, id_column: str) -> DataFrame:
    """Reservations or tasks whose property does not exist."""
    return without_match(df, properties, "property_pk", "id").select("id", id_column, "region_code")


def region_stats(regions: DataFrame, **entities: DataFrame) -> DataFrame:
    """Rows of each entity per region; ``id`` is unique, so plain counts replace distinct ones."""
    out = regions.select("region_code", "region_name")
    for name, df in entities.items():
        counts = df.groupBy("region_code").agg(count_all().alias(f"{name}_count"))
        out = out.join(counts, "region_code", "left")
    return out.fillna(0, [f"{n}_count" for n in entities])


def linkage_rate(tasks: DataFrame) -> DataFrame:
    """Share of tasks linked to a reservation per region: over all, and over those with a link id."""
    linked, has_id = F.count("reservation_pk"), F.count("linked_reservation_id")
    return tasks.groupBy("region_code").agg(
        count_all().alias("total_tasks"),
        has_id.alias("has_linked_res_id"),
        linked.alias("has_reservation_fk"),
        percent(linked, count_all()).alias("pct_linked"),
        percent(linked, has_id).alias("resolution_rate"),
    )


def child_counts(children: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per region of each child table."""
    parts = [
        df.groupBy("region_code").agg(count_all().alias("records")).withColumn("child", F.lit(name))
        for name, df in children.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def field_fill(df: DataFrame, columns: Sequence[str], since: Column, synced: str = "synced_at") -> DataFrame:
    """How many of the recently synced rows have each column filled."""
    recent = df.where(F.col(synced) > since)
    return recent.agg(count_all().alias("total"), *[F.count(c).alias(f"has_{c}") for c in columns])


def entity_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (entity, count) line per table."""
    lines = [df.agg(F.lit(n).alias("entity"), count_all().alias("records")) for n, df in tables.items()]
    return reduce(DataFrame.union, lines)


def orphan_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without the given foreign key, one line per table."""
    lines = [
        df.agg(F.lit(n).alias("entity"), F.count_if(F.col(fk).isNull()).alias("orphans"))
        for n, (df, fk) in tables.items()
    ]
    return reduce(DataFrame.union, lines)


def expiry_status(df: DataFrame, expires: str, clock: Clock) -> DataFrame:
    """``valid`` or ``expired`` with the hour field of the time left."""
    at = F.col(expires)
    left = F.abs(F.unix_micros(at) - F.unix_micros(clock.timestamp()))
    sign = F.when(at >= clock.timestamp(), 1).otherwise(-1)
    hours = F.floor(left / 3_600_000_000) % 24 * sign
    return df.withColumns(
        {
            "expiry_status": F.when(at > clock.timestamp(), "valid").otherwise("expired"),
            "hours_until_expiry": hours.cast("long"),
        }
    )


def region_list(regions: DataFrame, tenant: str, code: str) -> DataFrame:
    """Active region codes of each tenant as one ordered, space-joined line.

    The rows are a tenant's registered regions (an organisation chart, not data that grows).
    """
    codes = F.array_sort(F.collect_set(code))
    return regions.where("is_active").groupBy(tenant).agg(F.array_join(codes, " ").alias("regions"))


def properties_within_radius(df: DataFrame, lat: float, lon: float, metres: float) -> DataFrame:
    """Properties within a great-circle distance of a point, nearest first by ``distance_m``.

    A latitude band goes to the scan before the exact distance is computed.
    """
    band = metres / EARTH_RADIUS_M * 180.0 / 3.141592653589793 * 1.000001
    near = df.where(F.col("latitude_numeric").between(lat - band, lat + band))
    p, q = F.radians("latitude_numeric"), F.radians(F.lit(float(lat)))
    half_lat = F.sin((p - q) / 2)
    half_lon = F.sin((F.radians("longitude_numeric") - F.radians(F.lit(float(lon)))) / 2)
    chord = half_lat * half_lat + F.cos(p) * F.cos(q) * half_lon * half_lon
    distance = 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))
    return near.withColumn("distance_m", distance).where(F.col("distance_m") < metres)


def date_order_violations(reservations: DataFrame) -> DataFrame:
    """Reservations that end before they begin."""
    return reservations.where(F.col("checkout_date") < F.col("checkin_date"))


def sync_health(status: DataFrame, clock: Clock) -> DataFrame:
    """Per entity: regions synced, latest success, the hour field since, failures of the last day."""
    latest = F.max("last_successful_sync_at")
    recent_failure = (F.col("sync_status") == "failed") & (F.col("sync_started_at") > clock.hours_ago(24))
    return status.groupBy("entity_type").agg(
        F.count_distinct("region_code").alias("regions_synced"),
        latest.alias("most_recent_sync"),
        hour_field(latest, clock.timestamp()).alias("hours_since_last"),
        F.count_if(recent_failure).alias("failures_24h"),
    )
