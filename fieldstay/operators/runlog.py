"""Run status rows, run history and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import rounded
from fieldstay.functions.times import Clock, hour_field, micros_between
from fieldstay.operators.merge import merge
from fieldstay.operators.ranking import first_per_key
from fieldstay.plans.common import count_all

RUN_KEY = ["region_code", "entity_type"]
COUNTERS = ("records_processed", "records_new", "api_calls_made")
SLOW_SECONDS = 300


def latest_status(history: DataFrame) -> DataFrame:
    """The newest run of each region and entity."""
    newest = [F.col(c).desc_nulls_last() for c in ("sync_started_at", "sync_completed_at", "records_processed")]
    return first_per_key(history, RUN_KEY, newest)


def start_runs(status: DataFrame, started: DataFrame, clock: Clock) -> DataFrame:
    """Mark (region_code, entity_type) rows as running: counters zero, end and error cleared, the
    last success kept."""
    blank = {c: F.lit(0).cast("long") for c in COUNTERS}
    batch = started.select(*RUN_KEY).distinct().withColumns(
        {
            "sync_status": F.lit("running"),
            "sync_started_at": clock.timestamp(),
            "sync_completed_at": F.lit(None).cast("timestamp"),
            "error_message": F.lit(None).cast("string"),
            **blank,
        }
    )
    return merge(status, batch, RUN_KEY).drop("op")


def finish_runs(status: DataFrame, results: DataFrame, clock: Clock) -> tuple[DataFrame, DataFrame]:
    """Close running rows with (region_code, entity_type, sync_status, error_message, counters).

    Returns the next status table and the history rows to append. A success moves the last-success
    time; a failed or partial run keeps it.
    """
    batch = results.withColumns(
        {
            "sync_completed_at": clock.timestamp(),
            "last_successful_sync_at": F.when(F.col("sync_status") == "success", clock.timestamp()),
        }
    )
    keep_last = {
        "last_successful_sync_at": F.coalesce("s.last_successful_sync_at", "t.last_successful_sync_at")
    }
    merged = merge(status, batch, RUN_KEY, insert=False, values=keep_last)
    seconds = (micros_between("sync_started_at", "sync_completed_at") / 1_000_000).cast("double")
    history = merged.where(F.col("op") == "update").withColumn("duration_seconds", rounded(seconds, 2))
    return merged.drop("op"), history.drop("op", "last_successful_sync_at")


def sync_recent(status: DataFrame, clock: Clock, hours: int = 24) -> DataFrame:
    """Runs started within the last hours."""
    return status.where(F.col("sync_started_at") > clock.hours_ago(hours)).select(
        *RUN_KEY, "sync_status", "sync_started_at", "last_successful_sync_at", "records_processed", "api_calls_made"
    )


def sync_failed(status: DataFrame, limit: int = 10) -> DataFrame:
    """The latest failures (a top-k report)."""
    rows = status.where(F.col("sync_status") == "failed").select(*RUN_KEY, "error_message", "sync_started_at")
    return rows.orderBy(F.col("sync_started_at").desc_nulls_last(), *RUN_KEY).limit(limit)


def stale_runs(status: DataFrame, clock: Clock, hours: int = 1) -> DataFrame:
    """Runs still running after ``hours``."""
    return status.where((F.col("sync_status") == "running") & (F.col("sync_started_at") < clock.hours_ago(hours)))


def unsettled_runs(status: DataFrame, clock: Clock) -> DataFrame:
    """Failed or running entities that last succeeded within a day, with the hour field since."""
    recent = F.col("last_successful_sync_at") > clock.hours_ago(24)
    return status.where(recent & F.col("sync_status").isin("failed", "running")).select(
        *RUN_KEY,
        "sync_status",
        "last_successful_sync_at",
        hour_field(F.col("last_successful_sync_at"), clock.timestamp()).alias("hours_ago"),
    )


def sync_durations(history: DataFrame, region: str, entity: str, limit: int = 10) -> DataFrame:
    """Seconds of the latest runs of one region and entity (a top-k report)."""
    runs = history.where((F.col("region_code") == region) & (F.col("entity_type") == entity))
    seconds = micros_between("sync_started_at", "sync_completed_at").cast("double") / 1_000_000
    return (
        runs.select(*RUN_KEY, "sync_started_at", "sync_completed_at", seconds.alias("duration_seconds"), "records_processed")
        .orderBy(F.col("sync_started_at").desc_nulls_last())
        .limit(limit)
    )


def sync_volume_trend(history: DataFrame, clock: Clock, days: int = 7) -> DataFrame:
    """Mean calls and records of successful runs of the last days per region and entity."""
    recent = (F.col("sync_started_at") > clock.hours_ago(24 * days)) & (F.col("sync_status") == "success")
    return history.where(recent).groupBy(*RUN_KEY).agg(
        F.avg("api_calls_made").alias("avg_api_calls"),
        F.avg("records_processed").alias("avg_records"),
        count_all().alias("sync_count"),
    )


def batch_summary(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Jobs, successes, failures, wall time from first start to last end, and slow runs."""
    seconds = micros_between("sync_started_at", "sync_completed_at").cast("double") / 1_000_000
    ok = F.count_if(F.col("sync_status") == "success")
    span = micros_between(F.min("sync_started_at"), F.max("sync_completed_at")).cast("double") / 1_000_000
    return history.groupBy(*by).agg(
        count_all().alias("total_jobs"),
        ok.alias("successful"),
        (count_all() - ok).alias("failed"),
        rounded(span, 1).alias("duration_seconds"),
        F.count_if(seconds > SLOW_SECONDS).alias("slow_runs"),
    )


def tenant_status(tenant_regions: DataFrame, status: DataFrame) -> DataFrame:
    """Every region of every tenant with its entities' latest runs as one ordered JSON list.

    The status table has one row per region and entity type, so a list is as long as there are
    entity types.
    """
    entry = F.struct("entity_type", "sync_status", "sync_completed_at", "records_processed", "error_message")
    lists = (
        status.where(F.col("entity_type").isNotNull())
        .groupBy("region_code")
        .agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("entities"))
    )
    return tenant_regions.join(lists, "region_code", "left").withColumn(
        "entities", F.coalesce("entities", F.lit("[]"))
    )
