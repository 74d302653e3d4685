"""Retention, cascades, tiering and status-row upkeep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators.ranking import join_sparse
from fieldstay.plans.common import count_all


def delete_matching(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a match in ``doomed``; keys that are not there change nothing."""
    return df.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def cascade_delete(
    doomed: DataFrame, children: Mapping[str, tuple[DataFrame, str]], soft: Mapping[str, tuple[DataFrame, str]]
) -> dict[str, DataFrame]:
    """Tables after parents ``doomed(id)`` are gone: children lose the rows of deleted parents,
    soft references become NULL."""
    ids = doomed.select(F.col("id").alias("_gone")).distinct()
    out = {}
    for name, (df, fk) in children.items():
        out[name] = df.join(ids, df[fk] == ids["_gone"], "left_anti")
    for name, (df, fk) in soft.items():
        marked = join_sparse(df, ids.select(F.col("_gone").alias(fk)).withColumn("_hit", F.lit(True)), fk)
        out[name] = marked.withColumn(fk, F.when(F.col("_hit").isNull(), F.col(fk))).select(*df.columns)
    return out


def event_kept(clock: Clock, days: int):
    old = F.col("received_at") < clock.hours_ago(24 * days)
    return ~(F.coalesce("processed", F.lit(False)) & old)


def retain_events(events: DataFrame, clock: Clock, days: int = 90) -> DataFrame:
    """Events without the processed ones older than ``days``; unprocessed events always stay."""
    return events.where(event_kept(clock, days))


def retention_report(events: DataFrame, clock: Clock, days: int = 90) -> DataFrame:
    """Total, kept and deleted event counts."""
    keep = F.count_if(event_kept(clock, days))
    return events.agg(
        count_all().alias("total_events"), keep.alias("keep_events"), (count_all() - keep).alias("delete_events")
    )


def retain_history(history: DataFrame, clock: Clock, column: str = "sync_started_at", days: int = 365) -> DataFrame:
    """History no older than ``days``. On month-partitioned storage whole partitions fall away."""
    return history.where(F.col(column) >= clock.days_ago(days))


def old_rows_report(batch: DataFrame, clock: Clock, column: str = "created_at", days: int = 90) -> DataFrame:
    """How many incoming rows belong to partitions that are already tiered."""
    old = F.col(column) < clock.hours_ago(24 * days)
    return batch.groupBy("region_code").agg(F.count_if(old).alias("old_rows"), count_all().alias("rows"))


def tier_layout(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Rows arranged for cold storage: one region side by side, newest first.

    The exchange key has a slice of the row's hash next to the region, so a region with most of the
    rows is written by as many tasks as there are shuffle partitions.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.pmod(F.xxhash64(*df.columns), F.lit(slices))
    return df.repartition(F.col("region_code"), slot).sortWithinPartitions(
        F.col("region_code"), F.col(column).desc()
    )


def fail_stale_runs(status: DataFrame, clock: Clock, message: str, hours: int = 1) -> DataFrame:
    """Runs still ``running`` after ``hours`` become ``failed`` now."""
    stale = F.coalesce(
        (F.col("sync_status") == "running") & (F.col("sync_started_at") < clock.hours_ago(hours)), F.lit(False)
    )
    return status.withColumns(
        {
            "sync_status": F.when(stale, "failed").otherwise(F.col("sync_status")),
            "sync_completed_at": F.when(stale, clock.timestamp()).otherwise(F.col("sync_completed_at")),
            "error_message": F.when(stale, message).otherwise(F.col("error_message")),
        }
    )


def purge_run_log(status: DataFrame, clock: Clock, days: int = 7) -> DataFrame:
    """Status rows without finished runs older than ``days``; running ones always stay."""
    old = F.col("sync_status").isin("success", "failed") & (F.col("sync_started_at") < clock.hours_ago(24 * days))
    return status.where(~F.coalesce(old, F.lit(False)))


def activate_region(
    tenant_regions: DataFrame, tenants: DataFrame, backfilled: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """After a successful backfill of (tenant_id, region_code): the region and its tenant go live."""
    hit = backfilled.select("region_code").distinct().withColumn("_hit", F.lit(True))
    regions = tenant_regions.join(hit, "region_code", "left").withColumn(
        "active", F.col("active") | F.col("_hit").isNotNull()
    )
    owner = backfilled.select(F.col("tenant_id").alias("id")).distinct().withColumn("_hit", F.lit(True))
    live = tenants.join(owner, "id", "left").withColumn(
        "status", F.when(F.col("_hit").isNotNull(), "active").otherwise(F.col("status"))
    )
    return regions.select(*tenant_regions.columns), live.select(*tenants.columns)
