"""Reconciliation of stored tables with full listings of the source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.plans.common import count_all
from fieldstay.session import durable

# States that only the lifecycle listing decides.
LIFECYCLE_STATES = ("inactive", "deleted")
STRIKES_TO_DELETE = 2
DELETE_REASON = "confirmed missing on 2 successive runs"


@dataclass(frozen=True)
class Reconciled:
    """The next table, the audit rows of what was removed, counts per region and action, and the rows with an action other
    than ``keep`` as they were."""

    table: DataFrame
    audit: DataFrame
    counts: DataFrame
    changed: DataFrame


def _flag(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.select(*keys).distinct().withColumn(name, F.lit(True))


def decide_deletes(
    tasks: DataFrame, listed: DataFrame, good_parents: DataFrame, probes: DataFrame, clock: Clock,
    past_days: int, future_days: int,
) -> DataFrame:
    """Tasks with an ``action``: ``reset``, ``strike``, ``delete`` or ``keep``.

    Only tasks scheduled inside the window whose property was listed completely are judged, and only
    in regions where something was listed. A judged task that is listed, or probed present, loses its
    strikes; one probed deleted gains a strike and goes at the second; an unknown verdict changes
    nothing.
    """
    in_window = F.col("scheduled_date").between(clock.date_ago(past_days), clock.date_ago(-future_days))
    region, task = ["region_code"], ["region_code", "task_id"]
    rows = (
        tasks.join(_flag(listed, region, "_region"), region, "left")
        .join(_flag(good_parents, ["region_code", "home_id"], "_parent"), ["region_code", "home_id"], "left")
        .join(_flag(listed, task, "_listed"), task, "left")
        .join(probes.groupBy(*task).agg(F.min("verdict").alias("_verdict")), task, "left")
    )
    judged = F.coalesce(in_window, F.lit(False)) & F.col("_region").isNotNull() & F.col("_parent").isNotNull()
    strikes = F.coalesce("missing_strikes", F.lit(0)) + 1
    action = (
        F.when(~judged, "keep")
        .when(F.col("_listed").isNotNull() | (F.col("_verdict") == "present"), "reset")
        .when((F.col("_verdict") == "deleted") & (strikes >= STRIKES_TO_DELETE), "delete")
        .when(F.col("_verdict") == "deleted", "strike")
        .otherwise("keep")
    )
    return rows.withColumn("action", action).select(*tasks.columns, "action")


def reconcile_deletes(
    tasks: DataFrame, listed: DataFrame, good_parents: DataFrame, probes: DataFrame, clock: Clock,
    past_days: int = 14, future_days: int = 30, dry_run: bool = False,
) -> Reconciled:
    """Apply :func:`decide_deletes`: the table with strikes kept up, and an audit of removed rows. A dry
    run only counts what would happen."""
    decided = durable(decide_deletes(tasks, listed, good_parents, probes, clock, past_days, future_days))
    struck, reset = F.col("action") == "strike", F.col("action") == "reset"
    strikes, since = F.col("missing_strikes"), F.col("missing_since")
    changed = decided.where(F.col("action") != "delete").withColumns(
        {
            "missing_strikes": F.when(reset, F.lit(0)).when(struck, strikes + 1).otherwise(strikes)
            .cast(tasks.schema["missing_strikes"].dataType),
            "missing_since": F.when(struck, F.coalesce(since, clock.timestamp())).when(~reset, since),
        }
    )
    removed = decided.where(F.col("action") == "delete").select(*tasks.columns)
    counts = decided.groupBy("region_code", "action").agg(count_all().alias("tasks"))
    moved = decided.where(F.col("action") != "keep")
    if dry_run:
        return Reconciled(decided.select(*tasks.columns), delete_audit(removed.where(F.lit(False)), clock), counts, moved.where(F.lit(False)))
    return Reconciled(changed.select(*tasks.columns), delete_audit(removed, clock), counts, moved)


def delete_audit(rows: DataFrame, clock: Clock, reason: str = DELETE_REASON) -> DataFrame:
    """Removed rows kept whole as JSON next to the columns people search by."""
    return rows.select(
        clock.timestamp().alias("deleted_at"),
        "region_code", "task_id", "task_name", "scheduled_date",
        F.lit(reason).alias("reason"),
        F.to_json(F.struct(*rows.columns)).alias("task_row"),
    )


def _lifecycle(c: Column) -> Column:
    return c.isin(*LIFECYCLE_STATES)


def decide_lifecycle(properties: DataFrame, listed: DataFrame, complete: DataFrame) -> DataFrame:
    """Stored properties with ``new_status`` and ``new_external_id`` (NULL = leave as it is).

    ``listed`` is (region_code, property_id, status, external_id); ``complete`` (region_code,
    complete). A status changes only where one of the two sides is a lifecycle state. The external id
    follows the listing, also when it becomes empty. A property missing from a complete list becomes
    ``deleted``. Regions with an empty list are left alone.
    """
    found = listed.groupBy("region_code", "property_id").agg(
        F.max_by(F.coalesce("status", F.lit("")), "position").alias("_status"),
        F.max_by(F.coalesce("external_id", F.lit("")), "position").alias("_external"),
    ).withColumn("_hit", F.lit(True))
    listing = _flag(listed, ["region_code"], "_region").join(complete, "region_code", "left")
    rows = properties.join(listing, "region_code", "left").join(found, ["region_code", "property_id"], "left")
    stored = F.coalesce("property_status", F.lit(""))
    external = F.coalesce("external_id", F.lit(""))
    hit, offered = F.col("_hit").isNotNull(), F.col("_status")
    gone = F.col("_region").isNotNull() & ~hit & F.coalesce("complete", F.lit(False)) & (stored != "deleted")
    moved = hit & (offered != stored) & (_lifecycle(offered) | _lifecycle(stored))
    return rows.withColumns(
        {
            "new_status": F.when(gone, "deleted").when(moved, offered),
            "new_external_id": F.when(hit & (F.col("_external") != external), F.col("_external")),
            "marked_deleted": gone,
        }
    ).select(*properties.columns, "new_status", "new_external_id", "marked_deleted")


def lifecycle_change() -> Column:
    """Whether :func:`decide_lifecycle` changes a row."""
    return F.col("new_status").isNotNull() | F.col("new_external_id").isNotNull()


def apply_lifecycle(decided: DataFrame, clock: Clock) -> tuple[DataFrame, DataFrame]:
    """The next property table of decided rows and the change counts per region."""
    status, external = F.col("new_status"), F.col("new_external_id")
    counts = decided.groupBy("region_code").agg(
        F.count_if(status.isNotNull() & ~F.col("marked_deleted")).alias("status_fixed"),
        F.count(external).alias("external_fixed"),
        F.count_if("marked_deleted").alias("marked_deleted"),
    )
    table = decided.withColumns(
        {
            "property_status": F.coalesce(status, "property_status"),
            "external_id": F.coalesce(external, "external_id"),
            "synced_at": F.when(lifecycle_change(), clock.timestamp()).otherwise(F.col("synced_at")),
        }
    )
    return table.drop("new_status", "new_external_id", "marked_deleted"), counts


def reconcile_lifecycle(
    properties: DataFrame, listed: DataFrame, complete: DataFrame, clock: Clock, dry_run: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The next property table and the change counts per region; a dry run changes nothing."""
    decided = durable(decide_lifecycle(properties, listed, complete))
    table, counts = apply_lifecycle(decided, clock)
    return decided.select(*properties.columns) if dry_run else table.select(*properties.columns), counts
