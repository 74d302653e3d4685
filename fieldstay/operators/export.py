"""Incremental export by high-water mark, with JSON payload rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstay.operators.links import fold_requirements
from fieldstay.operators.merge import merge
from fieldstay.operators.ranking import join_sparse

# Exported columns, their target names, and the ones forced to text.
PROPERTY_COLUMNS = (
    "region_code",
    "property_id",
    "reference_external_property_id",
    "reference_company_id",
    "property_name",
    "property_status",
    "property_address1",
    "property_address2",
    "property_city",
    "property_state",
    "property_zipcode",
    "latitude_numeric",
    "longitude_numeric",
    "bedrooms",
    "bathrooms",
    "wifi_name",
    "wifi_password",
    "synced_at",
)
PROPERTY_RENAMES = {
    "property_id": "source_property_id",
    "reference_external_property_id": "listing_id",
    "latitude_numeric": "latitude",
    "longitude_numeric": "longitude",
    "synced_at": "source_synced_at",
    "wifi_name": "wifi_ssid",
}
PROPERTY_TEXT = ("source_property_id", "listing_id", "reference_company_id", "property_zipcode")
LINK_COLUMNS = (
    "region_code",
    "reservation_id",
    "task_id",
    "reservation_pk",
    "task_pk",
    "home_id",
    "reference_property_id",
    "task_name",
    "task_description",
    "type_department",
    "type_priority",
    "task_status_code",
    "task_status_name",
    "task_status_stage",
    "scheduled_date",
    "scheduled_time",
    "task_created_at",
    "started_at",
    "finished_at",
    "paused",
    "rate_type",
    "rate_paid",
    "total_time",
    "template_id",
    "report_url",
    "assignments",
    "supplies",
    "costs",
    "tags",
    "task_tags",
    "raw_payload",
    "synced_at",
)
LINK_RENAMES = {
    "task_id": "source_task_id",
    "home_id": "source_property_id",
    "synced_at": "source_synced_at",
}
LINK_TEXT = (
    "reservation_id", "source_task_id", "source_property_id", "reference_property_id", "template_id",
    "total_time", "type_priority",
)


def changed_since(df: DataFrame, watermarks: DataFrame, table: str, full: bool = False) -> DataFrame:
    """Rows synced after their region's mark; all rows of a region without one, or of a full run.

    A row without a sync time cannot be after a mark.
    """
    if full:
        return df
    marks = watermarks.where(F.col("table_name") == table).select("region_code", F.col("last_pushed_at").alias("_mark"))
    kept = df.join(marks, "region_code", "left")
    return kept.where(F.col("_mark").isNull() | (F.col("synced_at") > F.col("_mark"))).drop("_mark")


def advance_watermarks(
    watermarks: DataFrame, pushed: DataFrame, table: str, failed: DataFrame | None = None, dry_run: bool = False
) -> DataFrame:
    """Marks after a push of rows (region_code, synced_at): the later of old and new, row counts
    added up. Regions with failures keep their mark; a dry run changes nothing."""
    if dry_run:
        return watermarks
    batch = (
        pushed.groupBy("region_code")
        .agg(F.max("synced_at").alias("last_pushed_at"), F.count(F.lit(1)).alias("rows_pushed"))
        .where(F.col("last_pushed_at").isNotNull())
        .withColumn("table_name", F.lit(table))
    )
    if failed is not None:
        batch = batch.join(failed.select("region_code").distinct(), "region_code", "left_anti")
    values = {
        "last_pushed_at": F.greatest("t.last_pushed_at", "s.last_pushed_at"),
        "rows_pushed": F.col("t.rows_pushed") + F.col("s.rows_pushed"),
    }
    return merge(watermarks, batch, ["table_name", "region_code"], values=values).drop("op")


def export_rows(
    df: DataFrame, columns: Sequence[str], renames: Mapping[str, str], text: Sequence[str]
) -> DataFrame:
    """Target-shaped rows: renamed columns, ids as text, decimals as doubles, ISO dates and times."""
    out = []
    for c in columns:
        name, value = renames.get(c, c), F.col(c)
        kind = df.schema[c].dataType
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, T.TimestampType):
            whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            value = F.when(F.unix_micros(value) % 1_000_000 == 0, whole).otherwise(micros)
        elif isinstance(kind, T.DateType):
            value = value.cast("string")
        if name in text:
            value = value.cast("string")
        out.append(value.alias(name))
    return df.select(*out)


def json_payload(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row as one JSON object next to its key columns; absent values are explicit nulls."""
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(*keys, body.alias("payload"))


def export_properties(properties: DataFrame, watermarks: DataFrame, table: str = "property_dim", full: bool = False) -> DataFrame:
    """Changed properties in the target's shape."""
    changed = changed_since(properties, watermarks, table, full)
    return export_rows(changed, PROPERTY_COLUMNS, PROPERTY_RENAMES, PROPERTY_TEXT)


def export_links(
    links: DataFrame, requirements: DataFrame, watermarks: DataFrame, table: str = "reservation_tasks", full: bool = False
) -> DataFrame:
    """Changed link rows with the folded requirements of their task.

    A task with more requirements than one list holds comes as several rows, numbered by ``part``: the key of
    an exported row is (reservation, task, region, part).
    """
    changed = changed_since(links, watermarks, table, full)
    wanted = changed.select("task_pk").where(F.col("task_pk").isNotNull()).distinct()
    folded = fold_requirements(requirements.join(wanted, "task_pk", "left_semi"))
    rows = export_rows(changed, LINK_COLUMNS, LINK_RENAMES, LINK_TEXT)
    return join_sparse(rows, folded, "task_pk").withColumn("part", F.coalesce("part", F.lit(0)))


def latest_property_status(events: DataFrame) -> DataFrame:
    """The newest status event of each (region_code, property_id), by arrival.

    ``events`` are normalised property events with blocking counts; unresolved regions are skipped.
    """
    known = events.where((F.col("property_id") != "") & (F.col("region_code") != "unknown"))
    newest = Window.partitionBy("region_code", "property_id").orderBy(
        F.col("received_at").desc(), F.col("event_id").desc()
    )
    return known.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") == 1).drop("_n")
