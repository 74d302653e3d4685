"""Nested source records to relational rows, compiled from the entity specifications."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.parsing import coordinate, currency, id_text, whole_id, whole_number
from fieldstay.operators.entities import Child, Entity, Field
from fieldstay.operators.ranking import first_per_key

ARRIVAL = ["page", "pos"]
WHOLE = {"int": "int", "long": "bigint"}


def parent_value(f: Field, value: Column) -> Column:
    """A mapped value with the coercions of its target column."""
    if f.column in ("latitude_numeric", "longitude_numeric"):
        return coordinate(value)
    if f.column == "company_id":
        return whole_id(value)
    if f.column == "rate_paid":
        return currency(value)
    if f.kind == "num":
        return value.try_cast("double")
    if f.kind in WHOLE:
        return whole_number(value, WHOLE[f.kind])
    return value


def with_status(records: DataFrame, status: str | None) -> DataFrame:
    """Records of one source status; a record without a status is dropped."""
    return records if status is None else records.where(F.col("record.status") == status)


def map_parents(records: DataFrame, entity: Entity, synced_at: Column) -> DataFrame:
    """Parent columns of every record with region, sync time and arrival order."""
    flat = [parent_value(f, F.col(f"record.{f.source}")).alias(f.column) for f in entity.fields]
    nested = [
        parent_value(f, F.col(f"record.{obj}.{f.source}")).alias(f.column)
        for obj, group in entity.nested.items()
        for f in group
    ]
    return records.select("region_code", *flat, *nested, synced_at.alias("synced_at"), *ARRIVAL)


def transform_parents(records: DataFrame, entity: Entity, synced_at: Column) -> DataFrame:
    """Filter by status, map, and keep the first record of each natural key."""
    mapped = map_parents(with_status(records, entity.required_status), entity, synced_at)
    order = [F.col(c).asc() for c in ARRIVAL]
    return first_per_key(mapped, entity.natural_key, order).drop(*ARRIVAL)


def json_or_null(value: Column) -> Column:
    """A variant as JSON text; NULL, empty text, empty list or object, zero and false are NULL."""
    text = F.to_json(value)
    return F.when(text.isin("null", '""', "[]", "{}", "0", "0.0", "false"), None).otherwise(text)


def child_value(f: Field, value: Column) -> Column:
    """A sub-record value: ids are never NULL but empty text, flags default to false where the source
    leaves them out, numbers are read leniently, open-ended JSON becomes text.

    A missing id and an explicit null id cannot be told apart in a typed record; both are empty text.
    """
    if f.kind == "id":
        return id_text(value)
    if f.kind == "num":
        return value.try_cast("double")
    if f.kind in WHOLE:
        return whole_number(value, WHOLE[f.kind])
    if f.kind == "any":
        return json_or_null(value)
    if f.column in ("is_default", "is_primary"):
        return F.coalesce(value, F.lit(False))
    return value


def child_columns(child: Child, element: str) -> list[Column]:
    flat = [child_value(f, F.col(f"{element}.{f.source}")).alias(f.column) for f in child.fields]
    nested = [
        child_value(f, F.col(f"{element}.{obj}.{f.source}")).alias(f.column)
        for obj, group in child.nested.items()
        for f in group
    ]
    return flat + nested


def explode_children(records: DataFrame, entity: Entity, name: str) -> DataFrame:
    """Child rows of a list field with region, parent api id, arrival order and, where the child
    table is partitioned, the parent's partition column. A record without the list has no rows."""
    child = entity.children[name]
    id_field = entity.fields[0].source
    rows = with_status(records, entity.required_status).select(
        "region_code",
        "page",
        F.col("pos").alias("_record_pos"),
        F.col(f"record.{id_field}").cast("string").alias("parent_api_id"),
        *_parent_partition(child, "record"),
        F.posexplode(f"record.{child.source}").alias("pos", "item"),
    )
    return _child_rows(rows, child, ["page", "_record_pos", "pos"])


def map_child_pages(elements: DataFrame, parents: DataFrame, child: Child) -> DataFrame:
    """Child rows from sub-record pages; the partition column comes from the parent row."""
    rows = elements.withColumnsRenamed({"parent_id": "parent_api_id", "record": "item"})
    if child.partition_column:
        own = {f.column for f in child.fields}
        if child.partition_column not in own:
            stamps = parents.select(
                "region_code", F.col("task_id").alias("parent_api_id"), F.col(child.partition_column).alias("_partition")
            )
            rows = rows.join(stamps, ["region_code", "parent_api_id"], "left")
    return _child_rows(rows, child, ["pos"])


def _parent_partition(child: Child, record: str) -> list[Column]:
    return [F.col(f"{record}.{child.partition_column}").alias("_partition")] if child.partition_column else []


def _child_rows(rows: DataFrame, child: Child, order: Sequence[str]) -> DataFrame:
    columns = child_columns(child, "item")
    inherited = [F.col("_partition").alias(child.partition_column)] if "_partition" in rows.columns else []
    out = rows.select("region_code", "parent_api_id", *columns, *inherited, F.struct(*order).alias("arrival"))
    if child.table == "reservation_guests":
        out = out.where(F.coalesce("guest_name", "guest_email", "guest_phone").isNotNull())
    if child.table == "task_tags":
        out = out.where(F.col("tag_id") != "")
    return out


def inherit_partition(children: DataFrame, parents: DataFrame, column: str = "created_at", default: str = "2020-01-01") -> DataFrame:
    """Fill a child's missing partition value from its parent, and a fixed day for rows without one."""
    stamps = parents.select(F.col("id").alias("task_pk"), F.col(column).alias("_parent_value"))
    missing = F.col(column).isNull()
    filled = children.where(missing).join(stamps, "task_pk", "left").withColumn(
        column, F.coalesce("_parent_value", F.lit(default).cast(children.schema[column].dataType))
    )
    return children.where(~missing).unionByName(filled.select(*children.columns))


def widen_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to wider types on read."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def keep_known_external_ids(records: DataFrame, listings: DataFrame, column: str) -> DataFrame:
    """Records whose external id is a known listing."""
    known = listings.select(F.col("listing_id").alias(column)).where(F.col(column).isNotNull())
    return records.join(known, column, "left_semi")


def split_delimited_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str], delimiter: str = "--x--") -> DataFrame:
    """Rows out of parallel delimiter-joined text columns, with their position; a trailing delimiter
    adds nothing and empty pieces are NULL."""
    pieces = []
    for c in columns:
        trimmed = F.regexp_replace(F.col(c), f"{delimiter}$", "")
        pieces.append(F.split(F.nullif(trimmed, F.lit("")), delimiter).alias(c))
    zipped = df.select(*keep, F.posexplode(F.arrays_zip(*pieces)).alias("pos", "_z"))
    return zipped.select(*keep, "pos", *[F.nullif(F.col(f"_z.{c}"), F.lit("")).alias(c) for c in columns])
