"""Insert-or-update of a batch into a table snapshot.

A snapshot is a DataFrame; the result is the next snapshot with an ``op`` column (``insert``,
``update`` or ``keep``). A row with a NULL in its key never matches, so it is inserted every time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.operators.ranking import first_per_key, row_slot
from fieldstay.plans.common import count_all
from fieldstay.session import durable
from fieldstay.sources.snapshot import Snapshot, SnapshotStore, touched_values

def null_slot(df: DataFrame, keys: Sequence[str]) -> Column:
    """Zero for a complete key, else a number by the row's content.

    Rows with a NULL in their key match nothing. As a join column this spreads them over all tasks
    instead of sending every one of them to the task of the NULL key.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(complete, F.lit(0)).otherwise(row_slot(df))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    no_update: Sequence[str] = (),
    update: bool = True,
    insert: bool = True,
    values: Mapping[str, Column] | None = None,
    defaults: Mapping[str, Column] | None = None,
    stamp: Column | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """The next snapshot of ``target`` after a batch ``source`` with at most one row per key.

    ``no_update`` columns are written on insert only. ``update=False`` leaves matched rows alone;
    ``insert=False`` ignores unmatched batch rows. ``values`` replaces the plain "take the batch
    value" rule of a column by an expression over ``t.<column>`` and ``s.<column>``. ``defaults``
    fill target-only columns of inserted rows. ``stamp`` is written to ``updated_at`` of every
    changed row. ``small_batch`` says the batch is likely to be small against the table: it is stored
    first, so that Spark knows its size, and the table is joined in place instead of by a full outer
    join. If the size is below the broadcast threshold the table is not shuffled.
    """
    values, defaults = dict(values or {}), dict(defaults or {})
    columns, given = target.columns, set(source.columns)
    if small_batch:
        source = durable(source)
    old = target.withColumns({"_t": F.lit(True), "_slot": null_slot(target, keys)}).alias("t")
    new = source.withColumns({"_s": F.lit(True), "_slot": null_slot(source, keys)}).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in [*keys, "_slot"]])
    in_old, in_new = F.col("_t").isNotNull(), F.col("_s").isNotNull()

    def result(c: str) -> Column:
        before = F.col(f"t.{c}")
        if c in keys:
            return F.coalesce(before, F.col(f"s.{c}"))
        if c == "updated_at" and stamp is not None:
            changed = ~in_old | (in_new if update else F.lit(False))
            return F.when(changed, stamp).otherwise(before)
        if c not in given:
            return F.when(in_old, before).otherwise(defaults[c]) if c in defaults else before
        after = F.col(f"s.{c}")
        if not update or c in no_update:
            return F.when(in_old, before).otherwise(after)
        taken = F.when(in_old, values[c]).otherwise(after) if c in values else after
        return F.when(in_new, taken).otherwise(before)

    touched = F.lit("update" if update else "keep")
    op = F.when(~in_old, "insert").when(in_new, touched).otherwise("keep").alias("op")
    shape = [*[result(c).alias(c) for c in columns], op]

    if insert and not small_batch:
        return old.join(new, on, "full_outer").select(*shape)
    # The table stays where it is; batch keys it already has are found by a semi join.
    merged = old.join(new, on, "left").select(*shape)
    if insert:
        present = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
        merged = merged.unionByName(inserted_rows(source.join(present, list(keys), "left_anti"), target, defaults, stamp))
    return merged


def inserted_rows(
    rows: DataFrame, target: DataFrame, defaults: Mapping[str, Column], stamp: Column | None
) -> DataFrame:
    """Batch rows in the table's shape, as :func:`merge` inserts them."""
    out = []
    for f in target.schema:
        if f.name == "updated_at" and stamp is not None:
            value = stamp
        elif f.name in rows.columns:
            value = F.col(f.name)
        else:
            value = defaults.get(f.name, F.lit(None))
        out.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*out, F.lit("insert").alias("op"))


def merge_counts(merged: DataFrame) -> DataFrame:
    """Inserted and updated row counts of a merge result."""
    return merged.agg(
        F.count_if(F.col("op") == "insert").alias("inserted"),
        F.count_if(F.col("op") == "update").alias("updated"),
        count_all().alias("table_rows"),
    )


def upsert_parent(
    target: DataFrame,
    batch: DataFrame,
    natural_key: Sequence[str],
    *,
    partition_column: str | None = None,
    no_update: Sequence[str] = (),
    stamp: Column | None = None,
    small_batch: bool = False,
) -> DataFrame:
    """Parent rule: the partition column joins the match key, ``created_at`` is never updated."""
    keys = [*natural_key]
    if partition_column and partition_column not in keys:
        keys.append(partition_column)
    return merge(
        target, batch, keys, no_update=[*no_update, "created_at"], stamp=stamp, small_batch=small_batch
    )


def child_key(natural_key: Sequence[str], partition_column: str | None) -> list[str]:
    """What tells the rows of a child table apart."""
    return [*natural_key, *([partition_column] if partition_column and partition_column not in natural_key else [])]


def upsert_child(
    target: DataFrame,
    batch: DataFrame,
    natural_key: Sequence[str],
    order: Sequence[Column],
    *,
    partition_column: str | None = None,
) -> DataFrame:
    """Child rule for rows whose foreign keys are resolved: first of equal keys wins, all non-key
    columns are updated, a table of key columns only ignores matches, no key means append."""
    payload = [c for c in batch.columns if c in target.columns]
    if not natural_key:
        appended = inserted_rows(batch, target, {}, None)
        return target.withColumn("op", F.lit("keep")).unionByName(appended)
    keys = child_key(natural_key, partition_column)
    first = first_per_key(batch, keys, order).select(*payload)
    only_keys = not [c for c in payload if c not in keys and c != "id"]
    return merge(target, first, keys, no_update=["id"], update=not only_keys)


def upsert_table(
    store: SnapshotStore, table: str, batch: DataFrame, keys: Sequence[str], column: str, *,
    based_on: Snapshot | None = None, **options,
) -> DataFrame:
    """Merge a batch into a stored table whose partition column is in the key: only the partitions
    that the batch touches are read and written. Returns the merge counts.

    Where another writer changes one of these partitions meanwhile, the merge is done again on the newer version; with
    ``based_on``, the snapshot the caller has read, ConflictError is raised instead.
    """
    touched = touched_values(batch, column)

    def run(seen: Snapshot) -> DataFrame:
        merged = durable(merge(seen.read(table, touched), batch, keys, **options))
        with store.begin(seen) as change:
            change.upsert(table, merged, touched)
        return merge_counts(merged)

    return run(based_on) if based_on else store.attempt(run)


def upsert_dimension(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], *, on_insert: Mapping[str, Column] | None = None,
    keep: Sequence[str] = (), stamp: Column | None = None,
) -> DataFrame:
    """Small dimension rows: named columns are updated, ``keep`` columns and ``on_insert`` defaults
    (such as an inactive flag for new regions) are written once."""
    return merge(target, batch, keys, no_update=keep, defaults=on_insert, stamp=stamp)


def upsert_links(target: DataFrame, batch: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Reservation-task links on (reservation, task, region). Of several rows for one link in a batch one
    counts: the greatest by its other columns in their order."""
    keys = ["reservation_id", "task_id", "region_code"]
    others = [F.col(c).desc_nulls_last() for c in batch.columns if c not in keys]
    return merge(target, first_per_key(batch, keys, others) if others else batch.distinct(), keys, stamp=stamp)
