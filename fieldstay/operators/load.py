"""Loading one entity: landed pages to stored parent and child tables, with keys and a run log."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators import keys, records, runlog
from fieldstay.operators.entities import ENTITIES, Child, Entity, child_schema, record_schema
from fieldstay.operators.merge import child_key, inserted_rows, upsert_child, upsert_parent
from fieldstay.operators.ranking import first_per_key
from fieldstay.plans.common import count_all
from fieldstay.session import durable
from fieldstay.sources.pages import checked_pages, unreadable_pages, unwrap_child_pages
from fieldstay.sources.snapshot import Snapshot, SnapshotStore, Transaction, touched_values

TIMES = ("created_at", "updated_at", "started_at", "finished_at", "assigned_at", "uploaded_at")
DATES = ("scheduled_date", "checkin_date", "checkout_date")

# Soft foreign keys of the parent tables as (column, referenced table, local -> referenced).
FOREIGN_KEYS = {
    "reservations": (("property_pk", "properties", {"property_id": "property_id", "region_code": "region_code"}),),
    "tasks": (
        ("property_pk", "properties", {"home_id": "property_id", "region_code": "region_code"}),
        ("reservation_pk", "reservations", {"linked_reservation_id": "reservation_id", "region_code": "region_code"}),
    ),
}


def typed(df: DataFrame) -> DataFrame:
    """Time and date columns out of their text; unreadable values are NULL."""
    casts = {c: F.col(c).try_cast("timestamp") for c in TIMES if c in df.columns}
    casts |= {c: F.col(c).try_cast("date") for c in DATES if c in df.columns}
    return df.withColumns(casts)


def _period(partition_column: str | None) -> tuple[str, Column]:
    """Storage partition of a table: its region, or the month of its partition column."""
    if partition_column is None:
        return "region_code", F.col("region_code")
    return "created_month", F.trunc(partition_column, "month")


def _child_period(entity: Entity, child: Child) -> tuple[str, Column]:
    """Storage partition of a child table: that of its own partition column; the parent's month where the parent
    has one and its key is in the child's, so that a load rewrites only the months it has parents of."""
    if child.partition_column is None and entity.partition_column and child.parent_fk in child.natural_key:
        return "parent_month", F.col("parent_month")
    return _period(child.partition_column)


def _open(change: Transaction, table: str, batch: DataFrame, column: str, extra: Mapping[str, str], **shape) -> None:
    """Create the table, empty, the first time a batch for it arrives."""
    if change.exists(table):
        return
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in extra.items()]
    change.write(table, batch.select(*blank, "*").where(F.lit(False)), column, **shape)


def _number_new_rows(change: Transaction, table: str, merged: DataFrame) -> DataFrame:
    """Give inserted rows ids of a block that no other load gets. Ids are unique but not consecutive, so no
    task has to see all new rows; an old table without a sequence is looked through once for its largest id."""
    placed = durable(merged.withColumn("_new", F.monotonically_increasing_id()))
    last = placed.where(F.col("id").isNull()).agg(F.max("_new")).first()[0]
    if last is None:
        return placed.drop("_new")
    first = _first_id(change, table, last)
    return placed.withColumn("id", F.coalesce("id", F.lit(first) + F.col("_new"))).drop("_new")


def _first_id(change: Transaction, table: str, last: int) -> int:
    """The first id of a block for rows numbered from 0 to ``last``."""
    known = table in change.store.snapshot().ids
    least = 1 if known else (change.read(table).agg(F.max("id")).first()[0] or 0) + 1
    return change.store.reserve(table, last + 1, least)


def _all_new(change: Transaction, table: str, batch: DataFrame, touched: list[str], stamp: Column | None = None) -> DataFrame | None:
    """The merge result of a stored batch of one row a key, numbered in ``_new``, if none of its partitions is stored: every
    row is inserted and there is nothing to merge with, so the batch is not moved or stored again. Else None."""
    if any(v in change.state(table).parts for v in touched):
        return None
    first = _first_id(change, table, batch.agg(F.max("_new")).first()[0])
    numbered = batch.withColumn("id", F.lit(first) + F.col("_new"))
    return inserted_rows(numbered, change.read(table, touched), {}, stamp)


def load_parents(change: Transaction, entity: Entity, parsed: DataFrame, clock: Clock) -> tuple[DataFrame, list[str]]:
    """Upsert the parents of parsed records, fill their foreign keys, and replace the partitions they
    touch. Returns counts per region and the partitions."""
    column, period = _period(entity.partition_column)
    batch = typed(records.transform_parents(parsed, entity, clock.timestamp())).withColumn(column, period)
    links = FOREIGN_KEYS.get(entity.name, ())
    extra = {"id": "bigint", **{fk: "bigint" for fk, _, _ in links}}
    key = [*entity.natural_key, *([] if column in entity.natural_key else [column])]
    stamped = batch.withColumn("updated_at", clock.timestamp())
    kept = [c for c in ("finished_at", "scheduled_date") if c in batch.columns]
    _open(change, entity.name, stamped, column, extra, key=key, ranges=kept, finder=entity.id_column)
    batch = durable(batch.withColumn("_new", F.monotonically_increasing_id()))
    touched = touched_values(batch, column)
    fresh = _all_new(change, entity.name, batch, touched, clock.timestamp()) if touched else None
    batch = batch.drop("_new")
    merged = fresh
    if fresh is None:
        merged = upsert_parent(
            change.read(entity.name, touched), batch, entity.natural_key, partition_column=entity.partition_column,
            no_update=entity.no_update, stamp=clock.timestamp(),
        )
    for fk, table, on in links:
        if change.exists(table):
            merged = keys.fill_key(merged, change.read(table), on, fk)
    if fresh is None:
        merged = _number_new_rows(change, entity.name, merged)
    change.upsert(entity.name, merged, touched)
    if fresh is not None:
        merged = batch.withColumn("op", F.lit("insert"))
    counts = merged.where(F.col("op") != "keep").groupBy("region_code").agg(
        count_all().alias("records_processed"), F.count_if(F.col("op") == "insert").alias("records_new")
    )
    return counts, touched


def load_children(
    change: Transaction, entity: Entity, child: Child, rows: DataFrame, parents: DataFrame
) -> None:
    """Resolve the parent (and tag) keys of child rows, upsert them, replace the partitions they touch.
    Rows without a stored parent are dropped. ``parents`` has the stored parents' ids and, where they are stored by
    month, their ``parent_month``."""
    on = {"parent_api_id": entity.id_column, "region_code": "region_code"}
    column, period = _child_period(entity, child)
    month = [column] if column == "parent_month" else []
    batch = typed(keys.require_key(rows, parents, on, child.parent_fk, also=month).drop("parent_api_id"))
    if child.table == "task_tags":
        if not change.exists("tags"):
            return
        tag = {"tag_id": "tag_id", "region_code": "region_code"}
        batch = keys.require_key(batch, change.read("tags"), tag, "tag_pk").drop("tag_id")
    batch = batch.withColumn(column, period)
    order = [F.col("arrival").asc()]
    # The first of equal keys is chosen before the rows are stored; their partition is in the key.
    if child.natural_key:
        batch = first_per_key(batch, child_key(child.natural_key, child.partition_column), order)
    batch = durable(batch.withColumn("_new", F.monotonically_increasing_id()))
    key = [*child.natural_key, *([column] if child.natural_key and column not in child.natural_key else [])]
    _open(change, child.table, batch.drop("arrival", "_new"), column, {"id": "bigint"}, key=key)
    touched = touched_values(batch, column)
    if not touched:
        return
    merged = _all_new(change, child.table, batch, touched)
    if merged is None:
        merged = upsert_child(
            change.read(child.table, touched), batch.drop("_new"), child.natural_key, order, partition_column=child.partition_column
        )
        merged = _number_new_rows(change, child.table, merged)
    change.upsert(child.table, merged, touched)


def load_entity(
    store: SnapshotStore, name: str, pages: DataFrame, clock: Clock,
    child_pages: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Load landed pages of one entity for all regions at once and keep the run log.

    ``pages`` is (region_code, page, body), for tasks with the ``parent_id`` of their property;
    ``child_pages`` holds (region_code, parent_id, body) by child name. Returns the status rows.

    Parents, children and the outcome are one commit: after an exception all tables are as they were, and the
    runs are ``failed`` with its message. A load that meets another writer's change is done again.
    """
    started = pages.select("region_code").distinct().withColumn("entity_type", F.lit(name))

    def run(seen: Snapshot) -> None:
        with store.begin(seen) as change:
            close_runs(change, _load(change, ENTITIES[name], pages, clock, child_pages or {}, started), clock)

    with logged_runs(store, started, clock):
        store.attempt(run)
    return store.read("sync_status", [name])


def _load(
    change: Transaction, entity: Entity, pages: DataFrame, clock: Clock, child_pages: Mapping[str, DataFrame], started: DataFrame
) -> DataFrame:
    """Stage the load of one entity; the outcome of each region."""
    # A page that cannot be read holds its region back: its rows stay as they are and the last success too.
    # Pages of children without a parent id are skipped, whatever they hold.
    # Pages are checked and their records parsed in one pass; parents and every child list read the columns they need.
    of_known = change.read("properties") if entity.name == "tasks" and change.exists("properties") else None
    checked = durable(checked_pages(pages, record_schema(entity), of_known))
    first = F.col("reason").isNotNull() & F.coalesce(F.col("pos") == 0, F.lit(True))
    named = [p.where(F.col("parent_id") != "") for p in child_pages.values()]
    broken = reduce(DataFrame.unionByName, [unreadable_pages(p, "data") for p in named], checked.where(first).select("region_code", "reason"))
    failed = durable(broken.groupBy("region_code").agg(count_all().alias("pages"), F.min("reason").alias("reason")))
    parsed = checked.where(F.col("pos").isNotNull()).select("region_code", "page", "pos", "record")
    if not failed.isEmpty():
        child_pages = {k: p.join(failed, "region_code", "left_anti") for k, p in child_pages.items()}
        parsed = parsed.join(failed, "region_code", "left_anti")
    counts, touched = load_parents(change, entity, parsed, clock)
    wanted = [c for c in entity.children.values() if c.source or child_pages]
    if wanted:
        stored = change.read(entity.name, touched)
        month = [F.trunc(entity.partition_column, "month").alias("parent_month")] if entity.partition_column else []
        columns = dict.fromkeys(["id", entity.id_column, "region_code", *([entity.partition_column] if month else [])])
        parents = durable(stored.select(*columns, *month))
    for child_name, child in entity.children.items():
        if child.source:
            load_children(change, entity, child, records.explode_children(parsed, entity, child_name), parents)
        elif child_name in child_pages:
            elements = unwrap_child_pages(child_pages[child_name], child_schema(child))
            load_children(change, entity, child, records.map_child_pages(elements, parents, child), parents)
    results = started.join(counts, "region_code", "left").fillna(0, ["records_processed", "records_new"])
    message = F.concat(F.col("pages").cast("string"), F.lit(" unreadable pages: "), F.col("reason"))
    return results.join(failed, "region_code", "left").withColumns(
        {
            "error_message": F.when(F.col("pages").isNotNull(), message),
            "sync_status": F.when(F.col("pages").isNotNull(), "failed").otherwise("success"),
        }
    ).drop("pages", "reason")


@contextmanager
def logged_runs(store: SnapshotStore, started: DataFrame, clock: Clock):
    """Mark (region_code, entity_type) as running, in a commit of their own; after an exception inside, the runs
    that are still running here become ``failed`` with its message."""

    def open_runs(seen: Snapshot) -> None:
        with store.begin(seen) as change:
            _set_status(change, runlog.start_runs(_status(change, started), started, clock), started)

    started = durable(started)
    store.attempt(open_runs)
    try:
        yield
    except BaseException as e:
        text = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
        results = started.withColumns({"sync_status": F.lit("failed"), "error_message": F.lit(text[:500])})

        def fail(seen: Snapshot) -> None:
            with store.begin(seen) as change:
                close_runs(change, results, clock)

        store.attempt(fail)
        raise


def close_runs(change: Transaction, results: DataFrame, clock: Clock) -> None:
    """Stage the end of the runs of (region_code, entity_type, sync_status, error_message, counters): their status rows
    and a history row each."""
    results = durable(results)
    closed, history = runlog.finish_runs(_status(change, results), results, clock)
    closed, history = durable(closed), durable(history)
    _set_status(change, closed, results)
    change.append("sync_history", history.withColumn("started_day", F.to_date("sync_started_at")), "started_day")


def _entities(runs: DataFrame) -> list[str]:
    return touched_values(runs, "entity_type")


def _status(change: Transaction, runs: DataFrame) -> DataFrame:
    """The status rows of the entities of ``runs``."""
    return change.read("sync_status", _entities(runs)) if change.exists("sync_status") else _no_status(change.store)


def _set_status(change: Transaction, status: DataFrame, runs: DataFrame) -> None:
    """Replace the status rows of the entities of ``runs``; loads of other entities have theirs in other partitions."""
    if not change.exists("sync_status"):
        change.write("sync_status", _no_status(change.store), "entity_type")
    change.replace("sync_status", durable(status), _entities(runs))


def _no_status(store: SnapshotStore) -> DataFrame:
    schema = (
        "region_code string, entity_type string, sync_status string, sync_started_at timestamp,"
        " sync_completed_at timestamp, last_successful_sync_at timestamp, records_processed long,"
        " records_new long, api_calls_made long, error_message string"
    )
    return store.spark.createDataFrame([], schema)


def repair_keys(store: SnapshotStore, name: str) -> int:
    """Fill foreign keys of stored rows whose referenced row arrived later. Only partitions with such
    rows are rewritten; returns how many."""
    column, _ = _period(ENTITIES[name].partition_column)

    def run(seen: Snapshot) -> int:
        rewritten: set[str] = set()
        with store.begin(seen) as change:
            for fk, table, on in FOREIGN_KEYS.get(name, ()):
                ref = change.read(table)
                open_rows = change.read(name).where(F.col(fk).isNull()).select(column, *[c for c in on if c != column])
                touched = touched_values(keys.require_key(open_rows, ref, on, "_found"), column)
                if touched:
                    change.replace(name, durable(keys.fill_key(change.read(name, touched), ref, on, fk)), touched)
                    rewritten |= set(touched)
        return len(rewritten)

    return store.attempt(run)
