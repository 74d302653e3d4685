"""Whole runs on stored tables: reconcile deletes and states, load links, push changes, retention and cascades."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators import export, keys, maintenance, merge, reconcile
from fieldstay.operators.links import LINK_KEY, link_records, link_rows
from fieldstay.operators.load import close_runs, logged_runs
from fieldstay.operators.ranking import first_per_key, join_on
from fieldstay.plans.common import count_all
from fieldstay.session import durable
from fieldstay.sources.snapshot import Snapshot, SnapshotStore, touched_values

MARKS = "table_name string, region_code string, last_pushed_at timestamp, rows_pushed long"
LINKS = "reservation_tasks"
LINK_FKS = ("reservation_pk", "task_pk")
FEW = 16
CHUNK = 500


def reconcile_stored_tasks(
    store: SnapshotStore, listed: DataFrame, good_parents: DataFrame, probes: DataFrame, clock: Clock, column: str,
    past_days: int = 14, future_days: int = 30, dry_run: bool = False,
) -> DataFrame:
    """Delete reconciliation of the stored ``tasks``: only partitions (of ``column``) with a row to change are rewritten,
    and removed rows go to ``task_delete_audit`` in the same commit, so that none is gone without a trace. Of a table that
    keeps the range of ``scheduled_date`` only the partitions that meet the window are read. Returns the counts per
    region and action of the rows read."""
    window = (str(clock.now.date() - timedelta(days=past_days)), str(clock.now.date() + timedelta(days=future_days)))

    def run(seen: Snapshot) -> DataFrame:
        tasks = seen.read("tasks", scheduled_date=window)
        found = reconcile.reconcile_deletes(tasks, listed, good_parents, probes, clock, past_days, future_days, dry_run)
        touched = [] if dry_run else touched_values(found.changed, column)
        if touched:
            with store.begin(seen) as change:
                change.replace("tasks", _of(found.table, column, touched), touched)
                audit = found.audit.withColumn("deleted_day", F.to_date("deleted_at"))
                change.append("task_delete_audit", audit, "deleted_day")
        return found.counts

    return store.attempt(run)


def _of(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows of some partition values."""
    return df.where(F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).isin(list(values)))


def reconcile_stored_properties(
    store: SnapshotStore, listed: DataFrame, complete: DataFrame, clock: Clock, dry_run: bool = False
) -> DataFrame:
    """Lifecycle reconciliation of the stored ``properties`` (by region): regions with a change are rewritten. Returns the
    counts per region."""

    def run(seen: Snapshot) -> DataFrame:
        decided = durable(reconcile.decide_lifecycle(seen.read("properties"), listed, complete))
        table, counts = reconcile.apply_lifecycle(decided, clock)
        touched = [] if dry_run else touched_values(decided.where(reconcile.lifecycle_change()), "region_code")
        if touched:
            store.replace("properties", _of(table, "region_code", touched), touched, based_on=seen)
        return counts

    return store.attempt(run)


def load_links(store: SnapshotStore, records: DataFrame, clock: Clock, fetches: DataFrame | None = None) -> DataFrame:
    """Link rows from (region_code, reservation_id, record) into the stored ``reservation_tasks`` (by region), with the
    keys of the stored reservations and tasks. Returns inserted and updated rows per region.

    ``fetches`` is (region_code, reservation_id, failed) of every request made. The run log gets a row per region:
    ``success``, or ``partial`` where some of its fetches failed; what was fetched is stored either way. After
    an exception the runs are ``failed`` and no table has changed.
    """
    regions = records.select("region_code")
    if fetches is not None:
        regions = regions.unionByName(fetches.select("region_code"))
    started = regions.distinct().withColumn("entity_type", F.lit(LINKS))

    def run(seen: Snapshot) -> DataFrame:
        with store.begin(seen) as change:
            # Records wait as text. What becomes of a link and its keys is found on the key columns alone; the text
            # is moved to meet its outcome and read into columns where it is stored.
            staged = durable(link_records(records), compression="zstd")
            blank = F.lit(None).cast("bigint")
            if not change.exists(LINKS):
                shape = link_rows(staged, clock.timestamp()).where(F.lit(False)).withColumns({fk: blank for fk in LINK_FKS})
                change.write(LINKS, shape, "region_code")
            touched = touched_values(staged, "region_code")
            old = change.read(LINKS, touched)
            known = old.select(*LINK_KEY, *LINK_FKS, *[F.col(fk).alias(f"_was_{fk}") for fk in LINK_FKS], blank.alias("_copies"))
            merged = merge.upsert_links(known, staged.groupBy(*LINK_KEY).agg(count_all().alias("_copies")))
            here = {"region_code": "region_code"}
            for table, key, fk in (("reservations", "reservation_id", "reservation_pk"), ("tasks", "task_id", "task_pk")):
                if change.exists(table):
                    merged = keys.overwrite_key(merged, change.read(table), {key: key, **here}, fk)
            merged = durable(merged)
            if touched:
                rows = _merged_links(staged, old, merged, clock, len(touched))
                change.upsert(LINKS, rows, touched, arranged=True)
            written = merged.where(F.col("op") != "keep").groupBy("region_code").agg(
                F.count_if(F.col("op") == "insert").alias("inserted"), F.count_if(F.col("op") == "update").alias("updated")
            )
            close_runs(change, _link_outcomes(started, written, fetches), clock)
            return written

    with logged_runs(store, started, clock):
        return store.attempt(run)


def _merged_links(staged: DataFrame, old: DataFrame, merged: DataFrame, clock: Clock, regions: int) -> DataFrame:
    """The link rows of what was decided in ``merged`` (key, foreign keys before and after, op): changed ones from
    the staged records, the others as they are stored. Of more than ``FEW`` regions the rows are brought together by region;
    of fewer each task writes a file for each."""

    def placed(df: DataFrame) -> DataFrame:
        return df.hint("rebalance", F.col("region_code")) if regions > FEW else df

    changed, kept = merged.where(F.col("op") != "keep"), merged.where(F.col("op") == "keep")
    doubled = durable(changed.where(F.col("_copies") > 1).select(*LINK_KEY).distinct())
    if not doubled.isEmpty():
        parsed = link_rows(join_on(staged, doubled, LINK_KEY, "left_semi"), clock.timestamp())
        greatest = first_per_key(parsed, LINK_KEY, [F.col(c).desc_nulls_last() for c in parsed.columns if c not in LINK_KEY])
        single = join_on(staged, doubled, LINK_KEY, "left_anti")
        staged = single.unionByName(greatest.select(*LINK_KEY, F.col("raw_payload").alias("record")))
    texts = join_on(staged, changed.select(*LINK_KEY, *LINK_FKS, "op"), LINK_KEY, "inner")
    rows = link_rows(placed(texts), clock.timestamp(), (*LINK_FKS, "op"))
    if kept.isEmpty():
        return rows
    # Rows with a NULL in their key may be there several times: they are told apart by the keys they had.
    was = [f"_was_{fk}" for fk in LINK_FKS]
    after = kept.select(*LINK_KEY, *was, *[F.col(fk).alias(f"_new_{fk}") for fk in LINK_FKS]).distinct()
    stored = join_on(old.withColumnsRenamed(dict(zip(LINK_FKS, was))), after, [*LINK_KEY, *was], "inner")
    stored = stored.withColumnsRenamed({f"_new_{fk}": fk for fk in LINK_FKS}).withColumn("op", F.lit("keep")).drop(*was)
    return rows.unionByName(placed(stored))


def _link_outcomes(started: DataFrame, written: DataFrame, fetches: DataFrame | None) -> DataFrame:
    if fetches is None:
        fetches = started.select("region_code", F.lit(False).alias("failed")).where(F.lit(False))
    calls = fetches.groupBy("region_code").agg(count_all().alias("api_calls_made"), F.count_if("failed").alias("_failed"))
    rows = started.join(written, "region_code", "left").join(calls, "region_code", "left").fillna(
        0, ["inserted", "updated", "api_calls_made", "_failed"]
    )
    bad = F.col("_failed") > 0
    return rows.select(
        "region_code", "entity_type",
        F.when(bad, "partial").otherwise("success").alias("sync_status"),
        F.when(bad, F.concat(F.col("_failed").cast("string"), F.lit(" reservation fetch failures"))).alias("error_message"),
        (F.col("inserted") + F.col("updated")).alias("records_processed"),
        F.col("inserted").alias("records_new"),
        "api_calls_made",
    )


def send_chunks(rows: DataFrame, send: Callable[[str, list[str]], None], size: int = CHUNK) -> DataFrame:
    """Send ``(region_code, payload)`` rows, at most ``size`` of one region at a time, from the tasks that hold them.

    ``send`` is given a region and its payloads; a chunk it raises for counts as failed and the others go on. It has to
    bear being called again with the same payloads, as a lost task is run again. Returns the stored report,
    a row for each chunk: ``(region_code, sent, failed, error)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions, payloads = batch.column("region_code").to_pylist(), batch.column("payload").to_pylist()
            starts = [i for i, r in enumerate(regions) if i == 0 or r != regions[i - 1]]
            for start, end in zip(starts, [*starts[1:], len(regions)]):
                for at in range(start, end, size):
                    some = payloads[at : min(at + size, end)]
                    error = None
                    try:
                        send(regions[at], some)
                    except Exception as e:  # noqa: BLE001 - the chunk's outcome, reported below
                        error = f"{type(e).__name__}: {e}"
                    sent = 0 if error else len(some)
                    yield pa.RecordBatch.from_pydict({
                        "region_code": pa.array([regions[at]], pa.string()), "sent": pa.array([sent], pa.int64()),
                        "failed": pa.array([len(some) - sent], pa.int64()), "error": pa.array([error], pa.string()),
                    })

    arranged = rows.select("region_code", "payload").sortWithinPartitions("region_code")
    return durable(arranged.mapInArrow(run, "region_code string, sent long, failed long, error string"))


def push_changes(
    store: SnapshotStore, source: str, target: str, shape: Callable[[DataFrame, DataFrame], DataFrame],
    sink: Callable[[DataFrame], DataFrame | None],
) -> DataFrame:
    """Send rows of a stored table synced after their region's mark for ``target`` and then move the marks, kept in
    the stored table ``push_marks``. ``shape`` makes target rows of (table, marks); ``sink`` sends them and may return a
    report with ``(region_code, failed)`` counts, as :func:`send_chunks` does. A region with failures keeps its mark,
    so the next push sends its rows again; the others move. If ``sink`` raises no mark moves. Returns the marks."""
    seen = store.snapshot()
    known = seen.read("push_marks", [target]) if seen.exists("push_marks") else store.spark.createDataFrame([], MARKS)
    marks = durable(known)
    # Rows that are stored while the push is at work come after its marks.
    table = seen.read(source)
    report = sink(shape(table, marks))
    failed = None if report is None else report.where(F.col("failed") > 0)
    after = durable(export.advance_watermarks(marks, export.changed_since(table, marks, target), target, failed))
    with store.begin(seen) as change:
        if not change.exists("push_marks"):
            change.write("push_marks", after.where(F.lit(False)), "table_name")
        change.replace("push_marks", after, [target])
    return store.read("push_marks")


def cascade_stored(
    store: SnapshotStore, parent: str, doomed: DataFrame, children: Mapping[str, str], soft: Mapping[str, str]
) -> dict[str, int]:
    """Delete the stored parents with an id in ``doomed(id)``, their rows in ``children`` (table to key column), and
    the references in ``soft`` tables, in one commit. Partitions without such a row are not rewritten; returns how many
    partitions of each table were."""
    doomed = durable(doomed.select("id").distinct())

    def run(seen: Snapshot) -> dict[str, int]:
        counts = {}
        with store.begin(seen) as change:
            for table, fk in {parent: "id", **children, **soft}.items():
                column = seen.state(table).column
                whole = [] if column else [""]
                hit = seen.read(table).select(*dict.fromkeys([fk, *([column] if column else [])]))
                hit = hit.join(doomed.select(F.col("id").alias(fk)), fk, "left_semi")
                touched = touched_values(hit, column) if column else (whole if hit.take(1) else [])
                counts[table] = len(touched)
                if not touched:
                    continue
                rows = seen.read(table, touched)
                kind = ({}, {table: (rows, fk)}) if table in soft else ({table: (rows, fk)}, {})
                change.replace(table, maintenance.cascade_delete(doomed, *kind)[table], touched)
        return counts

    return store.attempt(run)


def retain_stored_events(store: SnapshotStore, clock: Clock, days: int = 90) -> DataFrame:
    """Drop processed events older than ``days`` from the stored ``event_log`` (by day of receipt). A day that has nothing
    to keep is let go of by its pointer; of others the dropped rows are marked beside it. No kept row is written again.
    Returns the report of :func:`maintenance.retention_report` over the days looked at."""
    cutoff = str((clock.now - timedelta(days=days)).date())

    def run(seen: Snapshot) -> DataFrame:
        old = seen.chosen("event_log", between=("", cutoff))
        rows = seen.read("event_log", old)
        report = durable(maintenance.retention_report(rows, clock, days))
        kept = F.coalesce(maintenance.event_kept(clock, days), F.lit(True))
        staying = touched_values(rows.where(kept), "received_day")
        with store.begin(seen) as change:
            change.drop("event_log", [v for v in old if v not in staying])
            doomed = durable(_of(rows.where(~kept), "received_day", staying))
            if staying and doomed.take(1):
                change.change("event_log", doomed, F.lit(True))
        return report

    return store.attempt(run)


def retain_stored_history(store: SnapshotStore, clock: Clock, table: str = "sync_history", days: int = 365) -> list[str]:
    """Let go of the days of a stored history (by day) before those of :func:`maintenance.retain_history`; no row is read or
    written. Returns the days."""
    first = str((clock.now - timedelta(days=days)).date())
    old = [v for v in store.snapshot().state(table).parts if v < first]
    if old:
        store.drop(table, old)
    return old


def tier_stored(store: SnapshotStore, table: str, clock: Clock, column: str = "created_at", days: int = 90) -> list[str]:
    """Move the months of a table stored by month that ended ``days`` ago or earlier to the cold tier; returns them."""
    before = (clock.now - timedelta(days=days)).date().replace(day=1)
    return store.tier(table, str(before), lambda rows: maintenance.tier_layout(rows, column))
