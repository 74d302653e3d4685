"""Change events: normalisation, logging, and application to the stored tables.

Events are applied in arrival order (``received_at``, then ``event_id``), not event time. An update
sets only the fields it carries; a delete removes the row, and later updates of it find nothing.
Since nothing re-creates a row, a key's events can be reduced to one final state per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldstay.functions.parsing import lenient_timestamp, non_empty
from fieldstay.functions.times import Clock
from fieldstay.operators.export import latest_property_status
from fieldstay.operators.links import SUB_STATUS, count_blocking
from fieldstay.operators.maintenance import delete_matching
from fieldstay.operators.merge import merge
from fieldstay.session import discard, durable
from fieldstay.sources.snapshot import ConflictError, Snapshot, SnapshotStore, Transaction, touched_values

EVENT_SCHEMA = "event_id long, received_at timestamp, payload string"
TEST_EVENT = "test_webhook_event"  # fixed value
ORDER = ["received_at", "event_id"]


# The parts of a payload that are read; objects under a text field arrive as their JSON text.
_STATE = "id string, company_id string, status string, started_at string, finished_at string"
PAYLOAD_SCHEMA = (
    f"{_STATE}, task struct<{_STATE}>, event string, event_type string, task_id string, property_id string,"
    " external_property_id string, sub_statuses string"
)
DOC = "_doc"


def _parsed(events: DataFrame) -> DataFrame:
    """Events with their payload parsed once."""
    return events.withColumn(DOC, F.from_json("payload", PAYLOAD_SCHEMA))


def _get(path: str) -> Column:
    return F.col(f"{DOC}.{path}")


def _first(*paths: str) -> Column:
    return F.coalesce(*[_get(p) for p in paths])


def _scalar_status(path: str) -> Column:
    """Status text; of a status object its code, or else its name."""
    raw = _get(path)
    as_object = F.coalesce(non_empty(F.get_json_object(raw, "$.code")), F.get_json_object(raw, "$.name"))
    return F.when(F.ltrim(raw).startswith("{"), as_object).otherwise(raw)


def drop_test_events(events: DataFrame) -> DataFrame:
    return events.where(F.coalesce(F.get_json_object("payload", "$.event"), F.lit("")) != TEST_EVENT)


def normalise_task_events(events: DataFrame) -> DataFrame:
    """Task events as columns, whether the task is a sub-object or the payload itself."""
    nested = _get("task").isNotNull()

    def of_task(name: str) -> Column:
        return F.when(nested, _get(f"task.{name}")).otherwise(_get(name))

    task_id = F.when(nested, _first("task.id", "task_id", "id")).otherwise(_first("task_id", "id"))
    company = F.coalesce(non_empty(_get("task.company_id")), _get("company_id"))
    status = F.when(nested, _scalar_status("task.status")).otherwise(_scalar_status("status"))
    return _parsed(events).select(
        *[c for c in events.columns if c != "payload"],
        F.coalesce(task_id, F.lit("")).alias("task_id"),
        F.nullif(company.try_cast("bigint"), F.lit(0)).alias("company_id"),
        F.coalesce(_first("event_type", "event"), F.lit("task_updated")).alias("action"),
        non_empty(status).alias("status"),
        lenient_timestamp(non_empty(of_task("started_at"))).alias("started_at"),
        lenient_timestamp(non_empty(of_task("finished_at"))).alias("finished_at"),
        "payload",
    )


def normalise_property_events(events: DataFrame) -> DataFrame:
    """Property-status events as columns with blocking counts."""
    statuses = _get("sub_statuses")
    blocking = count_blocking(F.from_json(statuses, SUB_STATUS))
    return _parsed(events).select(
        *[c for c in events.columns if c != "payload"],
        F.coalesce(_first("property_id", "id"), F.lit("")).alias("property_id"),
        F.nullif(_get("company_id").try_cast("bigint"), F.lit(0)).alias("company_id"),
        F.coalesce(_first("event_type", "event"), F.lit("property_status_changed")).alias("action"),
        non_empty(_get("status")).alias("status"),
        _get("external_property_id").alias("external_property_id"),
        blocking.alias("blocking_count"),
        (blocking > 0).alias("is_blocking"),
        statuses.alias("sub_statuses"),
        "payload",
    )


def is_delete(action: Column) -> Column:
    return F.lower(action).contains("delet")


def resolve_region(events: DataFrame, companies: DataFrame, properties: DataFrame | None = None) -> DataFrame:
    """Add ``region_code``: from the company, else from the stored property, else ``unknown``.

    ``companies`` is (company_id, region_code), one row per tenant region.
    """
    by_company = companies.select("company_id", F.col("region_code").alias("_by_company"))
    out = events.join(by_company, "company_id", "left")
    candidates = [F.col("_by_company")]
    if properties is not None:
        by_property = properties.groupBy("property_id").agg(F.min("region_code").alias("_by_property"))
        out = out.join(by_property, "property_id", "left")
        candidates.append(F.col("_by_property"))
    out = out.withColumn("region_code", F.coalesce(*candidates, F.lit("unknown")))
    return out.drop("_by_company", "_by_property")


def last_values(events: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per key the last non-empty value of each field, in arrival order.

    The running maximum of (order, value) combines on the map side, so a key with very many events
    sends one row per input partition.
    """
    latest = [
        F.max(F.when(F.col(f).isNotNull(), F.struct(*ORDER, F.col(f).alias("v"))))["v"].alias(f) for f in fields
    ]
    return events.groupBy(*keys).agg(*latest, F.max("received_at").alias("last_event_at"))


def apply_task_updates(tasks: DataFrame, events: DataFrame, clock: Clock) -> DataFrame:
    """Set status, start and finish of existing tasks from their events; unknown regions are skipped.

    ``tasks`` is the table, ``events`` normalised task events with a region.
    """
    return _updated_tasks(tasks, events, clock).drop("op")


def _updated_tasks(tasks: DataFrame, events: DataFrame, clock: Clock) -> DataFrame:
    """The rows of ``tasks`` after the updates, with their ``op``."""
    fields = ["task_status", "started_at", "finished_at"]
    known = events.where(
        ~is_delete(F.col("action")) & (F.col("region_code") != "unknown") & (F.col("task_id") != "")
    ).withColumnRenamed("status", "task_status")
    final = last_values(known, ["task_id", "region_code"], fields).withColumn("synced_at", clock.timestamp())
    keep_old = {f: F.coalesce(f"s.{f}", f"t.{f}") for f in fields}
    return merge(
        tasks, final.drop("last_event_at"), ["task_id", "region_code"], insert=False, values=keep_old,
        stamp=clock.timestamp(),
    )


def apply_task_deletes(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """Remove tasks with a delete event: by id and region, or by id alone if the region is unknown."""
    doomed = events.where(is_delete(F.col("action")) & (F.col("task_id") != ""))
    anywhere = doomed.where(F.col("region_code") == "unknown")
    remaining = delete_matching(tasks, doomed.where(F.col("region_code") != "unknown"), ["task_id", "region_code"])
    return delete_matching(remaining, anywhere, ["task_id"])


def apply_task_events(tasks: DataFrame, events: DataFrame, clock: Clock) -> DataFrame:
    """Final task table after a batch: deletes win, as nothing brings a deleted row back.

    ``events`` is read by several joins: hand in stored rows rather than a raw parse.
    """
    return apply_task_updates(apply_task_deletes(tasks, events), events, clock)


def apply_property_events(properties: DataFrame, events: DataFrame, clock: Clock) -> DataFrame:
    """Set the status of existing properties from their events; events without a status are skipped."""
    return _updated_properties(properties, events, clock).drop("op")


def _updated_properties(properties: DataFrame, events: DataFrame, clock: Clock) -> DataFrame:
    known = events.where(
        (F.col("property_id") != "") & (F.col("region_code") != "unknown") & F.col("status").isNotNull()
    )
    final = last_values(
        known.withColumnRenamed("status", "property_status"), ["property_id", "region_code"], ["property_status"]
    ).withColumn("synced_at", clock.timestamp())
    return merge(
        properties, final.drop("last_event_at"), ["property_id", "region_code"], insert=False,
        stamp=clock.timestamp(),
    )


def event_log(events: DataFrame, kind: str, id_column: str, carry: Sequence[str] = ()) -> DataFrame:
    """Log rows of normalised events; ``carry`` names columns to keep beside them."""
    return events.select(
        "event_id",
        F.lit(kind).alias("event_kind"),
        F.when(F.col("company_id").isNotNull(), F.col("region_code")).alias("region_code"),
        "company_id",
        "payload",
        F.col(id_column).alias("entity_id"),
        F.col("action").alias("event_action"),
        "received_at",
        *carry,
    )


def mark_processed(log: DataFrame, clock: Clock, error: Column | None = None) -> DataFrame:
    """Log rows with the processed flag and, for events that could not be read, the reason."""
    return log.withColumns(
        {
            "processed": F.lit(True),
            "processed_at": clock.timestamp(),
            "error_message": F.lit(None).cast("string") if error is None else error,
        }
    )


def recent_events(log: DataFrame, limit: int = 50) -> DataFrame:
    """The newest events (a top-k report)."""
    return log.orderBy(F.col("received_at").desc(), F.col("event_id").desc()).limit(limit)


def unreadable() -> Column:
    """Reason why an event's payload cannot be applied, NULL if it can."""
    return F.when(F.try_parse_json("payload").isNull(), F.lit("payload is not JSON"))


ERROR = "_error"


def _staged(resolved: DataFrame) -> DataFrame:
    """A batch's events, parsed and stored once, with the reason why one cannot be applied; log and tables read it."""
    return durable(resolved.withColumn(ERROR, unreadable()))


def _log(staged: DataFrame, kind: str, id_column: str, clock: Clock) -> DataFrame:
    return mark_processed(event_log(staged, kind, id_column, (ERROR,)), clock, F.col(ERROR)).drop(ERROR)


def read_event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed event files (JSON lines)."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def _now(clock: Clock | Callable[[], Clock]) -> Clock:
    """The clock of a batch: a stream that runs on is given a function, so that each batch's times are its own."""
    return clock() if callable(clock) else clock


def start_task_stream(
    stream: DataFrame, store: SnapshotStore, companies: DataFrame, clock: Clock | Callable[[], Clock], checkpoint: str,
    available_now: bool = True, column: str = "created_month",
) -> StreamingQuery:
    """Log and apply task events batch by batch to ``tasks`` in the store.

    The table is stored by a period of creation. A table with a key and a finder is asked which periods may have the
    batch's tasks, and only the changed rows are written, beside their periods; :meth:`SnapshotStore.compact` merges
    them when there are many. Of a table without them the periods hit are found by their ids and rewritten. The log
    and the tasks are one commit that bears the batch's number: a batch that is run again after a failure
    leaves the same result.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        now = _now(clock)
        staged = _staged(resolve_region(normalise_task_events(drop_test_events(batch)), companies))
        log = _log(staged, "task", "task_id", now)
        used = ["task_id", "region_code", "action", "status", "started_at", "finished_at", *ORDER]
        events = staged.where(F.col(ERROR).isNull()).select(*used)

        def run(seen: Snapshot) -> None:
            with store.begin(seen) as change:
                if write_log(change, log, (_source(store, checkpoint), batch_id)):
                    _update_tasks(change, events, now, column)

        store.attempt(run)
        _compact(store, "tasks")
        discard(staged)

    return _start(stream, on_batch, checkpoint, available_now)


def _update_tasks(change: Transaction, events: DataFrame, clock: Clock, column: str) -> None:
    named = events.select("task_id").distinct()
    state = change.state("tasks")
    if not (state.key and state.finder == "task_id"):
        known = change.read("tasks").select("task_id", column)
        periods = touched_values(known.join(named, "task_id", "left_semi"), column)
        if periods:
            change.replace("tasks", apply_task_events(change.read("tasks", periods), events, clock), periods)
        return
    hit = durable(change.read("tasks", change.find("tasks", named)).join(named, "task_id", "left_semi"))
    left = apply_task_deletes(hit, events)
    gone = hit.join(left.select(*state.key), list(state.key), "left_anti").withColumn("_deleted", F.lit(True))
    after = _updated_tasks(left, events, clock).where(F.col("op") == "update").drop("op").withColumn("_deleted", F.lit(False))
    change.change("tasks", after.unionByName(gone), F.col("_deleted"), inserts=False)


def start_property_stream(
    stream: DataFrame, store: SnapshotStore, companies: DataFrame, properties: DataFrame, clock: Clock | Callable[[], Clock],
    checkpoint: str, available_now: bool = True,
) -> StreamingQuery:
    """Log property-status events, apply them to ``properties`` of the store (by region) if it is
    there, and keep each property's newest event in ``property_status``.

    ``properties`` finds the region of events without a company. An event that was received before
    the stored one does not replace it, in whatever batch it comes. The status table is stored in
    slots by property, of which a batch rewrites those it hit.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        now = _now(clock)
        normal = normalise_property_events(drop_test_events(batch))
        staged = _staged(resolve_region(normal, companies, properties))
        log = _log(staged, "property-status", "property_id", now)
        events = staged.where(F.col(ERROR).isNull()).drop(ERROR)

        def run(seen: Snapshot) -> None:
            with store.begin(seen) as change:
                if write_log(change, log, (_source(store, checkpoint), batch_id)):
                    _update_mirror(change, events, now)
                    _update_status(change, events)

        store.attempt(run)
        _compact(store, "properties")
        discard(staged)

    return _start(stream, on_batch, checkpoint, available_now)


def _update_mirror(change: Transaction, events: DataFrame, clock: Clock) -> None:
    if not change.exists("properties"):
        return
    regions = touched_values(events.where(F.col("region_code") != "unknown"), "region_code")
    if not regions:
        return
    mirror, key = change.read("properties", regions), change.state("properties").key
    if not key:
        change.replace("properties", apply_property_events(mirror, events, clock), regions)
        return
    named = events.select("property_id", "region_code").distinct()
    hit = mirror.join(named, ["property_id", "region_code"], "left_semi")
    change.change("properties", _updated_properties(hit, events, clock).where(F.col("op") == "update").drop("op"), inserts=False)


def _update_status(change: Transaction, events: DataFrame) -> None:
    # As many slots as there were shuffle partitions when the table was made.
    there = change.exists("property_status")
    slots_now = int(change.store.spark.conf.get("spark.sql.shuffle.partitions"))
    count = change.state("property_status").notes.get("slots", slots_now) if there else slots_now
    slot = F.pmod(F.xxhash64("property_id"), F.lit(count))
    newest = durable(latest_property_status(events).withColumn("slot", slot))
    if not there:
        change.write("property_status", newest, "slot", {"slots": count})
        discard(newest)
        return
    slots = touched_values(newest, "slot")
    if not slots:
        discard(newest)
        return
    table = change.read("property_status", slots)
    newer = F.struct(*[F.col(f"s.{c}") for c in ORDER]) > F.struct(*[F.col(f"t.{c}") for c in ORDER])
    values = {c: F.when(newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in table.columns}
    merged = merge(table, newest, ["region_code", "property_id"], values=values)
    change.replace("property_status", merged.drop("op"), slots)
    discard(newest)


def write_log(change: Transaction, log: DataFrame, batch: tuple[str, int]) -> bool:
    """Add the log rows of one batch, (stream, number), to ``event_log``, stored by day of receipt; False if they are
    there already."""
    rows = log.withColumn("received_day", F.to_date("received_at"))
    return change.append("event_log", rows, "received_day", batch, key=("event_kind", "event_id", "received_day"))


def _source(store: SnapshotStore, checkpoint: str) -> str:
    """The id of the stream with a checkpoint: batches of a stream that starts anew count anew."""
    return store._get(f"{checkpoint}/metadata")["id"]


# A partition's changes, and a day's batches of log rows, are merged when there are more than these.
MOST_CHANGES, MOST_BATCHES = 8, 32


def _compact(store: SnapshotStore, table: str) -> None:
    """Merge what many small batches have left; another writer's change goes first, the next batch tries again."""
    for name, most in ((table, MOST_CHANGES), ("event_log", MOST_BATCHES)):
        if store.exists(name):
            try:
                store.compact(name, most)
            except ConflictError:
                pass


def _start(stream: DataFrame, on_batch, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
