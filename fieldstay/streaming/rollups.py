"""Time-bucketed task roll-ups, refreshed by range."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldstay.functions.times import MICROS_PER_HOUR, Clock, avg_micros
from fieldstay.plans.common import count_all, finished, priority, stage, total_micros
from fieldstay.sources.snapshot import Snapshot, SnapshotStore

KEYS = ["bucket", "region_code", "type_department"]


def _metrics(detailed: bool) -> list[Column]:
    states = [
        F.count_if(stage("new")).alias("tasks_new"),
        F.count_if(stage("in_progress")).alias("tasks_in_progress"),
    ]
    return [
        count_all().alias("tasks_created"),
        F.count_if(finished()).alias("tasks_completed"),
        *(states if detailed else []),
        F.count_if(priority("urgent")).alias("urgent_tasks"),
        F.count_if(priority("high")).alias("high_tasks"),
        F.count_distinct("finished_by_id").alias("unique_workers"),
        avg_micros(F.when(finished(), total_micros()), MICROS_PER_HOUR).alias("avg_hours_to_complete"),
    ]


def task_rollup(tasks: DataFrame, unit: str = "day") -> DataFrame:
    """Task figures per ``day`` or ``month`` of creation, region and department."""
    bucket = F.date_trunc(unit, "created_at").alias("bucket")
    return tasks.groupBy(bucket, "region_code", "type_department").agg(*_metrics(unit == "day"))


def _moment(at: datetime) -> Column:
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def _created_in(tasks: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """Tasks created in [first, last); month-partitioned storage reads only those months."""
    rows = tasks.where((F.col("created_at") >= _moment(first)) & (F.col("created_at") < _moment(last)))
    if "created_month" in tasks.columns:
        rows = rows.where(F.col("created_month").between(F.lit(first.date().replace(day=1)), F.lit(last.date())))
    return rows


def bucket_start(at: datetime, unit: str) -> datetime:
    """Start of the bucket a moment lies in."""
    day = at.replace(hour=0, minute=0, second=0, microsecond=0)
    return day.replace(day=1) if unit == "month" else day


def bucket_range(start: datetime, end: datetime, unit: str) -> tuple[datetime, datetime]:
    """The whole buckets inside [start, end): first bucket start and end of the last bucket."""

    def floor(at: datetime) -> datetime:
        return bucket_start(at, unit)

    def following(at: datetime) -> datetime:
        return (at + timedelta(days=32)).replace(day=1) if unit == "month" else at + timedelta(days=1)

    first = floor(start) if floor(start) == start else following(floor(start))
    return first, max(first, floor(end))


def refresh_range(stored: DataFrame, tasks: DataFrame, start: datetime, end: datetime, unit: str = "day") -> DataFrame:
    """Stored roll-up with the buckets inside [start, end) recomputed; other buckets stay as stored.

    Only tasks created in that range are read.
    """
    first, last = bucket_range(start, end, unit)
    outside = (F.col("bucket") < _moment(first)) | (F.col("bucket") >= _moment(last))
    return stored.where(outside).unionByName(task_rollup(_created_in(tasks, first, last), unit))


def policy_range(clock: Clock, unit: str = "day") -> tuple[datetime, datetime]:
    """Regular refresh: three days (or months) back to one hour ago."""
    if unit == "day":
        return clock.now - timedelta(days=3), clock.now - timedelta(hours=1)
    month = clock.now.month - 3
    year = clock.now.year + (month - 1) // 12
    month = (month - 1) % 12 + 1
    last_day = (datetime(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
    return clock.now.replace(year=year, month=month, day=min(clock.now.day, last_day)), clock.now - timedelta(hours=1)


def real_time(stored: DataFrame, tasks: DataFrame, refreshed_to: datetime, unit: str = "day") -> DataFrame:
    """Stored buckets before the one a moment lies in and a fresh aggregate of everything from there on:
    a refresh stores whole buckets only, so that bucket is not stored."""
    edge = _moment(bucket_start(refreshed_to, unit))
    fresh = task_rollup(tasks.where(F.col("created_at") >= edge), unit)
    return stored.where(F.col("bucket") < edge).unionByName(fresh)


def write_refreshed(
    tasks: DataFrame, store: SnapshotStore, table: str, start: datetime, end: datetime, unit: str = "day"
) -> None:
    """Recompute the buckets inside [start, end) and replace just their partitions of the stored roll-up, in one commit;
    buckets of the range that have no tasks any more are gone."""
    first, last = bucket_range(start, end, unit)
    rollup = task_rollup(_created_in(tasks, first, last), unit).withColumn("bucket_day", F.col("bucket").cast("date"))
    days = [str((first + timedelta(days=n)).date()) for n in range((last - first).days)]

    def run(seen: Snapshot) -> None:
        with store.begin(seen) as change:
            if change.exists(table):
                change.replace(table, rollup, days)
            else:
                change.write(table, rollup, "bucket_day")

    store.attempt(run)


def refresh_changed(
    store: SnapshotStore, source: str, target: str, build: Callable[[DataFrame], DataFrame], column: str | None = None
) -> list[str]:
    """Bring the stored ``target``, an aggregate of the stored ``source``, up to date; returns the partitions computed.

    ``build`` makes target rows of source rows; each of its groups lies in one partition of the source, whose value it
    hands on in ``column`` (by default the source's partition column). Which folders a partition was computed from is noted
    with the target: only partitions whose folders have changed since then are read, and the others stay as they are.
    """

    def run(seen: Snapshot) -> list[str]:
        state = seen.state(source)
        by = column or state.column
        now = {value: [*part.folders, *part.changes] for value, part in state.parts.items()}
        done = seen.state(target).notes.get("source", {}) if seen.exists(target) else {}
        changed = sorted(v for v in now if done.get(v) != now[v])
        gone = [v for v in done if v not in now]
        if changed or gone or not seen.exists(target):
            rows = build(seen.read(source, changed))
            with store.begin(seen) as change:
                if change.exists(target):
                    change.replace(target, rows, [*changed, *gone])
                    change.note(target, source=now)
                else:
                    change.write(target, rows, by, {"source": now})
        return changed

    return store.attempt(run)


def streaming_rollup(tasks: DataFrame, unit: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """The roll-up over a stream of created tasks, exact in all columns.

    Tasks are first aggregated by bucket and worker, then by bucket: a bucket's distinct workers are its rows of the
    first step, so the state holds a row a worker and day and no lists. Both steps close a bucket by the same watermark.
    """
    place = ["region_code", "type_department"]
    counts = {
        "tasks_created": count_all(),
        "tasks_completed": F.count_if(finished()),
        "tasks_new": F.count_if(stage("new")),
        "tasks_in_progress": F.count_if(stage("in_progress")),
        "urgent_tasks": F.count_if(priority("urgent")),
        "high_tasks": F.count_if(priority("high")),
    }
    took = F.when(finished(), total_micros())
    by_worker = (
        tasks.withWatermark("created_at", lateness)
        .groupBy(F.window("created_at", unit), *place, "finished_by_id")
        .agg(*[c.alias(n) for n, c in counts.items()], F.sum(took).alias("_micros"), F.count(took).alias("_timed"))
    )
    return (
        by_worker.groupBy(F.window(F.window_time("window"), unit), *place)
        .agg(
            *[F.sum(n).alias(n) for n in counts],
            F.count("finished_by_id").alias("unique_workers"),
            (F.sum("_micros").cast("double") / F.sum("_timed") / MICROS_PER_HOUR).alias("avg_hours_to_complete"),
        )
        .select(F.col("window.start").alias("bucket"), "*")
        .drop("window")
    )


def start_rollup_stream(tasks: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append closed buckets of a task stream to a folder."""
    return (
        streaming_rollup(tasks)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
