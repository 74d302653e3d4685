"""Expressions shared by the dashboard views.

A view is a function ``(tables, clock, **options) -> DataFrame``: ``tables`` maps table names to
DataFrames, ``clock`` stands for the wall clock. Nothing here is ordered; the registry knows each
view's presentation order.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import rounded
from fieldstay.functions.times import (
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    Clock,
    avg_micros,
    micros_between,
)

# After every date or time in text order.
LAST = "9999-12-31 23:59:59.999999"

DEPARTMENTS = ("housekeeping", "inspection", "maintenance")

# Display order of priorities.
PRIORITY_ORDER = {"urgent": 1, "high": 2, "normal": 3, "watch": 4, "low": 5}

# Hours within which a task of each priority is due.
SLA_HOURS = {"urgent": 4, "high": 24, "normal": 72, "low": 168, "watch": 336}


def case(column: str, mapping: dict[str, int], default: int | None = None) -> Column:
    c = F.col(column)
    out = reduce(
        lambda acc, kv: acc.when(c == kv[0], kv[1]),
        mapping.items(),
        F.when(F.lit(False), F.lit(None).cast("int")),
    )
    return out.otherwise(default)


def stage(name: str) -> Column:
    return F.col("task_status_stage") == name


def finished() -> Column:
    return stage("finished")


def is_open() -> Column:
    return F.col("task_status_stage").isin("new", "in_progress")


def pressing() -> Column:
    return F.col("type_priority").isin("urgent", "high")


def department(name: str) -> Column:
    return F.col("type_department") == name


def priority(name: str) -> Column:
    return F.col("type_priority") == name


def count_all() -> Column:
    return F.count(F.lit(1))


def created_since(tasks: DataFrame, clock: Clock, days: int = 0, months: int = 0) -> DataFrame:
    """Tasks created from midnight ``days`` (or calendar ``months``) back. On storage partitioned by
    ``created_month`` only the months in question are read."""
    cutoff = clock.months_ago(months) if months else clock.days_ago(days)
    kept = tasks.where(F.col("created_at") >= cutoff)
    if "created_month" in tasks.columns:
        kept = kept.where(F.col("created_month") >= F.trunc(cutoff, "month"))
    return kept


def within(tables: Mapping[str, DataFrame], name: str, **ranges: tuple[str, str]) -> DataFrame:
    """A table of which only rows with a column inside (low, high), as ISO text, will be used: where the mapping knows the
    columns' ranges, as :class:`fieldstay.sources.stored.StoredTables` does, it opens only the folders that meet them.
    The rows are not filtered here."""
    pruned = getattr(tables, "within", None)
    return pruned(name, **ranges) if pruned else tables[name]


def finished_since(tables: Mapping[str, DataFrame], clock: Clock, days: int) -> DataFrame:
    """Tasks finished from midnight ``days`` back."""
    tasks = within(tables, "tasks", finished_at=(str(clock.today - timedelta(days=days)), LAST))
    return tasks.where(F.col("finished_at") >= clock.days_ago(days))


def total_micros() -> Column:
    return micros_between("created_at", "finished_at")


def active_micros() -> Column:
    return micros_between("started_at", "finished_at")


def start_micros() -> Column:
    return micros_between("created_at", "started_at")


def avg_hours(micros: Column, where: Column | None = None) -> Column:
    return avg_micros(micros if where is None else F.when(where, micros), MICROS_PER_HOUR)


def avg_minutes(micros: Column, where: Column | None = None) -> Column:
    return avg_micros(micros if where is None else F.when(where, micros), MICROS_PER_MINUTE)


def avg_hours_to_complete() -> Column:
    """Mean hours from creation to finish of finished tasks, to one decimal."""
    return rounded(avg_hours(total_micros(), finished()), 1)


def age_days(clock: Clock) -> Column:
    return F.date_diff(clock.date(), F.col("created_at").cast("date"))


def age_buckets(clock: Clock, names: tuple[str, ...]) -> list[Column]:
    """Open-task counts by age: 0-1, 2-3, 4-7, 8-14, 15-30 and over 30 days."""
    edges = [(None, 1), (2, 3), (4, 7), (8, 14), (15, 30), (31, None)]
    age, out = age_days(clock), []
    for name, (lo, hi) in zip(names, edges, strict=True):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (age >= lo)
        if hi is not None:
            cond = cond & (age <= hi)
        out.append(F.count_if(cond).alias(name))
    return out


def named_worker() -> Column:
    return F.col("finished_by_name") != ""


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """Combine one-row frames with different columns into one row, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
