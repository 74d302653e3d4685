"""Time-bucketed views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent, rounded
from fieldstay.functions.times import MICROS_PER_HOUR, Clock, avg_micros
from fieldstay.operators.ranking import join_sparse
from fieldstay.plans.common import (
    DEPARTMENTS,
    avg_hours_to_complete,
    count_all,
    created_since,
    department,
    finished,
    is_open,
    pressing,
    priority,
    total_micros,
)

Tables = Mapping[str, DataFrame]


def reservation_turnaround_analysis(tables: Tables, clock: Clock) -> DataFrame:
    """Weekly check-outs per region with the tasks linked to them.

    Only tasks of those reservations are counted, per reservation first, so the join is one row to one row.
    """
    departures = (
        tables["reservations"]
        .where(
            (F.col("reservation_status") == "active") & (F.col("checkout_date") >= clock.date_ago(90))
        )
        .select(F.col("id").alias("reservation_pk"), "region_code", "checkout_date")
    )
    linked = (
        tables["tasks"]
        .join(departures.select("reservation_pk"), "reservation_pk", "left_semi")
        .groupBy("reservation_pk")
        .agg(
            count_all().alias("linked"),
            F.count_if(department("housekeeping")).alias("housekeeping"),
            F.count_if(department("inspection")).alias("inspection"),
            F.count_if(finished()).alias("completed"),
            F.sum(F.when(finished(), total_micros().cast("double"))).alias("micros"),
            F.count(F.when(finished(), total_micros())).alias("timed"),
        )
    )
    week = F.date_trunc("week", "checkout_date").cast("date").alias("week_of")
    total = {c: F.coalesce(F.sum(c), F.lit(0)) for c in ("linked", "housekeeping", "inspection", "completed")}
    return (
        departures.join(linked, "reservation_pk", "left")
        .groupBy("region_code", week)
        .agg(
            F.count("reservation_pk").alias("reservations"),
            total["linked"].alias("linked_tasks"),
            total["housekeeping"].alias("housekeeping_tasks"),
            total["inspection"].alias("inspection_tasks"),
            total["completed"].alias("completed_tasks"),
            percent(F.sum("completed"), F.sum("linked")).alias("task_completion_rate"),
            rounded(
                F.sum("micros") / F.nullif(F.sum("timed").cast("double"), F.lit(0.0)) / MICROS_PER_HOUR, 1
            ).alias("avg_hours_turnaround"),
        )
    )


def monthly_trend_analysis(tables: Tables, clock: Clock) -> DataFrame:
    """Tasks per month, region and department with the previous month's volume."""
    keys = ["region_code", "type_department"]
    monthly = (
        created_since(tables["tasks"], clock, months=12)
        .groupBy(F.trunc("created_at", "month").alias("month"), *keys)
        .agg(
            count_all().alias("tasks_created"),
            F.count_if(finished()).alias("tasks_completed"),
            percent(F.count_if(finished()), count_all()).alias("completion_rate"),
            avg_hours_to_complete().alias("avg_hours_to_complete"),
            F.count_if(priority("urgent")).alias("urgent_tasks"),
            F.count_if(priority("high")).alias("high_priority_tasks"),
            F.count_distinct("finished_by_id").alias("unique_workers"),
        )
    )
    # At most 13 months per region and department.
    by_month = Window.partitionBy(*keys).orderBy("month")
    return monthly.withColumn("prev_month_tasks", F.lag("tasks_created").over(by_month))


def weekly_operational_snapshot(tables: Tables, clock: Clock) -> DataFrame:
    """This calendar week (from Monday) against the last, per region."""
    monday = F.lit(clock.week_start())
    before = F.date_sub(monday, 7).cast("timestamp")
    start = monday.cast("timestamp")

    def this_week(c: str):
        return F.col(c) >= start

    def last_week(c: str):
        return (F.col(c) >= before) & (F.col(c) < start)

    return (
        tables["tasks"]
        .groupBy("region_code")
        .agg(
            F.count_if(this_week("created_at")).alias("tasks_created_this_week"),
            F.count_if(this_week("finished_at")).alias("tasks_completed_this_week"),
            F.count_if(last_week("created_at")).alias("tasks_created_last_week"),
            F.count_if(last_week("finished_at")).alias("tasks_completed_last_week"),
            F.count_if(is_open()).alias("current_backlog"),
            F.count_if(is_open() & pressing()).alias("urgent_high_backlog"),
            *[
                F.count_if(department(d) & this_week("created_at")).alias(f"{d}_this_week")
                for d in DEPARTMENTS
            ],
            F.count_distinct(F.when(this_week("finished_at"), F.col("finished_by_id"))).alias(
                "active_workers_this_week"
            ),
        )
        .withColumn("week_start", monday)
    )


def seasonal_demand_patterns(tables: Tables, clock: Clock) -> DataFrame:
    """Task volume by month and weekday over twelve months; names are blank-padded to nine."""
    created = F.col("created_at")
    return (
        created_since(tables["tasks"], clock, months=12)
        .groupBy(
            "region_code",
            F.month(created).alias("month_num"),
            F.rpad(F.date_format(created, "MMMM"), 9, " ").alias("month_name"),
            (F.dayofweek(created) - 1).alias("day_of_week"),
            F.rpad(F.date_format(created, "EEEE"), 9, " ").alias("day_name"),
        )
        .agg(
            count_all().alias("total_tasks"),
            *[F.count_if(department(d)).alias(d) for d in DEPARTMENTS],
            F.count("reservation_pk").alias("reservation_linked"),
            F.count_if(pressing()).alias("urgent_high_priority"),
        )
    )


def monthly_completion_metrics(tables: Tables, clock: Clock) -> DataFrame:
    """Tasks finished per calendar month and their mean hours since creation."""
    return (
        tables["tasks"]
        .where(F.col("finished_at").isNotNull())
        .groupBy(F.date_trunc("month", "finished_at").alias("month"))
        .agg(
            count_all().alias("tasks_completed"),
            avg_micros(total_micros(), MICROS_PER_HOUR).alias("avg_hours_to_complete"),
        )
    )


def task_tags_analysis(tables: Tables, clock: Clock) -> DataFrame:
    """Use and completion of each tag."""
    tasks = tables["tasks"].select(
        F.col("id").alias("task_pk"), "created_at", "finished_at", "type_department", "task_status_stage"
    )
    per_tag = (
        tables["task_tags"]
        .join(tasks, "task_pk", "left")
        .groupBy("tag_pk")
        .agg(
            F.count("task_pk").alias("tagged_tasks_all_time"),
            F.count_if(F.col("created_at") >= clock.days_ago(90)).alias("tagged_tasks_90d"),
            *[F.count_if(department(d)).alias(f"{d}_tasks") for d in DEPARTMENTS],
            F.count_if(finished()).alias("completed_tasks"),
            F.sum(F.when(finished(), total_micros().cast("double"))).alias("_micros"),
            F.count(F.when(finished(), total_micros())).alias("_timed"),
        )
    )
    figures = [c for c in per_tag.columns if c != "tag_pk"]
    hours = F.col("_micros") / F.nullif(F.col("_timed").cast("double"), F.lit(0.0)) / MICROS_PER_HOUR
    # Tags of one name in one region are one line, so the per-tag sums are added up.
    return (
        tables["tags"]
        .select(F.col("id").alias("tag_pk"), "tag_name", "region_code")
        .join(per_tag, "tag_pk")
        .groupBy("tag_name", "region_code")
        .agg(*[F.sum(c).alias(c) for c in figures])
        .where(F.col("tagged_tasks_all_time") > 0)
        .withColumns(
            {
                "completion_rate": percent(F.col("completed_tasks"), F.col("tagged_tasks_all_time")),
                "avg_hours_to_complete": rounded(hours, 1),
            }
        )
        .drop("_micros", "_timed")
    )


def task_assignees(tables: Tables, clock: Clock) -> DataFrame:
    """Every task with its assignees and, where the person is known, the registered name."""
    people = tables["people"].select(
        F.col("person_id").alias("assignee_id"), F.col("person_name").alias("registered_name")
    )
    assigned = tables["task_assignments"].select("task_pk", "assignee_id")
    tasks = tables["tasks"].select(
        F.col("id").alias("task_pk"), "task_name", "task_status_stage", "scheduled_date"
    )
    named = join_sparse(tasks.join(assigned, "task_pk", "left"), people, "assignee_id")
    return named.select(*tasks.columns, "assignee_id", "registered_name")
