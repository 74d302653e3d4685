"""Region-level scorecards, workload, backlog and the combined dashboard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent, ratio, rounded
from fieldstay.functions.times import MICROS_PER_HOUR, Clock
from fieldstay.operators.ranking import Percentile, exact_percentiles, join_on
from fieldstay.plans.common import (
    DEPARTMENTS,
    active_micros,
    age_buckets,
    age_days,
    avg_hours,
    avg_hours_to_complete,
    avg_minutes,
    count_all,
    created_since,
    department,
    finished,
    finished_since,
    is_open,
    side_by_side,
    stage,
    start_micros,
    total_micros,
)

Tables = Mapping[str, DataFrame]


def portfolio_executive_summary(tables: Tables, clock: Clock) -> DataFrame:
    """One row over the whole portfolio: one aggregate per base table."""
    created_30d = F.col("created_at") >= clock.days_ago(30)
    done_30d = finished() & (F.col("finished_at") >= clock.days_ago(30))
    active = F.col("reservation_status") == "active"
    properties = tables["properties"].where(F.col("property_status") == "active").agg(
        count_all().alias("total_properties")
    )
    regions = tables["regions"].where("is_active").agg(count_all().alias("total_regions"))
    tasks = tables["tasks"].agg(
        F.count_distinct("finished_by_id").alias("total_active_workers"),
        F.count_if(created_30d).alias("tasks_last_30_days"),
        F.count_if(done_30d).alias("completed_last_30_days"),
        F.count_if(stage("new")).alias("current_backlog"),
        F.count_if(stage("in_progress")).alias("in_progress"),
        percent(F.count_if(done_30d), F.count_if(created_30d)).alias("completion_rate_30d_pct"),
        rounded(avg_hours(total_micros(), done_30d), 1).alias("avg_turnaround_hours_30d"),
        *[F.count_if(department(d) & stage("new")).alias(f"{d}_backlog") for d in DEPARTMENTS],
    )
    reservations = tables["reservations"].where(active).agg(
        F.count_if(F.col("checkin_date") >= clock.date()).alias("upcoming_reservations"),
        F.count_if(F.col("checkin_date") == clock.date()).alias("checkins_today"),
        F.count_if(F.col("checkout_date") == clock.date()).alias("checkouts_today"),
    )
    return side_by_side(properties, regions, tasks, reservations)


def _region_tasks(tables: Tables, clock: Clock) -> DataFrame:
    return (
        created_since(tables["tasks"], clock, 90)
        .groupBy("region_code")
        .agg(
            count_all().alias("tasks_90d"),
            F.count_if(finished()).alias("completed_90d"),
            F.count_if(stage("new")).alias("current_backlog"),
            F.count_if(stage("in_progress")).alias("in_progress"),
            avg_hours_to_complete().alias("avg_hours_to_complete"),
            rounded(avg_minutes(active_micros(), finished()), 1).alias("avg_minutes_active_work"),
            F.count_distinct("finished_by_id").alias("active_workers"),
        )
    )


def _region_properties(tables: Tables, name: str = "properties") -> DataFrame:
    active = tables["properties"].where(F.col("property_status") == "active")
    return active.groupBy("region_code").agg(count_all().alias(name))


def _region_reservations(tables: Tables, clock: Clock) -> DataFrame:
    active = tables["reservations"].where(F.col("reservation_status") == "active")
    return active.groupBy("region_code").agg(
        count_all().alias("reservations"),
        F.count_if(F.col("checkin_date") >= clock.date()).alias("upcoming_reservations"),
    )


def _scorecard_parts(tables: Tables, clock: Clock) -> DataFrame:
    """Active regions with task, property and reservation figures; missing counts are zero."""
    out = tables["regions"].where("is_active").select("region_code", "region_name")
    for part in (
        _region_tasks(tables, clock),
        _region_properties(tables),
        _region_reservations(tables, clock),
    ):
        out = out.join(part, "region_code", "left")
    counts = (
        "tasks_90d completed_90d current_backlog in_progress active_workers properties"
        " reservations upcoming_reservations"
    ).split()
    return out.fillna(0, counts).withColumns(
        {
            "completion_rate_pct": percent(F.col("completed_90d"), F.col("tasks_90d")),
            "tasks_per_property_90d": ratio(F.col("tasks_90d"), F.col("properties"), 1),
        }
    )


def regional_performance_scorecard(tables: Tables, clock: Clock) -> DataFrame:
    """Volume, speed and coverage of each active region."""
    return _scorecard_parts(tables, clock).drop("in_progress")


def _daily_volume(tables: Tables, clock: Clock) -> DataFrame:
    return (
        created_since(tables["tasks"], clock, 30)
        .groupBy("region_code", F.col("created_at").cast("date").alias("task_date"))
        .agg(count_all().alias("tasks_created"), F.count_if(finished()).alias("tasks_completed"))
    )


def _workload(tables: Tables, clock: Clock) -> DataFrame:
    """30-day daily volume per region. The busiest day is the earliest of equals."""
    busiest = F.min(F.struct(-F.col("tasks_created"), F.col("task_date")))["task_date"]
    return (
        _daily_volume(tables, clock)
        .groupBy("region_code")
        .agg(
            F.avg("tasks_created").alias("_daily"),
            rounded(F.avg("tasks_created"), 1).alias("avg_daily_tasks_created"),
            rounded(F.avg("tasks_completed"), 1).alias("avg_daily_tasks_completed"),
            F.max("tasks_created").alias("peak_daily_tasks"),
            rounded(F.stddev_samp("tasks_created"), 1).alias("stddev_daily_tasks"),
            busiest.alias("busiest_day"),
        )
    )


def regional_workload_distribution(tables: Tables, clock: Clock) -> DataFrame:
    """Daily task volume of each region against its properties and active workers."""
    workers = (
        finished_since(tables, clock, 30)
        .groupBy("region_code")
        .agg(F.count_distinct("finished_by_id").alias("active_workers_30d"))
    )
    return (
        _workload(tables, clock)
        .join(_region_properties(tables, "property_count"), "region_code", "left")
        .join(workers, "region_code", "left")
        .fillna(0, ["property_count", "active_workers_30d"])
        .withColumns(
            {
                "tasks_per_property_per_day": ratio(F.col("_daily"), F.col("property_count"), 2),
                "tasks_per_worker_per_day": ratio(F.col("_daily"), F.col("active_workers_30d"), 2),
            }
        )
        .drop("_daily")
    )


def _age_summary(clock: Clock, avg: str, oldest_age: str, oldest: str, total: str) -> list:
    return [
        count_all().alias(total),
        rounded(F.avg(age_days(clock)), 1).alias(avg),
        F.max(age_days(clock)).alias(oldest_age),
        F.min("created_at").alias(oldest),
    ]


def task_backlog_aging(tables: Tables, clock: Clock) -> DataFrame:
    """Open tasks by age bucket per region, department and priority."""
    names = tuple(f"age_{b}_days" for b in ("0_1", "2_3", "4_7", "8_14", "15_30", "over_30"))
    return (
        tables["tasks"]
        .where(is_open())
        .groupBy("region_code", "type_department", "type_priority")
        .agg(
            *age_buckets(clock, names),
            *_age_summary(clock, "avg_age_days", "max_age_days", "oldest_task_created", "total_backlog"),
        )
    )


def regional_dashboard(tables: Tables, clock: Clock) -> DataFrame:
    """Scorecard, workload and backlog ageing of each active region in one row."""
    names = tuple(f"backlog_age_{b}d" for b in ("0_1", "2_3", "4_7", "8_14", "15_30", "over_30"))
    ageing = (
        tables["tasks"]
        .where(is_open())
        .groupBy("region_code")
        .agg(
            *age_buckets(clock, names),
            *_age_summary(
                clock,
                "avg_backlog_age_days",
                "max_backlog_age_days",
                "oldest_backlog_task_created",
                "total_backlog_tasks",
            ),
        )
    )
    daily = F.col("avg_daily_tasks_created")
    return (
        _scorecard_parts(tables, clock)
        .join(_workload(tables, clock).drop("_daily"), "region_code", "left")
        .join(ageing, "region_code", "left")
        .fillna(0, [*names, "total_backlog_tasks", "peak_daily_tasks"])
        .withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("avg_daily_tasks_created", "avg_daily_tasks_completed")}
        )
        .withColumns(
            {
                "tasks_per_property_per_day": ratio(daily, F.col("properties"), 2),
                "tasks_per_worker_per_day": ratio(daily, F.col("active_workers"), 2),
            }
        )
    )


def task_completion_metrics(tables: Tables, clock: Clock, window_days: int = 90) -> DataFrame:
    """Completion rates and durations per region and department."""
    keys = ["region_code", "type_department"]
    tasks = created_since(tables["tasks"], clock, window_days)
    same_day = finished() & (F.col("finished_at").cast("date") == F.col("created_at").cast("date"))
    metrics = tasks.groupBy(*keys).agg(
        count_all().alias("total_tasks_90d"),
        F.count_if(finished()).alias("completed_90d"),
        F.count_if(stage("new")).alias("pending"),
        F.count_if(stage("in_progress")).alias("in_progress"),
        percent(F.count_if(finished()), count_all()).alias("completion_rate_pct"),
        avg_hours_to_complete().alias("avg_hours_to_complete"),
        rounded(avg_minutes(active_micros(), finished()), 1).alias("avg_minutes_active_work"),
        F.count_if(same_day).alias("same_day_completions"),
        percent(F.count_if(same_day), F.count_if(finished())).alias("same_day_rate_pct"),
        F.count_distinct("finished_by_id").alias("unique_workers"),
    )
    spread = exact_percentiles(
        tasks.where(finished()).select(*keys, total_micros().alias("total")),
        keys,
        [
            Percentile("median_hours_to_complete", "total", 0.5, MICROS_PER_HOUR),
            Percentile("p90_hours_to_complete", "total", 0.9, MICROS_PER_HOUR),
        ],
    )
    return _rounded_percentiles(join_on(metrics, spread, keys), spread, keys)


def _rounded_percentiles(df: DataFrame, spread: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), 1) for c in spread.columns if c not in keys})


def priority_response_times(tables: Tables, clock: Clock, window_days: int = 90) -> DataFrame:
    """Hours to start and to resolve per region, department and priority."""
    keys = ["region_code", "type_department", "type_priority"]
    tasks = created_since(tables["tasks"], clock, window_days)

    def within(hours: int):
        return F.count_if(finished() & (total_micros() <= hours * MICROS_PER_HOUR))

    metrics = tasks.groupBy(*keys).agg(
        count_all().alias("total_tasks_90d"),
        F.count_if(finished()).alias("completed"),
        rounded(avg_hours(start_micros()), 1).alias("avg_hours_to_start"),
        rounded(avg_hours(total_micros(), finished()), 1).alias("avg_hours_to_resolve"),
        within(24).alias("resolved_within_24h"),
        within(48).alias("resolved_within_48h"),
    )
    values = tasks.select(
        *keys, start_micros().alias("start"), F.when(finished(), total_micros()).alias("resolve")
    )
    spread = exact_percentiles(
        values,
        keys,
        [
            Percentile("median_hours_to_start", "start", 0.5, MICROS_PER_HOUR),
            Percentile("median_hours_to_resolve", "resolve", 0.5, MICROS_PER_HOUR),
            Percentile("p90_hours_to_resolve", "resolve", 0.9, MICROS_PER_HOUR),
        ],
    )
    return _rounded_percentiles(join_on(metrics, spread, keys), spread, keys)


def region_comparison(scorecard: DataFrame) -> DataFrame:
    return scorecard.select(
        "region_code", "properties", "tasks_90d", "completion_rate_pct", "active_workers"
    )
