"""Worker leaderboards, efficiency ranking and schedule performance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent, ratio, rounded
from fieldstay.functions.times import MICROS_PER_MINUTE, Clock
from fieldstay.operators.ranking import Percentile, Rank, dense_ranks, exact_percentiles, join_on
from fieldstay.plans.common import (
    active_micros,
    avg_hours,
    avg_minutes,
    count_all,
    department,
    finished,
    finished_since,
    named_worker,
    pressing,
    priority,
    total_micros,
)

WORKER = ["finished_by_name", "finished_by_id", "region_code"]


def _completed(tables: Mapping[str, DataFrame], clock: Clock, days: int) -> DataFrame:
    """Tasks finished by a named worker within the window."""
    return finished_since(tables, clock, days).where(finished() & named_worker())


def _span() -> Column:
    return F.date_diff(F.max("finished_at").cast("date"), F.min("finished_at").cast("date"))


def _per_day() -> Column:
    return ratio(count_all(), F.greatest(_span(), F.lit(1)), 2)


def _recent_counts(clock: Clock, unit: str) -> list[Column]:
    return [
        F.count_if(F.col("finished_at") >= clock.days_ago(d)).alias(f"{unit}_{d}d") for d in (30, 7)
    ]


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"finished_by_name": "worker_name", "finished_by_id": "worker_id"})


def _median_minutes(tasks: DataFrame, name: str) -> DataFrame:
    """Median active minutes per worker and region."""
    values = tasks.select(*WORKER, active_micros().alias("active"))
    return exact_percentiles(values, WORKER, [Percentile(name, "active", 0.5, MICROS_PER_MINUTE)])


def _volume_ranks(df: DataFrame, volume: str) -> DataFrame:
    return dense_ranks(
        df, [Rank("regional_rank", volume, ("region_code",)), Rank("global_rank", volume)]
    )


def worker_leaderboard(
    tables: Mapping[str, DataFrame], clock: Clock, dept: str, window_days: int = 90, min_tasks: int = 5
) -> DataFrame:
    """Workers of one department by volume, speed and steadiness, ranked per region and overall."""
    tasks = _completed(tables, clock, window_days).where(department(dept))
    minutes = active_micros().cast("double") / MICROS_PER_MINUTE
    board = (
        tasks.groupBy(*WORKER)
        .agg(
            count_all().alias("tasks_completed_90d"),
            *_recent_counts(clock, "tasks_completed"),
            rounded(avg_minutes(active_micros()), 1).alias("avg_minutes_active"),
            rounded(avg_hours(total_micros()), 1).alias("avg_hours_total_turnaround"),
            rounded(F.stddev_samp(minutes), 1).alias("stddev_minutes_active"),
            F.min("finished_at").cast("date").alias("first_task_date"),
            F.max("finished_at").cast("date").alias("last_task_date"),
            _span().alias("active_days_span"),
            _per_day().alias("tasks_per_day"),
        )
        .where(F.col("tasks_completed_90d") >= min_tasks)
    )
    median = _median_minutes(tasks, "median_minutes_active")
    board = join_on(board, median, WORKER).withColumn(
        "median_minutes_active", rounded(F.col("median_minutes_active"), 1)
    )
    return _volume_ranks(_named(board), "tasks_completed_90d")


def worker_leaderboard_housekeeping(tables, clock: Clock, **options) -> DataFrame:
    return worker_leaderboard(tables, clock, "housekeeping", **options)


def worker_leaderboard_inspection(tables, clock: Clock, **options) -> DataFrame:
    return worker_leaderboard(tables, clock, "inspection", **options)


def worker_leaderboard_maintenance(
    tables: Mapping[str, DataFrame], clock: Clock, window_days: int = 90, min_tasks: int = 5
) -> DataFrame:
    """Maintenance workers: volume by priority, speed, and response to urgent tasks."""
    board = (
        _completed(tables, clock, window_days)
        .where(department("maintenance"))
        .groupBy(*WORKER)
        .agg(
            count_all().alias("tasks_completed_90d"),
            *_recent_counts(clock, "tasks_completed"),
            F.count_if(priority("urgent")).alias("urgent_tasks_90d"),
            F.count_if(priority("high")).alias("high_priority_tasks_90d"),
            F.count_if(priority("normal")).alias("normal_tasks_90d"),
            rounded(avg_minutes(active_micros()), 1).alias("avg_minutes_active"),
            rounded(avg_hours(total_micros()), 1).alias("avg_hours_total_turnaround"),
            rounded(avg_hours(total_micros(), priority("urgent")), 1).alias("avg_urgent_response_hours"),
            F.min("finished_at").cast("date").alias("first_task_date"),
            F.max("finished_at").cast("date").alias("last_task_date"),
            _per_day().alias("tasks_per_day"),
        )
        .where(F.col("tasks_completed_90d") >= min_tasks)
    )
    return _volume_ranks(_named(board), "tasks_completed_90d")


def worker_efficiency_ranking(
    tables: Mapping[str, DataFrame], clock: Clock, window_days: int = 90, min_tasks: int = 10
) -> DataFrame:
    """Workers across departments with efficiency and versatility scores."""
    minutes = active_micros().cast("double") / MICROS_PER_MINUTE
    stats = (
        _completed(tables, clock, window_days)
        .groupBy(*WORKER)
        .agg(
            F.count_distinct("type_department").alias("departments_worked"),
            count_all().alias("total_tasks_90d"),
            *[
                F.count_if(department(d)).alias(f"{d}_count")
                for d in ("housekeeping", "inspection", "maintenance")
            ],
            F.count_if(pressing()).alias("urgent_high_tasks"),
            avg_minutes(active_micros()).alias("_avg"),
            rounded(avg_hours(total_micros()), 1).alias("avg_hours_total"),
            rounded(F.stddev_samp(minutes), 1).alias("consistency_stddev"),
            _span().alias("days_active"),
            _per_day().alias("tasks_per_day"),
        )
        .where(F.col("total_tasks_90d") >= min_tasks)
        .withColumns(
            {
                "avg_minutes_active": rounded(F.col("_avg"), 1),
                "efficiency_score": rounded(100 / (1 + F.coalesce("_avg", F.lit(60.0)) / 60), 1),
                "versatility_score": F.when(F.col("departments_worked") == 3, 100)
                .when(F.col("departments_worked") == 2, 70)
                .otherwise(40),
            }
        )
    )
    ranked = dense_ranks(
        _named(stats),
        [Rank("volume_rank", "total_tasks_90d"), Rank("speed_rank", "_avg", descending=False)],
    )
    return ranked.drop("_avg")


def housekeeping_schedule_performance(
    tables: Mapping[str, DataFrame], clock: Clock, window_days: int = 90, min_tasks: int = 5
) -> DataFrame:
    """Cleaners' punctuality and throughput against their region, with a performance band."""
    tasks = _completed(tables, clock, window_days).where(department("housekeeping"))
    on_time = F.col("finished_at").cast("date") <= F.col("scheduled_date")
    workers = (
        tasks.groupBy(*WORKER)
        .agg(
            count_all().alias("tasks_90d"),
            *_recent_counts(clock, "tasks"),
            F.count_distinct("property_pk").alias("distinct_properties"),
            F.count_distinct(F.col("finished_at").cast("date")).alias("active_days"),
            rounded(avg_minutes(active_micros()), 1).alias("avg_active_minutes"),
            percent(F.count_if(on_time), F.count("scheduled_date")).alias("on_time_rate"),
        )
        .where(F.col("tasks_90d") >= min_tasks)
    )
    median = _median_minutes(tasks, "median_active_minutes")
    workers = join_on(workers, median, WORKER).withColumn(
        "median_active_minutes", rounded(F.col("median_active_minutes"), 1)
    )
    ranked = dense_ranks(
        _named(workers),
        [
            Rank("regional_on_time_rank", "on_time_rate", ("region_code",)),
            Rank("regional_volume_rank", "tasks_90d", ("region_code",)),
        ],
    )
    # Ranked rows are materialised, so the regional figures read the small stored frame. A region's
    # volumes are counts: at most sqrt(2 * tasks) of them are distinct, which bounds the percentile.
    region = ranked.groupBy("region_code").agg(
        rounded(F.avg(F.col("avg_active_minutes").cast("double")), 1).alias("region_avg_active_minutes"),
        rounded(F.avg(F.col("on_time_rate").cast("double")), 1).alias("region_avg_on_time_rate"),
        F.percentile("tasks_90d", F.lit(0.75)).alias("_p75"),
    )
    rate = F.col("on_time_rate")
    # The names and limits of the bands.
    return (
        join_on(ranked, region, ["region_code"])
        .withColumns(
            {
                "tasks_per_active_day": ratio(F.col("tasks_90d"), F.col("active_days"), 2),
                "properties_per_active_day": ratio(F.col("distinct_properties"), F.col("active_days"), 2),
                "performance_band": F.when(
                    (rate >= 90) & (F.col("tasks_90d") >= F.col("_p75")), "Top Performer"
                )
                .when(rate >= 75, "Solid")
                .when(rate >= 60, "Developing")
                .otherwise("Needs Coaching"),
            }
        )
        .drop("_p75")
    )


def top_workers(board: DataFrame, limit: int, rank: str = "global_rank") -> DataFrame:
    """Rows of a leaderboard whose rank is within the limit (ties included)."""
    return board.where(F.col(rank) <= limit)
