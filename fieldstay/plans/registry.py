"""The views by name, their presentation order, and refreshing all of them into a folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.plans import boards, properties, regions, trends, workers
from fieldstay.plans.common import PRIORITY_ORDER, case, count_all
from fieldstay.session import scratch_path
from fieldstay.sources.snapshot import SnapshotStore

Order = Callable[[], list[Column]]


def _by(*columns: str) -> Order:
    """Ascending order by column; a leading minus means descending with NULLs last."""
    return lambda: [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in columns
    ]


def _by_priority() -> list[Column]:
    return [*_by("region_code", "type_department")(), case("type_priority", PRIORITY_ORDER, 6).asc()]


def _by_severity() -> list[Column]:
    rank = case("severity", {"Critical": 1, "High": 2, "Medium": 3}, 4)
    return [rank.asc(), F.col("alert_trigger_date").desc_nulls_first()]


def _by_sla_status() -> list[Column]:
    rank = case("health_status", {"Critical": 1, "Degraded": 2, "At Risk": 3}, 4)
    return [rank.asc(), *_by("region_code", "type_department")()]


@dataclass(frozen=True)
class View:
    build: Callable[..., DataFrame]
    order: Order | None = None


VIEWS: dict[str, View] = {
    "portfolio_executive_summary": View(regions.portfolio_executive_summary),
    "regional_performance_scorecard": View(regions.regional_performance_scorecard, _by("-tasks_90d")),
    "worker_leaderboard_housekeeping": View(workers.worker_leaderboard_housekeeping, _by("-tasks_completed_90d")),
    "worker_leaderboard_inspection": View(workers.worker_leaderboard_inspection, _by("-tasks_completed_90d")),
    "worker_leaderboard_maintenance": View(workers.worker_leaderboard_maintenance, _by("-tasks_completed_90d")),
    "worker_efficiency_ranking": View(workers.worker_efficiency_ranking, _by("-total_tasks_90d")),
    "task_completion_metrics": View(regions.task_completion_metrics, _by("region_code", "type_department")),
    "task_backlog_aging": View(regions.task_backlog_aging, _by_priority),
    "property_task_density": View(properties.property_task_density, _by("-total_tasks_all_time")),
    "property_operational_health": View(properties.property_operational_health, _by("-health_score")),
    "property_maintenance_burden": View(properties.property_maintenance_burden, _by("-total_maintenance_tasks")),
    "property_dashboard": View(properties.property_dashboard, _by("-total_tasks_all_time")),
    "reservation_turnaround_analysis": View(trends.reservation_turnaround_analysis, _by("region_code", "-week_of")),
    "monthly_trend_analysis": View(trends.monthly_trend_analysis, _by("-month", "region_code", "type_department")),
    "weekly_operational_snapshot": View(trends.weekly_operational_snapshot, _by("region_code")),
    "priority_response_times": View(regions.priority_response_times, _by_priority),
    "task_tags_analysis": View(trends.task_tags_analysis, _by("-tagged_tasks_all_time")),
    "regional_workload_distribution": View(regions.regional_workload_distribution, _by("-avg_daily_tasks_created")),
    "regional_dashboard": View(regions.regional_dashboard, _by("-tasks_90d")),
    "seasonal_demand_patterns": View(trends.seasonal_demand_patterns, _by("region_code", "month_num", "day_of_week")),
    "data_quality_scorecard": View(boards.data_quality_scorecard),
    "operational_alerts": View(boards.operational_alerts, _by_severity),
    "daily_turnover_board": View(boards.daily_turnover_board, boards.turnover_board_order),
    "inspection_compliance": View(boards.inspection_compliance, _by("entity_type", "region_code", "-total_inspections")),
    "housekeeping_schedule_performance": View(
        workers.housekeeping_schedule_performance, _by("region_code", "-tasks_90d")
    ),
    "department_sla_tracker": View(boards.department_sla_tracker, _by_sla_status),
}

# The eighteen views of the regular refresh; the others are computed on demand.
REFRESHED = (
    "regional_dashboard property_dashboard worker_leaderboard_housekeeping worker_leaderboard_inspection"
    " worker_leaderboard_maintenance worker_efficiency_ranking task_completion_metrics"
    " priority_response_times department_sla_tracker reservation_turnaround_analysis"
    " daily_turnover_board inspection_compliance housekeeping_schedule_performance"
    " monthly_trend_analysis weekly_operational_snapshot seasonal_demand_patterns task_tags_analysis"
    " operational_alerts"
).split()


# Views refreshed at a time.
SIDE_BY_SIDE = 4


def _ordered(name: str, df: DataFrame) -> DataFrame:
    order = VIEWS[name].order
    return df.orderBy(*order()) if order else df


def present(name: str, tables: Mapping[str, DataFrame], clock: Clock, **options) -> DataFrame:
    """A view in its presentation order."""
    return _ordered(name, VIEWS[name].build(tables, clock, **options))


def refresh_all(
    tables: Mapping[str, DataFrame], clock: Clock, folder: str, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """Recompute the views and replace them in the snapshot store ``folder``, stamped with the refresh time.

    A reader finds the old view until the new one is whole. Views are built side by side, so that short
    stages of one fill the gaps of another; the returned frames put them in order when they are read.
    """
    store = SnapshotStore(tables["regions"].sparkSession, folder)

    def refresh(name: str) -> DataFrame:
        store.write(name, VIEWS[name].build(tables, clock).withColumn("refreshed_at", clock.timestamp()))
        return _ordered(name, store.read(name))

    wanted = list(names or REFRESHED)
    # Tables are made ready by one thread; the views only read them.
    for used in tables:
        tables[used]
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return dict(zip(wanted, pool.map(refresh, wanted), strict=True))


def refresh_report(
    tables: Mapping[str, DataFrame], clock: Clock, folder: str | None = None,
    figures: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Refresh every regular view; one line per view with its row count, or what ``figures`` makes of its name and its
    stored rows."""
    spark = tables["regions"].sparkSession
    views = refresh_all(tables, clock, folder or scratch_path(spark, "views"))

    def count(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("view_name"), count_all().alias("view_rows"))

    return reduce(DataFrame.union, [(figures or count)(name, df) for name, df in views.items()])
