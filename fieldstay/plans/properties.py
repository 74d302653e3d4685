"""Property-level density, maintenance burden, health score and the combined dashboard.

Tasks are aggregated per property before they meet the property table: a property that owns a third
of all tasks shrinks to one row per input partition before the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent, ratio, rounded
from fieldstay.functions.times import Clock
from fieldstay.operators.ranking import Rank, dense_ranks, join_on
from fieldstay.plans.common import (
    DEPARTMENTS,
    avg_hours,
    count_all,
    department,
    finished,
    is_open,
    pressing,
    priority,
    total_micros,
)
from fieldstay.session import durable

Tables = Mapping[str, DataFrame]
IDENTITY = ["property_pk", "property_id", "property_name", "region_code", "property_city"]


def _created(clock: Clock, days: int) -> Column:
    return F.col("created_at") >= clock.days_ago(days)


def _active_properties(tables: Tables) -> DataFrame:
    return (
        tables["properties"]
        .where(F.col("property_status") == "active")
        .select(F.col("id").alias("property_pk"), *IDENTITY[1:])
    )


def _active_reservations(tables: Tables) -> DataFrame:
    return (
        tables["reservations"]
        .where((F.col("reservation_status") == "active") & F.col("property_pk").isNotNull())
        .groupBy("property_pk")
        .agg(count_all().alias("active_reservations"))
    )


def _density(clock: Clock) -> dict[str, Column]:
    return {
        "total_tasks_all_time": count_all(),
        **{f"tasks_{d}d": F.count_if(_created(clock, d)) for d in (90, 30, 7)},
        **{f"{d}_tasks_90d": F.count_if(department(d) & _created(clock, 90)) for d in DEPARTMENTS},
        "urgent_high_tasks_90d": F.count_if(pressing() & _created(clock, 90)),
        "current_backlog": F.count_if(is_open()),
    }


def _burden(clock: Clock, where: Column, names: dict[str, str]) -> dict[str, Column]:
    """Maintenance figures of one property over the tasks that satisfy ``where``."""
    recent, quarter = F.count_if(where & _created(clock, 30)), F.count_if(where & _created(clock, 90))
    figures = {
        "total": F.count_if(where),
        "90d": quarter,
        "30d": recent,
        "urgent": F.count_if(where & priority("urgent")),
        "high": F.count_if(where & priority("high")),
        "backlog": F.count_if(where & is_open()),
        "hours": rounded(avg_hours(total_micros(), where & finished()), 1),
        "recency": ratio(recent, quarter / 3.0, 2),
        "paid": F.coalesce(F.sum(F.when(where, F.col("rate_paid"))), F.lit(Decimal("0.00"))),
    }
    return {names[k]: v for k, v in figures.items()}


def _health_inputs(clock: Clock) -> dict[str, Column]:
    created = _created(clock, 90)
    return {
        "urgent_backlog": F.count_if(pressing() & is_open()),
        "completion_rate": percent(F.count_if(finished() & created), F.count_if(created)),
        "_turnaround": avg_hours(total_micros(), finished()),
    }


def _per_property(tables: Tables, figures: dict[str, Column], where: Column | None = None) -> DataFrame:
    tasks = tables["tasks"].where(F.col("property_pk").isNotNull())
    if where is not None:
        tasks = tasks.where(where)
    return tasks.groupBy("property_pk").agg(*[v.alias(k) for k, v in figures.items()])


def _counts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.typeName() == "long" and f.name != "property_pk"]


def _with_tasks(tables: Tables, per_property: DataFrame) -> DataFrame:
    """Active properties with their task figures; a property without tasks counts zero."""
    joined = _active_properties(tables).join(per_property, "property_pk", "left")
    return joined.fillna(0, _counts(per_property))


def property_task_density(tables: Tables, clock: Clock) -> DataFrame:
    """Task counts of each active property, ranked by volume."""
    figures = _density(clock) | {
        "avg_hours_to_complete": rounded(avg_hours(total_micros(), finished()), 1)
    }
    out = (
        _with_tasks(tables, _per_property(tables, figures))
        .join(_active_reservations(tables), "property_pk", "left")
        .fillna(0, ["active_reservations"])
    )
    return dense_ranks(out, _volume_ranks())


def _volume_ranks() -> list[Rank]:
    return [
        Rank("regional_task_rank", "total_tasks_all_time", ("region_code",)),
        Rank("global_task_rank", "total_tasks_all_time"),
    ]


def property_maintenance_burden(tables: Tables, clock: Clock) -> DataFrame:
    """Properties with maintenance tasks: volume, recency, cost and regional rank."""
    names = {
        "total": "total_maintenance_tasks",
        "90d": "maintenance_90d",
        "30d": "maintenance_30d",
        "urgent": "urgent_tasks",
        "high": "high_priority_tasks",
        "backlog": "maintenance_backlog",
        "hours": "avg_hours_to_resolve",
        "recency": "recency_ratio",
        "paid": "total_rate_paid",
    }
    burden = _per_property(tables, _burden(clock, F.lit(True), names), department("maintenance"))
    out = _active_properties(tables).join(burden, "property_pk")
    return dense_ranks(
        out, [Rank("regional_maintenance_rank", "total_maintenance_tasks", ("region_code",))]
    )


# The scores, their weights and limits, and the names of the grades below.
def _turnaround_score(with_middle: bool) -> Column:
    """80 at or under the regional mean, 60 up to half above it, else 40; 50 without data."""
    limit = F.coalesce("_region_turnaround", F.lit(200.0))
    score = F.when(F.col("_turnaround").isNull(), 50).when(F.col("_turnaround") <= limit, 80)
    if with_middle:
        score = score.when(F.col("_turnaround") <= limit * 1.5, 60)
    return score.otherwise(40)


def _composite(turnaround: Column) -> Column:
    parts = [("backlog_score", "0.25"), ("completion_score", "0.35"), ("urgency_score", "0.25")]
    total = turnaround.cast("decimal(10,1)") * F.lit(Decimal("0.15"))
    for name, weight in parts:
        total = total + F.col(name).cast("decimal(10,1)") * F.lit(Decimal(weight))
    return total


def _scored(df: DataFrame, backlog: str) -> DataFrame:
    """Add the four scores, the composite and the status.

    The status is graded without the middle turnaround step that the composite has, so a score of
    80 or more does not always read "Excellent".
    """
    graded = _composite(_turnaround_score(with_middle=False))
    return (
        df.withColumns(
            {
                "avg_turnaround_hours": rounded(F.col("_turnaround"), 1),
                "backlog_score": F.greatest(F.lit(0).cast("long"), 100 - F.col(backlog) * 10),
                "completion_score": F.coalesce(F.col("completion_rate"), F.lit(50)),
                "urgency_score": F.when(F.col("urgent_backlog") == 0, 100)
                .when(F.col("urgent_backlog") <= 2, 70)
                .otherwise(40),
                "turnaround_score": _turnaround_score(with_middle=True),
            }
        )
        .withColumns(
            {
                "health_score": F.round(_composite(F.col("turnaround_score")), 1),
                "health_status": F.when(graded >= 80, "Excellent")
                .when(graded >= 65, "Good")
                .when(graded >= 50, "Fair")
                .otherwise("Needs Attention"),
            }
        )
        .drop("_turnaround", "_region_turnaround")
    )


def _region_mean(properties: DataFrame) -> DataFrame:
    return properties.groupBy("region_code").agg(F.avg("_turnaround").alias("_region_turnaround"))


def property_operational_health(tables: Tables, clock: Clock) -> DataFrame:
    """Composite health score of each active property."""
    figures = {
        "tasks_90d": F.count_if(_created(clock, 90)),
        "backlog": F.count_if(is_open()),
        **_health_inputs(clock),
    }
    base = durable(_with_tasks(tables, _per_property(tables, figures)).drop("property_city"))
    return _scored(join_on(base, _region_mean(base), ["region_code"]), "backlog")


def property_dashboard(tables: Tables, clock: Clock) -> DataFrame:
    """Density, maintenance burden and health of each active property from one scan of tasks."""
    names = {
        "total": "total_maintenance_tasks",
        "90d": "maintenance_90d",
        "30d": "maintenance_30d",
        "urgent": "maintenance_urgent_tasks",
        "high": "maintenance_high_priority_tasks",
        "backlog": "maintenance_backlog",
        "hours": "maintenance_avg_hours_to_resolve",
        "recency": "maintenance_recency_ratio",
        "paid": "maintenance_total_rate_paid",
    }
    figures = (
        _density(clock) | _burden(clock, department("maintenance"), names) | _health_inputs(clock)
    )
    base = (
        _with_tasks(tables, _per_property(tables, figures))
        .join(_active_reservations(tables), "property_pk", "left")
        .fillna(0, ["active_reservations"])
        .withColumns(
            {
                "avg_hours_to_complete": rounded(F.col("_turnaround"), 1),
                "maintenance_total_rate_paid": F.coalesce(
                    "maintenance_total_rate_paid", F.lit(Decimal("0.00"))
                ),
            }
        )
    )
    ranked = dense_ranks(
        base,
        [
            *_volume_ranks(),
            Rank("regional_maintenance_rank", "total_maintenance_tasks", ("region_code",)),
        ],
    )
    return _scored(join_on(ranked, _region_mean(ranked), ["region_code"]), "current_backlog")


def needs_attention(health: DataFrame) -> DataFrame:
    return health.where(F.col("health_status") == "Needs Attention").select(
        "property_name", "region_code", "health_score", "backlog", "urgent_backlog"
    )
