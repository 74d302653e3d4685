"""Turnover board, inspection compliance, SLA tracker, alerts and small operational lists."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.functions.numbers import percent, rounded
from fieldstay.functions.times import MICROS_PER_HOUR, Clock, hours_between, micros_between, on_day
from fieldstay.operators.ranking import first_per_key, join_on
from fieldstay.plans.common import (
    SLA_HOURS,
    avg_hours,
    case,
    count_all,
    created_since,
    department,
    finished,
    is_open,
    named_worker,
    priority,
    stage,
    total_micros,
)
from fieldstay.session import durable

Tables = Mapping[str, DataFrame]


def _best_task(tables: Tables, clock: Clock, dept: str, prefix: str) -> DataFrame:
    """Per property and check-out day the task furthest along, with its progress status."""
    tasks = tables["tasks"].where(
        department(dept)
        & F.col("checkout_date").isin(clock.today, _tomorrow(clock))
        & F.col("property_pk").isNotNull()
    )
    progress = case("task_status_stage", {"finished": 1, "in_progress": 2, "new": 3}, 4)
    best = first_per_key(
        tasks.select(
            "id", "property_pk", "checkout_date", "task_name", "finished_by_name", "task_status_stage"
        ),
        ["property_pk", "checkout_date"],
        [progress.asc(), F.col("id").asc()],
    )
    # Only assignments of the few board tasks are reduced to distinct tasks.
    assigned = (
        tables["task_assignments"].select(F.col("task_pk").alias("id")).join(best.select("id"), "id", "left_semi").distinct()
        .withColumn("_assigned", F.lit(True))
    )
    return best.join(assigned, "id", "left").select(
        "property_pk",
        "checkout_date",
        F.when(finished(), "completed")
        .when(stage("in_progress"), "in_progress")
        .when(F.col("_assigned"), "assigned")
        .otherwise("unassigned")
        .alias(f"{prefix}_status"),
        F.col("task_name").alias(f"{prefix}_task_name"),
        F.col("finished_by_name").alias(f"{prefix}_finished_by"),
    )


def _tomorrow(clock: Clock) -> date:
    return date.fromordinal(clock.today.toordinal() + 1)


def next_checkins(tables: Tables, clock: Clock) -> DataFrame:
    """Earliest active arrival from today on, per property."""
    upcoming = tables["reservations"].where(
        (F.col("reservation_status") == "active")
        & (F.col("checkin_date") >= clock.date())
        & F.col("property_pk").isNotNull()
    )
    first = first_per_key(
        upcoming.select("id", "property_pk", "checkin_date", "checkin_time"),
        ["property_pk"],
        [F.col("checkin_date").asc_nulls_last(), F.col("checkin_time").asc_nulls_last(), F.col("id").asc()],
    )
    return first.select(
        "property_pk",
        F.col("checkin_date").alias("next_checkin_date"),
        F.col("checkin_time").alias("next_checkin_time"),
    )


def daily_turnover_board(tables: Tables, clock: Clock) -> DataFrame:
    """Check-outs of today and tomorrow with cleaning, inspection, next arrival and risk flags."""
    departures = (
        tables["reservations"]
        .where(
            (F.col("reservation_status") == "active")
            & F.col("checkout_date").isin(clock.today, _tomorrow(clock))
        )
        .select(
            F.col("id").alias("reservation_pk"),
            "reservation_id",
            "region_code",
            "property_pk",
            "checkout_date",
            "checkout_time",
            F.coalesce("pets", F.lit(0)).alias("guest_pets"),
        )
    )
    properties = tables["properties"].select(
        F.col("id").alias("property_pk"), "property_id", "property_name"
    )
    board = (
        departures.join(properties, "property_pk")
        .join(next_checkins(tables, clock), "property_pk", "left")
        .join(_best_task(tables, clock, "housekeeping", "housekeeping"), ["property_pk", "checkout_date"], "left")
        .join(_best_task(tables, clock, "inspection", "inspection"), ["property_pk", "checkout_date"], "left")
    )
    cleaning, inspection = F.col("housekeeping_status"), F.col("inspection_status")
    gap = F.date_diff("next_checkin_date", "checkout_date")
    exact_gap = hours_between(
        on_day("checkout_date", "checkout_time"), on_day("next_checkin_date", "next_checkin_time")
    )
    timed = F.col("checkout_time").isNotNull() & F.col("next_checkin_time").isNotNull()
    flags = [
        F.when(cleaning.isNull(), "NO_HOUSEKEEPING_TASK"),
        F.when(cleaning == "unassigned", "NO_CLEANER_ASSIGNED"),
        F.when((gap <= 1) & (gap > 0), "TIGHT_TURNAROUND"),
        F.when(gap == 0, "SAME_DAY_TURNAROUND"),
        F.when(inspection != "completed", "INSPECTION_INCOMPLETE"),
        F.when(inspection.isNull() & cleaning.isNotNull(), "INSPECTION_INCOMPLETE"),
        F.when(F.col("guest_pets") > 0, "PET_DEPARTURE"),
    ]
    return board.withColumns(
        {
            "turnaround_hours": F.when(timed, rounded(exact_gap, 1)).otherwise(
                (gap * 24).cast("decimal(18,1)")
            ),
            "risk_flags": F.array_compact(F.array(*flags)),
            "housekeeping_status": F.coalesce(cleaning, F.lit("none")),
            "inspection_status": F.coalesce(inspection, F.lit("none")),
        }
    )


def turnover_board_order() -> list[Column]:
    """Check-out day, then number of the four pressing flags (none = last), region, property."""
    counted = ("NO_HOUSEKEEPING_TASK", "NO_CLEANER_ASSIGNED", "SAME_DAY_TURNAROUND", "PET_DEPARTURE")
    pressing = F.array(*[F.lit(flag) for flag in counted])
    hits = F.nullif(F.size(F.array_intersect("risk_flags", pressing)), F.lit(0))
    return [F.col("checkout_date").asc(), hits.desc_nulls_last(), F.col("region_code").asc(),
            F.col("property_name").asc()]


def inspection_compliance(
    tables: Tables, clock: Clock, window_days: int = 90, min_inspections: int = 3
) -> DataFrame:
    """Requirement and photo completion of inspections, per property and per inspector."""
    tasks = created_since(tables["tasks"], clock, window_days).where(department("inspection"))
    photo = F.col("photo_required")
    has_photos = ~F.col("photos").isin("[]", "null")
    # Requirements of the window's inspections shrink to one row per task, whatever the size of a task.
    per_task = (
        tables["task_requirements"]
        .join(tasks.select(F.col("id").alias("task_pk")), "task_pk", "left_semi")
        .groupBy("task_pk")
        .agg(
            count_all().alias("requirements"),
            F.count_if(F.col("response") != "").alias("answered"),
            F.count_if(photo).alias("photos_needed"),
            F.count_if(photo & has_photos).alias("photos_done"),
        )
    )
    sums = ("requirements", "answered", "photos_needed", "photos_done")
    inspections = (
        tasks.select(
            F.col("id").alias("task_pk"), "region_code", "property_pk", "task_status_stage",
            "finished_by_id", "finished_by_name",
        )
        .join(per_task, "task_pk", "left")
        .fillna(0, list(sums))
    )
    figures = [
        count_all().alias("total_inspections"),
        F.count_if(finished()).alias("completed_inspections"),
        F.sum("requirements").alias("total_requirements"),
        F.sum("answered").alias("completed_requirements"),
        percent(F.sum("answered"), F.sum("requirements")).alias("requirement_completion_rate"),
        F.sum("photos_needed").alias("total_photos_required"),
        F.sum("photos_done").alias("photos_completed"),
        percent(F.sum("photos_done"), F.sum("photos_needed")).alias("photo_compliance_rate"),
    ]
    properties = tables["properties"].select(F.col("id").alias("property_pk"), "property_name", "property_id")
    by_property = (
        inspections.where(F.col("property_pk").isNotNull())
        .groupBy("property_pk", "region_code")
        .agg(*figures)
        .join(properties, "property_pk")
        .withColumnsRenamed({"property_name": "entity_name", "property_id": "entity_id"})
        .withColumns({"entity_type": F.lit("property"), "performance_classification": F.lit(None).cast("string")})
    )
    answered, photographed = F.col("requirement_completion_rate"), F.col("photo_compliance_rate")
    by_inspector = (
        inspections.where(named_worker())
        .groupBy("finished_by_name", "finished_by_id", "region_code")
        .agg(*figures)
        .where(F.col("total_inspections") >= min_inspections)
        .withColumnsRenamed({"finished_by_name": "entity_name", "finished_by_id": "entity_id"})
        .withColumns(
            {
                "entity_type": F.lit("inspector"),
                "property_pk": F.lit(None).cast("bigint"),
                "performance_classification": F.when((answered >= 95) & (photographed >= 90), "Excellent")
                .when(answered >= 80, "Good")
                .when(answered >= 60, "Developing")
                .otherwise("Needs Improvement"),
            }
        )
    )
    return by_property.unionByName(by_inspector)


def sla_hours() -> Column:
    """Hours a task of this priority may take; NULL for an unknown or missing priority."""
    return case("type_priority", SLA_HOURS)


def department_sla_tracker(tables: Tables, clock: Clock) -> DataFrame:
    """Open tasks against their due times and the last week's compliance."""
    keys = ["region_code", "type_department"]
    age = micros_between(F.col("created_at"), clock.timestamp())
    due = sla_hours() * F.lit(MICROS_PER_HOUR)
    late, has_due = age > due, due.isNotNull()
    waiting = is_open()
    done = finished() & (F.col("finished_at") >= clock.days_ago(7))
    rate = F.coalesce("breach_rate", F.lit(0))
    # One scan serves the open tasks and the last week's.
    return (
        tables["tasks"]
        .where(waiting | done)
        .groupBy(*keys)
        .agg(
            F.count_if(waiting).alias("total_open"),
            F.count_if(waiting & (age <= due)).alias("compliant"),
            F.count_if(waiting & (age > due * 0.75) & (age <= due)).alias("warning"),
            F.count_if(waiting & late).alias("breached"),
            percent(F.count_if(waiting & late), F.count_if(waiting & has_due)).alias("breach_rate"),
            *[F.count_if(waiting & priority(p)).alias(f"{p}_open") for p in ("urgent", "high", "normal")],
            *[F.count_if(waiting & priority(p) & late).alias(f"{p}_breached") for p in ("urgent", "high", "normal")],
            F.count_if(done).alias("completions_7d"),
            percent(F.count_if(done & (total_micros() <= due)), F.count_if(done & has_due)).alias("sla_compliance_rate_7d"),
            rounded(avg_hours(total_micros(), done), 1).alias("avg_resolution_hours_7d"),
        )
        .where(F.col("total_open") > 0)
        .withColumn(
            "health_status",
            F.when(rate <= 5, "Healthy").when(rate <= 15, "At Risk").when(rate <= 30, "Degraded")
            .otherwise("Critical"),
        )
    )


def _alert(df: DataFrame, kind: str, severity: str, **columns: Column) -> DataFrame:
    order = ("region_code", "entity_id", "entity_name", "category", "alert_message", "alert_trigger_date")
    return df.select(
        F.lit(kind).alias("alert_type"), F.lit(severity).alias("severity"),
        *[columns[c].alias(c) for c in order],
    )


def operational_alerts(tables: Tables, clock: Clock) -> DataFrame:
    """Five alert rules in one list."""
    tasks, properties = tables["tasks"], tables["properties"]
    waiting = F.date_diff(clock.date(), F.col("created_at").cast("date"))
    region, text = F.col("region_code"), F.lit

    def waiting_alert(when: Column, kind: str, severity: str, words: str) -> Column:
        message = F.concat(text(words), waiting.cast("string"), text(" days"))
        return F.when(
            when, F.struct(text(kind).alias("alert_type"), text(severity).alias("severity"), message.alias("alert_message"))
        )

    # The kinds, severities, words and limits of the five rules.
    # A task can raise both alerts; one scan serves the two rules.
    idle = tasks.where(stage("new") & ((waiting > 7) | (priority("urgent") & (waiting > 1)))).select(
        "region_code", "task_id", "task_name", "type_department", "created_at",
        F.inline(
            F.array_compact(
                F.array(
                    waiting_alert(waiting > 7, "STALE_TASK", "High", "Task pending for "),
                    waiting_alert(
                        priority("urgent") & (waiting > 1), "URGENT_NOT_STARTED", "Critical",
                        "Urgent task not started for ",
                    ),
                )
            )
        ),
    )
    waiting_tasks = idle.select(
        "alert_type", "severity", "region_code", F.col("task_id").cast("string").alias("entity_id"),
        F.col("task_name").alias("entity_name"), F.col("type_department").alias("category"), "alert_message",
        F.col("created_at").alias("alert_trigger_date"),
    )
    # The other three rules count by property, or by worker: one more scan, stored, serves them all.
    week = F.col("finished_at") >= clock.days_ago(7)
    cleans = department("housekeeping") & finished() & (F.col("finished_at").cast("date") == clock.date())
    counted = durable(
        tasks.where(is_open() | week | cleans)
        .groupBy("property_pk", F.when(week, F.col("region_code")).alias("worked_in"), F.when(week, F.col("finished_by_id")).alias("worker"), week.alias("recent"))
        .agg(
            F.count_if(is_open()).alias("backlog"),
            F.max(F.when(is_open(), F.col("created_at"))).alias("latest"),
            F.count_if(cleans).alias("cleaned"),
            F.max(F.when(week, F.col("finished_at"))).alias("last_finish"),
        )
    )
    loaded = (
        counted.where((F.col("backlog") > 0) & F.col("property_pk").isNotNull())
        .groupBy("property_pk")
        .agg(F.sum("backlog").alias("backlog"), F.max("latest").alias("latest"))
        .join(properties.withColumnRenamed("id", "property_pk"), "property_pk")
        .groupBy("region_code", "property_id", "property_name")
        .agg(F.sum("backlog").alias("backlog"), F.max("latest").alias("latest"))
        .where(F.col("backlog") >= 5)
    )
    backlog = _alert(
        loaded, "HIGH_BACKLOG_PROPERTY", "Medium",
        region_code=region, entity_id=F.col("property_id").cast("string"), entity_name=F.col("property_name"),
        category=text("property"),
        alert_message=F.concat(text("Property has "), F.col("backlog").cast("string"), text(" tasks in backlog")),
        alert_trigger_date=F.col("latest"),
    )
    cleaned = counted.where(F.col("cleaned") > 0).select("property_pk")
    uncleaned = (
        tables["reservations"]
        .where((F.col("checkout_date") == clock.date()) & (F.col("reservation_status") == "active"))
        .join(
            properties.select(F.col("id").alias("property_pk"), "property_name"), "property_pk"
        )
        .join(cleaned, "property_pk", "left_anti")
    )
    checkout = _alert(
        uncleaned, "CHECKOUT_NO_CLEANING", "Critical",
        region_code=region, entity_id=F.col("reservation_id").cast("string"), entity_name=F.col("property_name"),
        category=text("housekeeping"),
        alert_message=text("Checkout today but no completed housekeeping task"),
        alert_trigger_date=F.col("checkout_date").cast("timestamp"),
    )
    quiet = (
        counted.where("recent")
        .groupBy(F.col("worked_in").alias("region_code"))
        .agg(F.count_distinct("worker").alias("workers"), F.max("last_finish").alias("latest"))
        .where(F.col("workers") < 3)
        .join(tables["regions"].select("region_code", "region_name"), "region_code", "left")
    )
    activity = _alert(
        quiet, "LOW_WORKER_ACTIVITY", "Medium",
        region_code=region, entity_id=region, entity_name=F.col("region_name"), category=text("workforce"),
        alert_message=F.concat(text("Only "), F.col("workers").cast("string"), text(" workers active in last 7 days")),
        alert_trigger_date=F.col("latest"),
    )
    return reduce(DataFrame.union, [waiting_tasks, backlog, checkout, activity])


def critical_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("severity") == "Critical").select("alert_type", "entity_name", "alert_message")


def upcoming_reservations(tables: Tables, clock: Clock, days: int = 30) -> DataFrame:
    """Reservations that arrive today or later and leave within the given days."""
    limit = F.date_add(clock.date(), days)
    return tables["reservations"].where(
        (F.col("checkin_date") >= clock.date()) & (F.col("checkout_date") <= limit)
    )


def tasks_by_department(tables: Tables, clock: Clock, first: date, last: date) -> DataFrame:
    """Tasks of every property scheduled in a date range, grouped by property and department.

    Grouping is by sorted adjacency, not by one array per group: rows of a group lie together in
    order and carry the group's size, so a group of any size stays spread over rows.
    """
    keys = ["property_pk", "type_department"]
    tasks = tables["tasks"].where(F.col("scheduled_date").between(F.lit(first), F.lit(last))).select(
        *keys, F.col("id").alias("task_pk"), "task_name", "scheduled_date"
    )
    sizes = tasks.groupBy(*keys).agg(count_all().alias("group_size"))
    return join_on(tasks, sizes, keys)


def data_quality_scorecard(tables: Tables, clock: Clock) -> DataFrame:
    """Completeness of five tables. Columns are positional and named after the first branch."""

    def branch(name: str, table: str, counts: list[Column], rates: tuple[tuple[Column, Column], ...]) -> DataFrame:
        columns = [count_all(), *counts] + [F.lit(0).cast("bigint")] * (8 - len(counts))
        names = (
            "total_records with_task_id with_task_name with_created_at with_finished_at"
            " with_started_at with_finished_by with_property_link with_reservation_link"
        ).split()
        return tables[table].agg(
            F.lit(name).alias("entity"),
            *[c.alias(n) for c, n in zip(columns, names, strict=True)],
            percent(*rates[0]).alias("pct_with_completer"),
            percent(*rates[1]).alias("pct_finished_with_start_time"),
        )

    def filled(*names: str) -> list[Column]:
        return [F.count(n) for n in names]

    active = F.count_if(F.col("active"))
    everything = count_all()
    branches = [
        branch(
            "tasks", "tasks",
            filled("task_id", "task_name", "created_at", "finished_at", "started_at", "finished_by_name",
                   "property_pk", "reservation_pk"),
            ((F.count("finished_by_name"), everything), (F.count("started_at"), F.count_if(finished()))),
        ),
        branch(
            "properties", "properties",
            filled("property_id", "property_name", "property_city", "latitude_numeric",
                   "longitude_numeric", "wifi_name"),
            ((F.count("latitude_numeric"), everything), (F.count("wifi_name"), everything)),
        ),
        branch(
            "reservations", "reservations",
            filled("reservation_id", "checkin_date", "checkout_date", "access_code", "guide_url", "property_pk"),
            ((F.count("access_code"), everything), (F.count("property_pk"), everything)),
        ),
        branch(
            "task_assignments", "task_assignments",
            filled("task_pk", "assignee_name", "assignee_id"),
            ((F.count("assignee_name"), everything), (F.count("assignee_id"), everything)),
        ),
        branch(
            "people", "people",
            [*filled("person_id", "person_name"), active, *filled("availability_monday", "availability_tuesday")],
            ((active, everything), (F.count("availability_monday"), everything)),
        ),
    ]
    return reduce(DataFrame.union, branches)
