"""View rules that the oracle data does not reach, on small hand-made tables."""

from datetime import date, datetime

import pytest

from fieldstay.functions.times import Clock
from fieldstay.plans import boards, properties, regions, registry, trends, workers

CLOCK = Clock(datetime(2025, 3, 12, 12, 0))
TASK = ("id long, task_id string, task_name string, property_pk long, region_code string, created_at timestamp, task_status_stage string,"
        " type_priority string, type_department string, started_at timestamp, finished_at timestamp, finished_by_id string,"
        " finished_by_name string, scheduled_date date, checkout_date date, reservation_pk long, rate_paid decimal(15,2)")
RESERVATION = ("id long, reservation_id string, property_pk long, region_code string, checkin_date date, checkin_time string,"
               " checkout_date date, checkout_time string, reservation_status string, pets int")
PROPERTY = "id long, property_id string, property_name string, region_code string, property_city string, property_status string"


def task(i, **over):
    base = dict(
        id=i, task_id=str(i), task_name=f"T{i}", property_pk=1, region_code="n", created_at=datetime(2025, 3, 1), task_status_stage="new",
        type_priority="normal", type_department="housekeeping", started_at=None, finished_at=None, finished_by_id=None, finished_by_name=None,
        scheduled_date=None, checkout_date=None, reservation_pk=None, rate_paid=None)
    return tuple({**base, **over}.values())


def stay(i, checkin, checkout, **over):
    base = dict(id=i, reservation_id=str(i), property_pk=1, region_code="n", checkin_date=checkin, checkin_time="15:00",
                checkout_date=checkout, checkout_time="11:00", reservation_status="active", pets=0)
    return tuple({**base, **over}.values())


@pytest.fixture
def tables(rows):
    def build(tasks=(), reservations=(), assignments=(), n_properties=1):
        houses = [(i, f"p{i}", f"House {i}", "n", "Town", "active") for i in range(1, n_properties + 1)]
        return {
            "tasks": rows(TASK, *tasks),
            "reservations": rows(RESERVATION, *reservations),
            "properties": rows(PROPERTY, *houses),
            "regions": rows("region_code string, region_name string, is_active boolean", ("n", "North", True), ("off", "Off", False)),
            "task_assignments": rows("task_pk long, assignee_id string, assignee_name string", *assignments),
        }

    return build


def test_status_skips_the_middle_turnaround_step(tables):
    """A property a little slower than its region scores 60 for speed but is graded with 40."""

    def done(i, pk, hours):
        return task(i, property_pk=pk, task_status_stage="finished", finished_at=datetime(2025, 3, 1 + hours // 24, hours % 24))

    t = tables([done(1, 1, 10), done(2, 2, 10), done(3, 3, 14)], n_properties=3)
    got = {r.property_pk: r for r in properties.property_operational_health(t, CLOCK).collect()}
    assert (got[3].turnaround_score, float(got[3].health_score)) == (60, 94.0)
    t = tables([done(1, 1, 10), done(2, 2, 10), done(3, 3, 14), *[task(i, property_pk=3) for i in range(4, 5)],
                task(9, property_pk=3, type_priority="urgent")], n_properties=3)
    row = next(r for r in properties.property_operational_health(t, CLOCK).collect() if r.property_pk == 3)
    # 20 + .35 * 33.3 + 17.5 + 9 = 58.2 by score, 55.2 by grade
    assert (float(row.health_score), row.health_status) == (58.2, "Fair")


def test_property_without_tasks(tables):
    (row,) = properties.property_operational_health(tables(), CLOCK).collect()
    assert (row.tasks_90d, row.completion_rate, float(row.completion_score), row.turnaround_score) == (0, None, 50.0, 50)
    (row,) = properties.property_dashboard(tables(), CLOCK).collect()
    assert (row.total_tasks_all_time, float(row.maintenance_total_rate_paid), row.global_task_rank) == (0, 0.0, 1)


def test_turnover_flags_and_order(tables):
    today, tomorrow = date(2025, 3, 12), date(2025, 3, 13)
    t = tables(
        tasks=[
            task(1, property_pk=1, checkout_date=today, task_status_stage="finished", finished_by_name="Kim"),
            task(2, property_pk=1, checkout_date=today, task_status_stage="in_progress"),
            task(3, property_pk=2, checkout_date=today), task(4, property_pk=3, checkout_date=today),
            task(5, property_pk=1, checkout_date=today, type_department="inspection", task_status_stage="finished"),
        ],
        reservations=[
            stay(1, date(2025, 3, 1), today), stay(2, date(2025, 3, 1), today, property_pk=2, pets=2),
            stay(3, date(2025, 3, 1), today, property_pk=3), stay(4, date(2025, 3, 1), tomorrow, property_pk=4, checkout_time=None),
            stay(5, today, date(2025, 3, 20), property_pk=2), stay(6, tomorrow, date(2025, 3, 20), property_pk=1),
            stay(7, date(2025, 3, 14), date(2025, 3, 20), property_pk=4), stay(8, today, today, property_pk=1, reservation_status="cancelled"),
        ],
        assignments=[(4, "9", "Lee"), (4, "10", "Ann")],
        n_properties=4,
    )
    board = registry.present("daily_turnover_board", t, CLOCK).collect()
    got = {r.property_pk: r for r in board}
    assert [r.property_pk for r in board] == [2, 1, 3, 4]
    assert got[1].risk_flags == ["TIGHT_TURNAROUND"] and got[1].housekeeping_finished_by == "Kim"
    assert got[2].risk_flags == ["NO_CLEANER_ASSIGNED", "SAME_DAY_TURNAROUND", "INSPECTION_INCOMPLETE", "PET_DEPARTURE"]
    assert (got[3].housekeeping_status, got[3].inspection_status, got[3].turnaround_hours) == ("assigned", "none", None)
    assert got[4].risk_flags == ["NO_HOUSEKEEPING_TASK", "TIGHT_TURNAROUND"]
    assert (float(got[1].turnaround_hours), float(got[2].turnaround_hours), float(got[4].turnaround_hours)) == (28.0, 4.0, 24.0)


def test_sla_null_priority_and_bands(tables):
    t = tables([
        task(1, type_priority=None), task(2, type_priority="urgent", created_at=datetime(2025, 3, 12, 8, 30)),
        task(3, type_priority="urgent", created_at=datetime(2025, 3, 12, 7, 59)),
        task(4, type_priority="low", created_at=datetime(2025, 3, 12)),
    ])
    (row,) = boards.department_sla_tracker(t, CLOCK).collect()
    assert (row.total_open, row.compliant, row.warning, row.breached, float(row.breach_rate)) == (4, 2, 1, 1, 33.3)
    assert row.health_status == "Critical" and row.completions_7d == 0


def test_backlog_ages(tables):
    t = tables([task(i, created_at=datetime(2025, 3, 12 - a) if a < 12 else datetime(2025, 2, 1)) for i, a in enumerate((0, 1, 2, 7, 8, 40))])
    (row,) = regions.task_backlog_aging(t, CLOCK).collect()
    assert (row.age_0_1_days, row.age_2_3_days, row.age_4_7_days, row.age_8_14_days, row.age_15_30_days, row.age_over_30_days) == (2, 1, 1, 1, 0, 1)


def test_alerts(tables):
    t = tables(
        [task(1, created_at=datetime(2025, 3, 1), type_priority="urgent"), task(2, created_at=datetime(2025, 3, 10), type_priority="urgent"),
         *[task(10 + i, task_status_stage="in_progress", created_at=datetime(2025, 3, 11)) for i in range(3)],
         task(20, task_status_stage="finished", finished_at=datetime(2025, 3, 11), finished_by_id="w")],
        [stay(1, date(2025, 3, 1), date(2025, 3, 12))],
    )
    got = registry.present("operational_alerts", t, CLOCK).collect()
    assert sorted(r.alert_type for r in got) == [
        "CHECKOUT_NO_CLEANING", "HIGH_BACKLOG_PROPERTY", "LOW_WORKER_ACTIVITY", "STALE_TASK", "URGENT_NOT_STARTED", "URGENT_NOT_STARTED"
    ]
    assert [r.severity for r in got] == ["Critical"] * 3 + ["High"] + ["Medium"] * 2
    assert {r.alert_message for r in got if r.alert_type == "STALE_TASK"} == {"Task pending for 11 days"}
    cleaned = tables([task(1, task_status_stage="finished", finished_at=datetime(2025, 3, 12, 9))], [stay(1, date(2025, 3, 1), date(2025, 3, 12))])
    assert "CHECKOUT_NO_CLEANING" not in {r.alert_type for r in boards.operational_alerts(cleaned, CLOCK).collect()}


def test_leaderboard_threshold_and_single_value_spread(tables):
    def done(i, who):
        return task(i, task_status_stage="finished", finished_by_id=who, finished_by_name=who and f"W{who}",
                    started_at=datetime(2025, 3, 2, 10), finished_at=datetime(2025, 3, 2, 10, 30 + i % 2))

    t = tables([*[done(i, "1") for i in range(5)], *[done(i, "2") for i in range(10, 14)], done(20, None), done(21, "")])
    (row,) = workers.worker_leaderboard_housekeeping(t, CLOCK).collect()
    assert (row.worker_id, row.tasks_completed_90d, float(row.median_minutes_active), row.global_rank) == ("1", 5, 30.0, 1)
    (one,) = workers.worker_leaderboard_housekeeping(tables([done(1, "1")]), CLOCK, min_tasks=1).collect()
    assert one.stddev_minutes_active is None and float(one.tasks_per_day) == 1.0


def test_month_names_are_padded(tables):
    (row,) = trends.seasonal_demand_patterns(tables([task(1, created_at=datetime(2025, 3, 9))]), CLOCK).collect()
    assert (row.month_name, row.day_of_week, row.day_name) == ("March    ", 0, "Sunday   ")


def test_inactive_region_is_left_out(tables):
    assert [r.region_code for r in regions.regional_dashboard(tables(), CLOCK).collect()] == ["n"]


def test_refresh_writes_and_overwrites(tables, tmp_path):
    t = tables([task(1)])
    names = ["task_completion_metrics", "weekly_operational_snapshot"]
    for _ in range(2):
        out = registry.refresh_all(t, CLOCK, str(tmp_path), names)
    assert {n: df.count() for n, df in out.items()} == dict.fromkeys(names, 1)
    assert out["task_completion_metrics"].first()["refreshed_at"] == CLOCK.now


def test_months_ago_and_week_start():
    assert Clock(datetime(2025, 3, 12)).week_start() == date(2025, 3, 10)
