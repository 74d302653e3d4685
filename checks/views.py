"""Dashboard views V1-V32 with their statements. The clock is 2001-07-15 12:00 UTC."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.binding import CLOCK, Domain
from checks.registry import ORACLES, big, check, cnt, contents, contents_sql, div, pct, rnd, stamp, text
from fieldstay.plans import boards, properties, regions, registry, trends, workers
from fieldstay.plans.common import LAST
from fieldstay.session import scratch_path
from fieldstay.sources.snapshot import SnapshotStore
from fieldstay.sources.stored import StoredTables

HOURS, MINUTES = "3600000000.0::DOUBLE", "60000000.0::DOUBLE"
DONE, OPEN = "task_status_stage = 'finished'", "task_status_stage IN ('new', 'in_progress')"
PRESSING = "type_priority IN ('urgent', 'high')"
WINDOW = 720  # enough for the per-worker thresholds at small scale


def ago(days: int) -> str:
    return f"TIMESTAMP '2001-07-15' - INTERVAL {days} DAY"


def dept(d: str) -> str:
    return f"type_department = '{d}'"


def avg_h(expr: str = f"CASE WHEN {DONE} THEN us_total END") -> str:
    return rnd(f"avg({expr}) / {HOURS}")


def avg_m(expr: str = "us_active") -> str:
    return rnd(f"avg({expr}) / {MINUTES}")


D30, D90 = f"created_at >= {ago(30)}", f"created_at >= {ago(90)}"

check("portfolio_executive_summary", lambda d: regions.portfolio_executive_summary(d, CLOCK),
      "regions properties tasks reservations", f"""
WITH t AS (
  SELECT {cnt(DONE + " AND finished_at >= " + ago(30))} AS done30, {cnt(D30)} AS made30,
         count(DISTINCT finished_by_id) AS workers, {cnt("task_status_stage = 'new'")} AS fresh,
         {cnt("task_status_stage = 'in_progress'")} AS going,
         {avg_h(f"CASE WHEN {DONE} AND finished_at >= {ago(30)} THEN us_total END")} AS hours,
         {cnt("task_status_stage = 'new' AND " + dept("housekeeping"))} AS h,
         {cnt("task_status_stage = 'new' AND " + dept("inspection"))} AS i,
         {cnt("task_status_stage = 'new' AND " + dept("maintenance"))} AS m
  FROM tasks),
r AS (
  SELECT {cnt("checkin_date >= DATE '2001-07-15'")} AS upcoming, {cnt("checkin_date = DATE '2001-07-15'")} AS arriving,
         {cnt("checkout_date = DATE '2001-07-15'")} AS leaving
  FROM reservations WHERE reservation_status = 'active')
SELECT (SELECT count(*) FROM properties WHERE property_status = 'active') AS total_properties,
       (SELECT count(*) FROM regions WHERE is_active) AS total_regions,
       workers AS total_active_workers, made30 AS tasks_last_30_days, done30 AS completed_last_30_days,
       fresh AS current_backlog, going AS in_progress, {pct("done30", "made30")} AS completion_rate_30d_pct,
       hours AS avg_turnaround_hours_30d, upcoming AS upcoming_reservations, arriving AS checkins_today,
       leaving AS checkouts_today, h AS housekeeping_backlog, i AS inspection_backlog, m AS maintenance_backlog
FROM t, r""")

SCORE_CTES = f"""
rt AS (
  SELECT region_code, count(*) AS n, {cnt(DONE)} AS done, {cnt("task_status_stage = 'new'")} AS fresh,
         {cnt("task_status_stage = 'in_progress'")} AS going, {avg_h()} AS hrs,
         {avg_m(f"CASE WHEN {DONE} THEN us_active END")} AS mins, count(DISTINCT finished_by_id) AS workers
  FROM tasks WHERE {D90} GROUP BY 1),
rp AS (SELECT region_code, count(*) AS n FROM properties WHERE property_status = 'active' GROUP BY 1),
rr AS (SELECT region_code, count(*) AS n, {cnt("checkin_date >= DATE '2001-07-15'")} AS upcoming
       FROM reservations WHERE reservation_status = 'active' GROUP BY 1)"""
SCORE_COLS = f"""
r.region_code, r.region_name, coalesce(rp.n, 0) AS properties, coalesce(rt.n, 0) AS tasks_90d,
coalesce(rt.done, 0) AS completed_90d, coalesce(rt.fresh, 0) AS current_backlog,
{pct("coalesce(rt.done, 0)", "coalesce(rt.n, 0)")} AS completion_rate_pct, rt.hrs AS avg_hours_to_complete,
rt.mins AS avg_minutes_active_work, coalesce(rt.workers, 0) AS active_workers, coalesce(rr.n, 0) AS reservations,
coalesce(rr.upcoming, 0) AS upcoming_reservations,
{div("coalesce(rt.n, 0)", "coalesce(rp.n, 0)")} AS tasks_per_property_90d"""
SCORE_FROM = "FROM regions r LEFT JOIN rt USING (region_code) LEFT JOIN rp USING (region_code) LEFT JOIN rr USING (region_code)"

SCORECARD_SQL = f"WITH {SCORE_CTES.strip()}\nSELECT {SCORE_COLS} {SCORE_FROM} WHERE is_active"
check("regional_performance_scorecard", lambda d: regions.regional_performance_scorecard(d, CLOCK),
      "regions properties tasks reservations", SCORECARD_SQL)


def leaderboard_sql(d: str) -> str:
    spread = "" if d == "maintenance" else f"""
       {rnd(f"quantile_cont(us_active, 0.5) / {MINUTES}")} AS median_minutes_active,
       {rnd(f"stddev_samp(us_active / {MINUTES})")} AS stddev_minutes_active,
       {big("date_diff('day', min(finished_at)::DATE, max(finished_at)::DATE)")} AS active_days_span,"""
    mix = "" if d != "maintenance" else f"""
       {cnt("type_priority = 'urgent'")} AS urgent_tasks_90d, {cnt("type_priority = 'high'")} AS high_priority_tasks_90d,
       {cnt("type_priority = 'normal'")} AS normal_tasks_90d,
       {avg_h("CASE WHEN type_priority = 'urgent' THEN us_total END")} AS avg_urgent_response_hours,"""
    return f"""
WITH w AS (
  SELECT finished_by_name AS worker_name, finished_by_id AS worker_id, region_code,
       count(*) AS tasks_completed_90d, {cnt("finished_at >= " + ago(30))} AS tasks_completed_30d,
       {cnt("finished_at >= " + ago(7))} AS tasks_completed_7d,{spread}{mix}
       {avg_m()} AS avg_minutes_active, {avg_h("us_total")} AS avg_hours_total_turnaround,
       {text("min(finished_at)::DATE")} AS first_task_date, {text("max(finished_at)::DATE")} AS last_task_date,
       {div("count(*)", "greatest(date_diff('day', min(finished_at)::DATE, max(finished_at)::DATE), 1)", 2)} AS tasks_per_day
  FROM tasks WHERE {dept(d)} AND {DONE} AND finished_by_name <> '' AND finished_at >= {ago(WINDOW)}
  GROUP BY ALL HAVING count(*) >= 5)
SELECT *, dense_rank() OVER (PARTITION BY region_code ORDER BY tasks_completed_90d DESC) AS regional_rank,
       dense_rank() OVER (ORDER BY tasks_completed_90d DESC) AS global_rank FROM w"""


BOARDS = {
    "housekeeping": workers.worker_leaderboard_housekeeping,
    "inspection": workers.worker_leaderboard_inspection,
    "maintenance": workers.worker_leaderboard_maintenance,
}
for _d, _view in BOARDS.items():
    check(f"worker_leaderboard_{_d}", lambda d, v=_view: v(d, CLOCK, window_days=WINDOW), "tasks", leaderboard_sql(_d))

check("task_completion_metrics", lambda d: regions.task_completion_metrics(d, CLOCK), "tasks", f"""
SELECT region_code, type_department, count(*) AS total_tasks_90d, {cnt(DONE)} AS completed_90d,
       {cnt("task_status_stage = 'new'")} AS pending, {cnt("task_status_stage = 'in_progress'")} AS in_progress,
       {pct(cnt(DONE), "count(*)")} AS completion_rate_pct, {avg_h()} AS avg_hours_to_complete,
       {rnd(f"quantile_cont(CASE WHEN {DONE} THEN us_total END, 0.5) / {HOURS}")} AS median_hours_to_complete,
       {rnd(f"quantile_cont(CASE WHEN {DONE} THEN us_total END, 0.9) / {HOURS}")} AS p90_hours_to_complete,
       {avg_m(f"CASE WHEN {DONE} THEN us_active END")} AS avg_minutes_active_work,
       {cnt(DONE + " AND finished_at::DATE = created_at::DATE")} AS same_day_completions,
       {pct(cnt(DONE + " AND finished_at::DATE = created_at::DATE"), cnt(DONE))} AS same_day_rate_pct,
       count(DISTINCT finished_by_id) AS unique_workers
FROM tasks WHERE {D90} GROUP BY 1, 2""")


def buckets(prefix: str, suffix: str) -> str:
    parts = [("0_1", "age_days <= 1"), ("2_3", "age_days BETWEEN 2 AND 3"), ("4_7", "age_days BETWEEN 4 AND 7"),
             ("8_14", "age_days BETWEEN 8 AND 14"), ("15_30", "age_days BETWEEN 15 AND 30"), ("over_30", "age_days > 30")]
    return ", ".join(f"{cnt(c)} AS {prefix}{n}{suffix}" for n, c in parts)


check("task_backlog_aging", lambda d: regions.task_backlog_aging(d, CLOCK), "tasks", f"""
SELECT region_code, type_department, type_priority, {buckets("age_", "_days")}, count(*) AS total_backlog,
       {rnd("avg(age_days)")} AS avg_age_days, max(age_days) AS max_age_days, {stamp("min(created_at)")} AS oldest_task_created
FROM tasks WHERE {OPEN} GROUP BY 1, 2, 3""")

DENSITY = f"""
count(t.id) AS total_tasks_all_time, {cnt(D90)} AS tasks_90d, {cnt(D30)} AS tasks_30d, {cnt("created_at >= " + ago(7))} AS tasks_7d,
{", ".join(f"{cnt(dept(x) + ' AND ' + D90)} AS {x}_tasks_90d" for x in BOARDS)},
{cnt(PRESSING + " AND " + D90)} AS urgent_high_tasks_90d, {cnt(OPEN)} AS current_backlog, {avg_h()} AS avg_hours_to_complete,
(SELECT count(*) FROM reservations r WHERE r.property_pk = p.id AND r.reservation_status = 'active') AS active_reservations"""
IDENT = "p.id AS property_pk, p.property_id, p.property_name, p.region_code, p.property_city"
FROM_P = """FROM properties p LEFT JOIN tasks t ON t.property_pk = p.id WHERE p.property_status = 'active'
  GROUP BY p.id, p.property_id, p.property_name, p.region_code, p.property_city"""
VOLUME_RANKS = """dense_rank() OVER (PARTITION BY region_code ORDER BY total_tasks_all_time DESC) AS regional_task_rank,
       dense_rank() OVER (ORDER BY total_tasks_all_time DESC) AS global_task_rank"""

check("property_task_density", lambda d: properties.property_task_density(d, CLOCK),
      "properties tasks reservations",
      f"WITH b AS (SELECT {IDENT}, {DENSITY} {FROM_P}) SELECT *, {VOLUME_RANKS} FROM b")


def health(b: str) -> str:
    urgency = "(CASE WHEN urgent_backlog = 0 THEN 100 WHEN urgent_backlog <= 2 THEN 70 ELSE 40 END)"
    near = "raw <= coalesce(mean, 200)"
    fine = f"(CASE WHEN raw IS NULL THEN 50 WHEN {near} THEN 80 WHEN raw <= coalesce(mean, 200) * 1.5::DOUBLE THEN 60 ELSE 40 END)"
    coarse = f"(CASE WHEN raw IS NULL THEN 50 WHEN {near} THEN 80 ELSE 40 END)"
    rate = "CAST(coalesce(completion_rate, 50) AS DECIMAL(10, 1))"

    def total(turn: str) -> str:
        return f"(greatest(0, 100 - {b} * 10) * 0.25 + {rate} * 0.35 + {urgency} * 0.25 + {turn} * 0.15)"

    return f"""{rnd("raw")} AS avg_turnaround_hours, {big(f"greatest(0, 100 - {b} * 10)")} AS backlog_score,
       CAST(coalesce(completion_rate, 50) AS DOUBLE) AS completion_score, {big(urgency)} AS urgency_score,
       {big(fine)} AS turnaround_score, {rnd(total(fine))} AS health_score,
       CASE WHEN {total(coarse)} >= 80 THEN 'Excellent' WHEN {total(coarse)} >= 65 THEN 'Good'
            WHEN {total(coarse)} >= 50 THEN 'Fair' ELSE 'Needs Attention' END AS health_status"""


HEALTH_IN = f"""{cnt(PRESSING + " AND " + OPEN)} AS urgent_backlog, {pct(cnt(DONE + " AND " + D90), cnt(D90))} AS completion_rate,
  avg(CASE WHEN {DONE} THEN us_total END) / {HOURS} AS raw"""
HEALTH_SQL = f"""
WITH b AS (SELECT p.id AS property_pk, p.property_id, p.property_name, p.region_code, {cnt(D90)} AS tasks_90d, {cnt(OPEN)} AS backlog,
  {HEALTH_IN} {FROM_P}),
g AS (SELECT region_code, avg(raw) AS mean FROM b GROUP BY 1)
SELECT b.* EXCLUDE (raw), {health("backlog")} FROM b LEFT JOIN g USING (region_code)"""
check("property_operational_health", lambda d: properties.property_operational_health(d, CLOCK), "properties tasks", HEALTH_SQL)

check("reservation_turnaround_analysis", lambda d: trends.reservation_turnaround_analysis(d, CLOCK), "reservations tasks", f"""
SELECT r.region_code, {text("date_trunc('week', r.checkout_date)::DATE")} AS week_of, count(DISTINCT r.id) AS reservations,
       count(t.id) AS linked_tasks, {cnt(dept("housekeeping"))} AS housekeeping_tasks, {cnt(dept("inspection"))} AS inspection_tasks,
       {cnt(DONE)} AS completed_tasks, {pct(cnt(DONE), "count(t.id)")} AS task_completion_rate, {avg_h()} AS avg_hours_turnaround
FROM reservations r LEFT JOIN tasks t ON t.reservation_pk = r.id
WHERE r.reservation_status = 'active' AND r.checkout_date >= {ago(90)} GROUP BY 1, 2""")

check("monthly_trend_analysis", lambda d: trends.monthly_trend_analysis(d, CLOCK), "tasks", f"""
WITH m AS (
  SELECT date_trunc('month', created_at)::DATE AS month, region_code, type_department, count(*) AS tasks_created,
       {cnt(DONE)} AS tasks_completed, {pct(cnt(DONE), "count(*)")} AS completion_rate, {avg_h()} AS avg_hours_to_complete,
       {cnt("type_priority = 'urgent'")} AS urgent_tasks, {cnt("type_priority = 'high'")} AS high_priority_tasks,
       count(DISTINCT finished_by_id) AS unique_workers
  FROM tasks WHERE created_at >= TIMESTAMP '2000-07-15' GROUP BY 1, 2, 3)
SELECT * REPLACE ({text("month")} AS month),
       lag(tasks_created) OVER (PARTITION BY region_code, type_department ORDER BY m.month) AS prev_month_tasks FROM m""")

MONDAY = "TIMESTAMP '2001-07-09'"
check("weekly_operational_snapshot", lambda d: trends.weekly_operational_snapshot(d, CLOCK), "tasks", f"""
SELECT '2001-07-09' AS week_start, region_code, {cnt(f"created_at >= {MONDAY}")} AS tasks_created_this_week,
       {cnt(f"finished_at >= {MONDAY}")} AS tasks_completed_this_week,
       {cnt(f"created_at >= {MONDAY} - INTERVAL 7 DAY AND created_at < {MONDAY}")} AS tasks_created_last_week,
       {cnt(f"finished_at >= {MONDAY} - INTERVAL 7 DAY AND finished_at < {MONDAY}")} AS tasks_completed_last_week,
       {cnt(OPEN)} AS current_backlog, {cnt(OPEN + " AND " + PRESSING)} AS urgent_high_backlog,
       {", ".join(f"{cnt(dept(x) + f' AND created_at >= {MONDAY}')} AS {x}_this_week" for x in BOARDS)},
       count(DISTINCT finished_by_id) FILTER (WHERE finished_at >= {MONDAY}) AS active_workers_this_week
FROM tasks GROUP BY 2""")

check("priority_response_times", lambda d: regions.priority_response_times(d, CLOCK), "tasks", f"""
SELECT region_code, type_department, type_priority, count(*) AS total_tasks_90d, {cnt(DONE)} AS completed,
       {avg_h("us_start")} AS avg_hours_to_start, {rnd(f"quantile_cont(us_start, 0.5) / {HOURS}")} AS median_hours_to_start,
       {avg_h()} AS avg_hours_to_resolve,
       {rnd(f"quantile_cont(us_total, 0.5) FILTER (WHERE {DONE}) / {HOURS}")} AS median_hours_to_resolve,
       {rnd(f"quantile_cont(us_total, 0.9) FILTER (WHERE {DONE}) / {HOURS}")} AS p90_hours_to_resolve,
       {cnt(f"{DONE} AND us_total / {HOURS} <= 24")} AS resolved_within_24h, {cnt(f"{DONE} AND us_total / {HOURS} <= 48")} AS resolved_within_48h
FROM tasks WHERE {D90} GROUP BY 1, 2, 3""")

check("task_tags_analysis", lambda d: trends.task_tags_analysis(d, CLOCK), "tags task_tags tasks", f"""
SELECT g.tag_name, g.region_code, count(b.task_pk) AS tagged_tasks_all_time, {cnt(D90)} AS tagged_tasks_90d,
       {", ".join(f"{cnt(dept(x))} AS {x}_tasks" for x in BOARDS)}, {cnt(DONE)} AS completed_tasks,
       {pct(cnt(DONE), "count(b.task_pk)")} AS completion_rate, {avg_h()} AS avg_hours_to_complete
FROM tags g LEFT JOIN task_tags b ON g.id = b.tag_pk LEFT JOIN tasks t ON b.task_pk = t.id
GROUP BY 1, 2 HAVING count(b.task_pk) > 0""")

check("worker_efficiency_ranking", lambda d: workers.worker_efficiency_ranking(d, CLOCK, window_days=WINDOW), "tasks", f"""
WITH w AS (
  SELECT finished_by_name AS worker_name, finished_by_id AS worker_id, region_code,
       count(DISTINCT type_department) AS departments_worked, count(*) AS total_tasks_90d,
       {", ".join(f"{cnt(dept(x))} AS {x}_count" for x in BOARDS)}, {cnt(PRESSING)} AS urgent_high_tasks,
       avg(us_active) / {MINUTES} AS mean, {avg_h("us_total")} AS avg_hours_total,
       {rnd(f"stddev_samp(us_active / {MINUTES})")} AS consistency_stddev,
       {big("date_diff('day', min(finished_at)::DATE, max(finished_at)::DATE)")} AS days_active
  FROM tasks WHERE {DONE} AND finished_by_name <> '' AND finished_at >= {ago(WINDOW)}
  GROUP BY 1, 2, 3 HAVING count(*) >= 10)
SELECT * EXCLUDE (mean), {rnd("mean")} AS avg_minutes_active, {div("total_tasks_90d", "greatest(days_active, 1)", 2)} AS tasks_per_day,
       {rnd("100 / (1 + coalesce(mean, 60) / 60)")} AS efficiency_score,
       {big("CASE departments_worked WHEN 3 THEN 100 WHEN 2 THEN 70 ELSE 40 END")} AS versatility_score,
       dense_rank() OVER (ORDER BY total_tasks_90d DESC) AS volume_rank,
       dense_rank() OVER (ORDER BY mean ASC NULLS LAST) AS speed_rank FROM w""")

WORKLOAD_CTES = f"""
dy AS (SELECT region_code, created_at::DATE AS task_date, count(*) AS made, {cnt(DONE)} AS done FROM tasks WHERE {D30} GROUP BY 1, 2),
ws AS (SELECT region_code, avg(made) AS daily, {rnd("avg(made)")} AS avg_daily_tasks_created, {rnd("avg(done)")} AS avg_daily_tasks_completed,
       max(made) AS peak_daily_tasks, {rnd("stddev_samp(made)")} AS stddev_daily_tasks,
       {text("arg_min(task_date, (-made, task_date))")} AS busiest_day FROM dy GROUP BY 1)"""
check("regional_workload_distribution", lambda d: regions.regional_workload_distribution(d, CLOCK), "properties tasks", f"""
WITH {WORKLOAD_CTES.strip()},
p AS (SELECT region_code, count(*) AS n FROM properties WHERE property_status = 'active' GROUP BY 1),
k AS (SELECT region_code, count(DISTINCT finished_by_id) AS n FROM tasks WHERE finished_at >= {ago(30)} GROUP BY 1)
SELECT ws.* EXCLUDE (daily), coalesce(p.n, 0) AS property_count, coalesce(k.n, 0) AS active_workers_30d,
       {div("daily", "p.n", 2)} AS tasks_per_property_per_day, {div("daily", "k.n", 2)} AS tasks_per_worker_per_day
FROM ws LEFT JOIN p USING (region_code) LEFT JOIN k USING (region_code)""")

check("seasonal_demand_patterns", lambda d: trends.seasonal_demand_patterns(d, CLOCK), "tasks", f"""
SELECT region_code, month(created_at) AS month_num, rpad(monthname(created_at), 9, ' ') AS month_name,
       dayofweek(created_at) AS day_of_week, rpad(dayname(created_at), 9, ' ') AS day_name, count(*) AS total_tasks,
       {", ".join(f"{cnt(dept(x))} AS {x}" for x in BOARDS)}, count(reservation_pk) AS reservation_linked,
       {cnt(PRESSING)} AS urgent_high_priority
FROM tasks WHERE created_at >= TIMESTAMP '2000-07-15' GROUP BY 1, 2, 3, 4, 5""")


def burden(where: str, prefix: str, hours: str, recency: str, paid: str) -> str:
    extra = f"{where} AND " if where else ""
    q, m = cnt(extra + D90), cnt(extra + D30)
    case = f"CASE WHEN {extra}{DONE} THEN us_total END"
    return f"""{cnt(where or "t.id IS NOT NULL")} AS total_maintenance_tasks, {q} AS maintenance_90d, {m} AS maintenance_30d,
  {cnt(extra + "type_priority = 'urgent'")} AS {prefix}urgent_tasks, {cnt(extra + "type_priority = 'high'")} AS {prefix}high_priority_tasks,
  {cnt(extra + OPEN)} AS maintenance_backlog, {avg_h(case)} AS {hours}, {div(m, f"({q} / 3.0::DOUBLE)", 2)} AS {recency},
  CAST(coalesce(sum(rate_paid){f" FILTER (WHERE {where})" if where else ""}, 0) AS DOUBLE) AS {paid}"""


check("property_maintenance_burden", lambda d: properties.property_maintenance_burden(d, CLOCK), "properties tasks", f"""
WITH b AS (SELECT {IDENT}, {burden("", "", "avg_hours_to_resolve", "recency_ratio", "total_rate_paid")}
  FROM properties p JOIN tasks t ON t.property_pk = p.id AND {dept("maintenance")} WHERE p.property_status = 'active'
  GROUP BY p.id, p.property_id, p.property_name, p.region_code, p.property_city)
SELECT *, dense_rank() OVER (PARTITION BY region_code ORDER BY total_maintenance_tasks DESC) AS regional_maintenance_rank FROM b""")

QUALITY = [
    ("tasks", ["task_id", "task_name", "created_at", "finished_at", "started_at", "finished_by_name", "property_pk", "reservation_pk"],
     ("count(finished_by_name)", "count(*)"), ("count(started_at)", cnt(DONE))),
    ("properties", ["property_id", "property_name", "property_city", "latitude_numeric", "longitude_numeric", "wifi_name"],
     ("count(latitude_numeric)", "count(*)"), ("count(wifi_name)", "count(*)")),
    ("reservations", ["reservation_id", "checkin_date", "checkout_date", "access_code", "guide_url", "property_pk"],
     ("count(access_code)", "count(*)"), ("count(property_pk)", "count(*)")),
    ("task_assignments", ["task_pk", "assignee_name", "assignee_id"],
     ("count(assignee_name)", "count(*)"), ("count(assignee_id)", "count(*)")),
    ("people", ["person_id", "person_name", "CASE WHEN active THEN 1 END", "availability_monday", "availability_tuesday"],
     (cnt("active"), "count(*)"), ("count(availability_monday)", "count(*)")),
]
QUALITY_NAMES = ("with_task_id with_task_name with_created_at with_finished_at with_started_at with_finished_by"
                 " with_property_link with_reservation_link").split()


def quality_branch(t, cols, first, second) -> str:
    counts = [f"count({c})" for c in cols] + ["CAST(0 AS BIGINT)"] * (8 - len(cols))
    named = ", ".join(f"{c} AS {n}" for c, n in zip(counts, QUALITY_NAMES, strict=True))
    return (f"SELECT '{t}' AS entity, count(*) AS total_records, {named}, {pct(*first)} AS pct_with_completer,"
            f" {pct(*second)} AS pct_finished_with_start_time FROM {t}")


check("data_quality_scorecard", lambda d: boards.data_quality_scorecard(d, CLOCK),
      "tasks properties reservations task_assignments people",
      "\nUNION ALL ".join(quality_branch(*q) for q in QUALITY))

ALERT_COLS = "alert_type, severity, region_code, entity_id, entity_name, category, alert_message, alert_trigger_date"
ALERT_SQL = f"""
SELECT 'STALE_TASK' AS alert_type, 'High' AS severity, region_code, task_id AS entity_id, task_name AS entity_name,
       type_department AS category, 'Task pending for ' || age_days || ' days' AS alert_message, {stamp("created_at")} AS alert_trigger_date
FROM tasks WHERE task_status_stage = 'new' AND age_days > 7
UNION ALL SELECT 'URGENT_NOT_STARTED', 'Critical', region_code, task_id, task_name, type_department,
       'Urgent task not started for ' || age_days || ' days', {stamp("created_at")}
FROM tasks WHERE task_status_stage = 'new' AND type_priority = 'urgent' AND age_days > 1
UNION ALL SELECT 'HIGH_BACKLOG_PROPERTY', 'Medium', p.region_code, p.property_id, p.property_name, 'property',
       'Property has ' || count(*) || ' tasks in backlog', {stamp("max(t.created_at)")}
FROM properties p JOIN tasks t ON t.property_pk = p.id WHERE {OPEN}
GROUP BY p.region_code, p.property_id, p.property_name HAVING count(*) >= 5
UNION ALL SELECT 'CHECKOUT_NO_CLEANING', 'Critical', r.region_code, r.reservation_id, p.property_name, 'housekeeping',
       'Checkout today but no completed housekeeping task', {stamp("r.checkout_date::TIMESTAMP")}
FROM reservations r JOIN properties p ON r.property_pk = p.id
WHERE r.checkout_date = DATE '2001-07-15' AND reservation_status = 'active' AND r.property_pk NOT IN (
  SELECT property_pk FROM tasks WHERE {dept("housekeeping")} AND {DONE} AND finished_at::DATE = DATE '2001-07-15')
UNION ALL SELECT 'LOW_WORKER_ACTIVITY', 'Medium', t.region_code, t.region_code, max(r.region_name), 'workforce',
       'Only ' || count(DISTINCT finished_by_id) || ' workers active in last 7 days', {stamp("max(finished_at)")}
FROM tasks t LEFT JOIN regions r USING (region_code) WHERE finished_at >= {ago(7)}
GROUP BY t.region_code HAVING count(DISTINCT finished_by_id) < 3"""
ALERT_TABLES = "tasks properties reservations regions"
check("operational_alerts", lambda d: boards.operational_alerts(d, CLOCK), ALERT_TABLES, ALERT_SQL)

check("property_dashboard", lambda d: properties.property_dashboard(d, CLOCK), "properties tasks reservations", f"""
WITH b AS (SELECT {IDENT}, {DENSITY}, {HEALTH_IN},
  {burden(dept("maintenance"), "maintenance_", "maintenance_avg_hours_to_resolve", "maintenance_recency_ratio", "maintenance_total_rate_paid")}
  {FROM_P}),
g AS (SELECT region_code, avg(raw) AS mean FROM b GROUP BY 1)
SELECT b.* EXCLUDE (raw), {VOLUME_RANKS},
       dense_rank() OVER (PARTITION BY region_code ORDER BY total_maintenance_tasks DESC) AS regional_maintenance_rank,
       {health("current_backlog")}
FROM b LEFT JOIN g USING (region_code)""")

check("regional_dashboard", lambda d: regions.regional_dashboard(d, CLOCK), "regions properties tasks reservations", f"""
WITH {SCORE_CTES.strip()},
{WORKLOAD_CTES.strip()},
ba AS (SELECT region_code, {buckets("backlog_age_", "d")}, count(*) AS n, {rnd("avg(age_days)")} AS avg_backlog_age_days,
       max(age_days) AS max_backlog_age_days, {stamp("min(created_at)")} AS oldest_backlog_task_created
       FROM tasks WHERE {OPEN} GROUP BY 1)
SELECT {SCORE_COLS}, coalesce(rt.going, 0) AS in_progress,
       coalesce(ws.avg_daily_tasks_created, 0) AS avg_daily_tasks_created, coalesce(ws.avg_daily_tasks_completed, 0) AS avg_daily_tasks_completed,
       coalesce(ws.peak_daily_tasks, 0) AS peak_daily_tasks, ws.stddev_daily_tasks, ws.busiest_day,
       {div("coalesce(ws.avg_daily_tasks_created, 0)", "coalesce(rp.n, 0)", 2)} AS tasks_per_property_per_day,
       {div("coalesce(ws.avg_daily_tasks_created, 0)", "coalesce(rt.workers, 0)", 2)} AS tasks_per_worker_per_day,
       {", ".join(f"coalesce(ba.backlog_age_{b}d, 0) AS backlog_age_{b}d" for b in ("0_1", "2_3", "4_7", "8_14", "15_30", "over_30"))},
       coalesce(ba.n, 0) AS total_backlog_tasks, ba.avg_backlog_age_days, ba.max_backlog_age_days, ba.oldest_backlog_task_created
{SCORE_FROM} LEFT JOIN ws USING (region_code) LEFT JOIN ba USING (region_code) WHERE is_active""")


def best_sql(d: str, p: str) -> str:
    return f"""{p} AS (
  SELECT t.property_pk, t.checkout_date, t.task_name, t.finished_by_name,
         CASE WHEN {DONE} THEN 'completed' WHEN task_status_stage = 'in_progress' THEN 'in_progress'
              WHEN t.id IN (SELECT task_pk FROM task_assignments) THEN 'assigned' ELSE 'unassigned' END AS status
  FROM tasks t WHERE {dept(d)} AND t.checkout_date IN (DATE '2001-07-15', DATE '2001-07-16')
  QUALIFY row_number() OVER (PARTITION BY t.property_pk, t.checkout_date
    ORDER BY CASE task_status_stage WHEN 'finished' THEN 1 WHEN 'in_progress' THEN 2 WHEN 'new' THEN 3 ELSE 4 END, t.id) = 1)"""


check("daily_turnover_board", lambda d: boards.daily_turnover_board(d, CLOCK),
      "reservations properties tasks task_assignments", f"""
WITH nx AS (
  SELECT property_pk, checkin_date, checkin_time FROM reservations
  WHERE reservation_status = 'active' AND checkin_date >= DATE '2001-07-15'
  QUALIFY row_number() OVER (PARTITION BY property_pk ORDER BY checkin_date, checkin_time, id) = 1),
{best_sql("housekeeping", "hk")},
{best_sql("inspection", "ins")},
b AS (
  SELECT r.region_code, r.property_pk, p.property_id, p.property_name, r.id AS reservation_pk, r.reservation_id,
         r.checkout_date, r.checkout_time, nx.checkin_date AS nd, nx.checkin_time AS nt,
         date_diff('day', r.checkout_date, nx.checkin_date) AS gap, r.pets,
         hk.status AS h, hk.task_name AS hn, hk.finished_by_name AS hf, ins.status AS i, ins.task_name AS tn, ins.finished_by_name AS tf
  FROM reservations r JOIN properties p ON r.property_pk = p.id LEFT JOIN nx ON nx.property_pk = r.property_pk
  LEFT JOIN hk ON hk.property_pk = r.property_pk AND hk.checkout_date = r.checkout_date
  LEFT JOIN ins ON ins.property_pk = r.property_pk AND ins.checkout_date = r.checkout_date
  WHERE r.reservation_status = 'active' AND r.checkout_date IN (DATE '2001-07-15', DATE '2001-07-16')),
f AS (
  SELECT *, concat_ws(',',
    CASE WHEN h IS NULL THEN '"NO_HOUSEKEEPING_TASK"' END, CASE WHEN h = 'unassigned' THEN '"NO_CLEANER_ASSIGNED"' END,
    CASE WHEN gap = 1 THEN '"TIGHT_TURNAROUND"' END, CASE WHEN gap = 0 THEN '"SAME_DAY_TURNAROUND"' END,
    CASE WHEN i <> 'completed' OR (i IS NULL AND h IS NOT NULL) THEN '"INSPECTION_INCOMPLETE"' END,
    CASE WHEN pets > 0 THEN '"PET_DEPARTURE"' END) AS flags FROM b)
SELECT region_code, property_pk, property_id, property_name, reservation_pk, reservation_id, {text("checkout_date")} AS checkout_date,
       checkout_time, {text("nd")} AS next_checkin_date, nt AS next_checkin_time,
       CASE WHEN checkout_time IS NOT NULL AND nt IS NOT NULL
            THEN {rnd("date_diff('minute', (checkout_date || ' ' || checkout_time)::TIMESTAMP, (nd || ' ' || nt)::TIMESTAMP) / 60.0")}
            ELSE CAST(gap * 24 AS DOUBLE) END AS turnaround_hours,
       coalesce(h, 'none') AS housekeeping_status, hn AS housekeeping_task_name, hf AS housekeeping_finished_by,
       coalesce(i, 'none') AS inspection_status, tn AS inspection_task_name, tf AS inspection_finished_by,
       {big("pets")} AS guest_pets, '[' || flags || ']' AS risk_flags
FROM f""")

check("inspection_compliance", lambda d: boards.inspection_compliance(d, CLOCK, window_days=WINDOW),
      "tasks task_requirements properties", f"""
WITH s AS (
  SELECT t.id, t.region_code, t.property_pk, t.task_status_stage, t.finished_by_id, t.finished_by_name, count(q.id) AS need,
         count(q.id) FILTER (WHERE q.response <> '') AS got, count(q.id) FILTER (WHERE q.photo_required) AS pneed,
         count(q.id) FILTER (WHERE q.photo_required AND q.photos NOT IN ('[]', 'null')) AS pgot
  FROM tasks t LEFT JOIN task_requirements q ON q.task_pk = t.id
  WHERE {dept("inspection")} AND t.created_at >= {ago(WINDOW)} GROUP BY 1, 2, 3, 4, 5, 6),
u AS (
  SELECT 'property' AS entity_type, p.property_name AS entity_name, p.property_id AS entity_id, s.region_code, s.property_pk,
         count(*) AS n, {cnt(DONE)} AS done, sum(need) AS need, sum(got) AS got, sum(pneed) AS pneed, sum(pgot) AS pgot
  FROM s JOIN properties p ON s.property_pk = p.id GROUP BY 2, 3, 4, 5
  UNION ALL
  SELECT 'inspector', finished_by_name, finished_by_id, region_code, NULL, count(*), {cnt(DONE)}, sum(need), sum(got), sum(pneed), sum(pgot)
  FROM s WHERE finished_by_name <> '' GROUP BY 2, 3, 4 HAVING count(*) >= 3),
v AS (SELECT *, {pct("got", "need")} AS rr, {pct("pgot", "pneed")} AS pr FROM u)
SELECT entity_type, entity_name, entity_id, region_code, property_pk, n AS total_inspections, done AS completed_inspections,
       {big("need")} AS total_requirements, {big("got")} AS completed_requirements, rr AS requirement_completion_rate,
       {big("pneed")} AS total_photos_required, {big("pgot")} AS photos_completed, pr AS photo_compliance_rate,
       CASE WHEN entity_type = 'property' THEN NULL WHEN rr >= 95 AND pr >= 90 THEN 'Excellent' WHEN rr >= 80 THEN 'Good'
            WHEN rr >= 60 THEN 'Developing' ELSE 'Needs Improvement' END AS performance_classification
FROM v""")

check("housekeeping_schedule_performance",
      lambda d: workers.housekeeping_schedule_performance(d, CLOCK, window_days=WINDOW), "tasks", f"""
WITH w AS (
  SELECT finished_by_name AS worker_name, finished_by_id AS worker_id, region_code, count(*) AS tasks_90d,
         {cnt("finished_at >= " + ago(30))} AS tasks_30d, {cnt("finished_at >= " + ago(7))} AS tasks_7d,
         count(DISTINCT property_pk) AS distinct_properties, count(DISTINCT finished_at::DATE) AS active_days,
         {avg_m()} AS avg_active_minutes, {rnd(f"quantile_cont(us_active, 0.5) / {MINUTES}")} AS median_active_minutes,
         {pct(cnt("finished_at::DATE <= scheduled_date"), "count(scheduled_date)")} AS on_time_rate
  FROM tasks WHERE {dept("housekeeping")} AND {DONE} AND finished_by_name <> '' AND finished_at >= {ago(WINDOW)}
  GROUP BY 1, 2, 3 HAVING count(*) >= 5),
g AS (SELECT region_code, {rnd("avg(avg_active_minutes)")} AS region_avg_active_minutes, {rnd("avg(on_time_rate)")} AS region_avg_on_time_rate,
      quantile_cont(tasks_90d, 0.75) AS busy FROM w GROUP BY 1)
SELECT w.*, g.* EXCLUDE (region_code, busy), {div("tasks_90d", "active_days", 2)} AS tasks_per_active_day,
       {div("distinct_properties", "active_days", 2)} AS properties_per_active_day,
       CASE WHEN on_time_rate >= 90 AND tasks_90d >= busy THEN 'Top Performer' WHEN on_time_rate >= 75 THEN 'Solid'
            WHEN on_time_rate >= 60 THEN 'Developing' ELSE 'Needs Coaching' END AS performance_band,
       dense_rank() OVER (PARTITION BY w.region_code ORDER BY on_time_rate DESC NULLS LAST) AS regional_on_time_rank,
       dense_rank() OVER (PARTITION BY w.region_code ORDER BY tasks_90d DESC) AS regional_volume_rank
FROM w LEFT JOIN g ON w.region_code = g.region_code""")

check("department_sla_tracker", lambda d: boards.department_sla_tracker(d, CLOCK), "tasks", f"""
WITH sla(type_priority, hrs) AS (VALUES ('urgent', 4), ('high', 24), ('normal', 72), ('low', 168), ('watch', 336)),
o AS (SELECT t.*, hrs, (epoch_us(TIMESTAMP '2001-07-15 12:00:00') - epoch_us(created_at)) / {HOURS} AS age
      FROM tasks t LEFT JOIN sla USING (type_priority) WHERE {OPEN}),
s AS (
  SELECT region_code, type_department, count(*) AS total_open, {cnt("age <= hrs")} AS compliant,
         {cnt("age > hrs * 0.75 AND age <= hrs")} AS warning, {cnt("age > hrs")} AS breached,
         {pct(cnt("age > hrs"), "count(hrs)")} AS breach_rate,
         {", ".join(f"{cnt(f"type_priority = '{x}'")} AS {x}_open, {cnt(f"type_priority = '{x}' AND age > hrs")} AS {x}_breached" for x in ("urgent", "high", "normal"))}
  FROM o GROUP BY 1, 2),
c AS (
  SELECT region_code, type_department, count(*) AS n, {pct(cnt(f"us_total / {HOURS} <= hrs"), "count(hrs)")} AS rate, {avg_h("us_total")} AS hours
  FROM tasks LEFT JOIN sla USING (type_priority) WHERE {DONE} AND finished_at >= {ago(7)} GROUP BY 1, 2)
SELECT s.*, coalesce(c.n, 0) AS completions_7d, c.rate AS sla_compliance_rate_7d, c.hours AS avg_resolution_hours_7d,
       CASE WHEN coalesce(breach_rate, 0) <= 5 THEN 'Healthy' WHEN coalesce(breach_rate, 0) <= 15 THEN 'At Risk'
            WHEN coalesce(breach_rate, 0) <= 30 THEN 'Degraded' ELSE 'Critical' END AS health_status
FROM s LEFT JOIN c USING (region_code, type_department)""")

check("monthly_completion_metrics", lambda d: trends.monthly_completion_metrics(d, CLOCK), "tasks", f"""
SELECT {stamp("date_trunc('month', finished_at)::TIMESTAMP")} AS month, count(*) AS tasks_completed,
       avg(us_total) / {HOURS} AS avg_hours_to_complete
FROM tasks WHERE finished_at IS NOT NULL GROUP BY 1""")

check("task_assignees", lambda d: trends.task_assignees(d, CLOCK), "tasks task_assignments people", f"""
SELECT t.id AS task_pk, task_name, task_status_stage, {text("scheduled_date")} AS scheduled_date, assignee_id, person_name AS registered_name
FROM tasks t LEFT JOIN task_assignments a ON a.task_pk = t.id LEFT JOIN people ON person_id = assignee_id""")

check("top_workers", lambda d: workers.top_workers(workers.worker_leaderboard_housekeeping(d, CLOCK, window_days=WINDOW), 10),
      "tasks", f"SELECT * FROM ({leaderboard_sql('housekeeping')}) WHERE global_rank <= 10")
check("top_workers_per_region",
      lambda d: workers.top_workers(workers.worker_leaderboard_inspection(d, CLOCK, window_days=WINDOW), 3, "regional_rank"),
      "tasks", f"SELECT * FROM ({leaderboard_sql('inspection')}) WHERE regional_rank <= 3")
check("needs_attention", lambda d: properties.needs_attention(properties.property_operational_health(d, CLOCK)),
      "properties tasks", f"""SELECT property_name, region_code, health_score, backlog, urgent_backlog
FROM ({HEALTH_SQL}) WHERE health_status = 'Needs Attention'""")
check("critical_alerts", lambda d: boards.critical_alerts(boards.operational_alerts(d, CLOCK)), ALERT_TABLES,
      f"SELECT alert_type, entity_name, alert_message FROM ({ALERT_SQL}) WHERE severity = 'Critical'")
check("region_comparison", lambda d: regions.region_comparison(regions.regional_performance_scorecard(d, CLOCK)),
      "regions properties tasks reservations",
      f"SELECT region_code, properties, tasks_90d, completion_rate_pct, active_workers FROM ({SCORECARD_SQL})")
check("upcoming_reservations", lambda d: boards.upcoming_reservations(d, CLOCK, 30), "reservations", f"""
SELECT * REPLACE ({text("checkin_date")} AS checkin_date, {text("checkout_date")} AS checkout_date, {big("pets")} AS pets)
FROM reservations r WHERE r.checkin_date >= DATE '2001-07-15' AND r.checkout_date <= DATE '2001-08-14'""")
check("tasks_by_department", lambda d: boards.tasks_by_department(d, CLOCK, date(2001, 1, 1), date(2001, 6, 30)), "tasks", f"""
SELECT property_pk, type_department, id AS task_pk, task_name, {text("scheduled_date")} AS scheduled_date,
       count(*) OVER (PARTITION BY property_pk, type_department) AS group_size
FROM tasks t WHERE t.scheduled_date BETWEEN DATE '2001-01-01' AND DATE '2001-06-30'""")



def pruned_board(d: Domain) -> DataFrame:
    """The cleaners' board of a table stored by month of creation: a window on the finish opens the months that meet it."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("tasks", d["tasks"].withColumn("created_month", F.trunc("created_at", "month")), "created_month", ranges=["finished_at"])
    seen = store.snapshot()
    first = str(CLOCK.today - timedelta(days=90))
    opened = [f for v in seen.chosen("tasks", finished_at=(first, LAST)) for f in seen.state("tasks").parts[v].folders]
    recent = seen.read("tasks", between=("2001-03-01", "9999")).inputFiles()
    board = workers.worker_leaderboard_housekeeping(StoredTables(seen), CLOCK)
    source = workers._completed(StoredTables(seen), CLOCK, 90).inputFiles()
    # A task of March can be finished in April, so March may be opened; nothing older is.
    if len(opened) * 4 > len(seen.state("tasks").parts) or not set(source) <= set(recent):
        raise AssertionError(f"{len(opened)} folders are opened")
    return board


check("pruned_by_finish", pruned_board, "tasks", leaderboard_sql("housekeeping").replace(f"INTERVAL {WINDOW} DAY", "INTERVAL 90 DAY"))

# A refresh runs every view with its regular 90 days; the statements above are reused with that window.
REGULAR = {n: ORACLES[n].replace(f"INTERVAL {WINDOW} DAY", "INTERVAL 90 DAY") for n in registry.REFRESHED}
check("refresh_all", lambda d: registry.refresh_report(d, CLOCK, figures=lambda n, df: contents(n, df.drop("refreshed_at"))), "",
      "\nUNION ALL ".join(contents_sql(n, sql) for n, sql in REGULAR.items()))
