"""Checks of de-duplication, quality, table maintenance, export and events (D, U, X, S and R operators)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.binding import CLOCK, EVENT_CLOCK, Domain
from checks.landed import _items
from checks.records import FOLD_SQL, folded_source
from checks.registry import big, check, cnt, pct, rnd, stamp, text
from fieldstay.operators import dedup, export, keys, maintenance, merge, quality, reconcile, runlog, runs
from fieldstay.session import durable, scratch_path
from fieldstay.sources import snapshot
from fieldstay.streaming import events as ev
from fieldstay.streaming import rollups

NOW, EVENT_NOW = "TIMESTAMP '2001-07-15 12:00:00'", "TIMESTAMP '2024-01-31'"



def store_of(d: Domain, name: str) -> snapshot.SnapshotStore:
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    table = d["tasks"].select("id", "region_code", "task_name", F.trunc("created_at", "month").alias("created_month"))
    store.write(name, table, "created_month")
    return store


def vacuumed(d: Domain) -> DataFrame:
    """One month is replaced; what is no longer current is deleted at once and the table still reads whole."""
    store = store_of(d, "tasks")
    march = store.read("tasks", ["2001-03-01"])
    store.replace("tasks", march.withColumn("task_name", F.lit("March")), ["2001-03-01"])
    store.vacuum("tasks", older_than_hours=-1)
    return store.read("tasks").groupBy("created_month", (F.col("task_name") == "March").alias("renamed")).agg(F.count(F.lit(1)).alias("n"))


check("snapshot_vacuum", vacuumed, "tasks", f"""SELECT {text("date_trunc('month', created_at)::DATE")} AS created_month,
 date_trunc('month', created_at) = TIMESTAMP '2001-03-01' AS renamed, count(*) AS n FROM tasks GROUP BY ALL""")


def renamed(store: snapshot.SnapshotStore, month: str, name: str, seen: snapshot.Snapshot) -> bool:
    """Rename a month's tasks by an upsert made from ``seen``; False if another writer was faster."""
    batch = seen.read("tasks", [month]).withColumn("task_name", F.lit(name))
    try:
        merge.upsert_table(store, "tasks", batch, ["id", "created_month"], "created_month", based_on=seen)
        return True
    except snapshot.ConflictError:
        return False


def conflicting(d: Domain) -> DataFrame:
    """Three upserts from one version: the second of a month fails, that of another month goes through."""
    store = store_of(d, "tasks")
    seen = store.snapshot()
    outcomes = [renamed(store, m, n, seen) for m, n in (("2001-03-01", "first"), ("2001-03-01", "second"), ("2001-04-01", "third"))]
    if outcomes != [True, False, True]:
        raise AssertionError(f"the upserts came out as {outcomes}")
    return store.read("tasks").select("id", "region_code", "task_name")


check("upsert_conflict", conflicting, "tasks", """SELECT id, region_code, CASE date_trunc('month', created_at)
 WHEN TIMESTAMP '2001-03-01' THEN 'first' WHEN TIMESTAMP '2001-04-01' THEN 'third' ELSE task_name END AS task_name FROM tasks""")


def outdated(d: Domain) -> DataFrame:
    """Two writers start from the same version; the second fails and the first one's change stays."""
    store = store_of(d, "tasks")
    seen = store.snapshot()
    store.drop("tasks", ["2001-03-01"])
    try:
        store.replace("tasks", seen.read("tasks", ["2001-03-01"]), ["2001-03-01"], based_on=seen)
        raise AssertionError("the second writer was not stopped")
    except snapshot.ConflictError:
        return store.read("tasks").select("id", "region_code")


check("snapshot_conflict", outdated, "tasks", "SELECT id, region_code FROM tasks WHERE NOT (created_at >= TIMESTAMP '2001-03-01' AND created_at < TIMESTAMP '2001-04-01')")
check("snapshot_pruned_read", lambda d: store_of(d, "tasks").read("tasks", between=("2001-02-01", "2001-04-01")).select("id", "task_name"), "tasks",
      "SELECT id, task_name FROM tasks WHERE created_at >= TIMESTAMP '2001-02-01' AND created_at < TIMESTAMP '2001-05-01'")

# D: duplicates ------------------------------------------------------------------------------------
REQ_KEY, PHOTO_KEY = ["task_pk", "requirement_id"], ["property_pk", "photo_id"]


def lines(d: Domain, *columns: str) -> DataFrame:
    """Line items in the place of a child table that has no stand-in of its own."""
    return d.raw("lineitem").selectExpr(*columns)


def duplicate_sources(d: Domain) -> dict:
    return {
        "property_photos": (d["property_photos"], PHOTO_KEY),
        "reservation_guests": (lines(d, "l_suppkey AS reservation_pk", "l_linestatus AS guest_name", "l_returnflag AS guest_email"), ["reservation_pk", "guest_name", "guest_email"]),
        "task_photos": (lines(d, "l_orderkey AS task_pk", "l_suppkey % 3 AS photo_id"), ["task_pk", "photo_id"]),
        "task_comments": (lines(d, "l_partkey AS comment_id", "l_linestatus AS region_code"), ["comment_id", "region_code"]),
        "task_assignments": (d["task_assignments"], ["task_pk", "assignee_id"]),
        "task_requirements": (d["task_requirements"], REQ_KEY),
    }


def dup_line(name: str, table: str, key: str) -> str:
    return (f"SELECT '{name}' AS table_name, count(*) AS total_records, count(DISTINCT ({key})) AS unique_records,"
            f" count(*) - count(DISTINCT ({key})) AS duplicates FROM {table}")


check("duplicate_report", lambda d: dedup.duplicate_report(duplicate_sources(d)),
      "property_photos task_requirements task_assignments", " UNION ALL ".join([
          dup_line("property_photos", "property_photos", "property_pk, photo_id"),
          dup_line("task_photos", "lineitem", "l_orderkey, l_suppkey % 3"),
          dup_line("task_comments", "lineitem", "l_partkey, l_linestatus"),
          dup_line("reservation_guests", "lineitem", "l_suppkey, l_linestatus, l_returnflag"),
          dup_line("task_assignments", "task_assignments", "task_pk, assignee_id"),
          dup_line("task_requirements", "task_requirements", "task_pk, requirement_id")]))

REQ_COLS = "task_pk, requirement_id, section_name, response, photo_required, photos"


def requirement_rows(df: DataFrame) -> DataFrame:
    return df.select(*REQ_COLS.split(", "))


check("dedup_keep_first", lambda d: requirement_rows(dedup.keep_first(d["task_requirements"], REQ_KEY, ["arrival"])), "task_requirements",
      f"SELECT {REQ_COLS} FROM task_requirements QUALIFY row_number() OVER (PARTITION BY task_pk, requirement_id ORDER BY id) = 1")
check("dedup_keep_last", lambda d: requirement_rows(dedup.keep_last(d["task_requirements"], REQ_KEY, ["arrival"])), "task_requirements",
      f"SELECT {REQ_COLS} FROM task_requirements QUALIFY row_number() OVER (PARTITION BY task_pk, requirement_id ORDER BY id DESC) = 1")
check("dedup_null_key",
      lambda d: requirement_rows(dedup.keep_first_blank_as_null(d["task_requirements"], ["task_pk", "response"], ["response"], ["arrival"])),
      "task_requirements",
      f"SELECT {REQ_COLS} FROM task_requirements QUALIFY row_number() OVER (PARTITION BY task_pk, coalesce(response, '') ORDER BY id) = 1")


def verification(d: Domain) -> DataFrame:
    photos = d["property_photos"]
    return dedup.dedup_verification(photos, photos, dedup.keep_first(photos, PHOTO_KEY, ["arrival"]), PHOTO_KEY)


check("dedup_verify", verification, "property_photos", """SELECT count(*) AS original_rows, count(DISTINCT (property_pk, photo_id)) AS distinct_keys,
 count(*) AS backup_rows, count(DISTINCT (property_pk, photo_id)) AS kept_rows, true AS verified FROM property_photos""")
check("key_violations", lambda d: dedup.key_violations(d["task_requirements"], REQ_KEY), "task_requirements",
      "SELECT task_pk, requirement_id, count(*) AS copies FROM task_requirements GROUP BY 1, 2 HAVING count(*) > 1")
check("duplicates_side_by_side",
      lambda d: dedup.duplicates_side_by_side({k: v for k, v in duplicate_sources(d).items() if k in ("property_photos", "task_requirements")}),
      "property_photos task_requirements", """SELECT count(*) - count(DISTINCT (property_pk, photo_id)) AS property_photos_duplicates,
 (SELECT count(*) - count(DISTINCT (task_pk, requirement_id)) FROM task_requirements) AS task_requirements_duplicates FROM property_photos""")

# D: quality ---------------------------------------------------------------------------------------


def active(d: Domain) -> DataFrame:
    return d["properties"].where("property_status = 'active'")


GONE = "property_pk NOT IN (SELECT id FROM properties WHERE property_status = 'active')"
def photoless(d: Domain) -> DataFrame:
    """Properties without any photo, whatever the photos' numbers."""
    return quality.unmatched_properties(d["properties"], d["property_photos"])


for _name in ("unmatched_properties", "properties_without_photo"):
    check(_name, photoless, "properties property_photos",
          "SELECT id, property_id, region_code, property_name FROM properties p WHERE NOT EXISTS (SELECT 1 FROM property_photos f WHERE f.property_pk = p.id)")
check("orphan_reservations", lambda d: quality.orphans(d["reservations"], active(d), "reservation_id"), "reservations properties",
      f"SELECT id, reservation_id, region_code FROM reservations WHERE {GONE}")
check("orphan_tasks", lambda d: quality.orphans(d["tasks"], active(d), "task_id"), "tasks properties",
      f"SELECT id, task_id, region_code FROM tasks WHERE {GONE}")
check("region_stats",
      lambda d: quality.region_stats(d["regions"], property=d["properties"], reservation=d["reservations"], task=d["tasks"]),
      "regions properties reservations tasks", """SELECT region_code, region_name,
 (SELECT count(*) FROM properties p WHERE p.region_code = r.region_code) AS property_count,
 (SELECT count(*) FROM reservations v WHERE v.region_code = r.region_code) AS reservation_count,
 (SELECT count(*) FROM tasks t WHERE t.region_code = r.region_code) AS task_count FROM regions r""")


def linked_tasks(d: Domain) -> DataFrame:
    """Tasks that know their reservation's id; one in eleven is not resolved."""
    return d["tasks"].withColumns({
        "linked_reservation_id": F.col("reservation_pk"),
        "reservation_pk": F.when(F.col("id") % 11 != 0, F.col("reservation_pk")),
    })


check("linkage_rate", lambda d: quality.linkage_rate(linked_tasks(d)), "tasks", f"""
SELECT region_code, count(*) AS total_tasks, count(reservation_pk) AS has_linked_res_id,
 {cnt("reservation_pk IS NOT NULL AND id % 11 <> 0")} AS has_reservation_fk,
 {pct(cnt("reservation_pk IS NOT NULL AND id % 11 <> 0"), "count(*)")} AS pct_linked,
 {pct(cnt("reservation_pk IS NOT NULL AND id % 11 <> 0"), "count(reservation_pk)")} AS resolution_rate
FROM tasks GROUP BY 1""")


def child_tables(d: Domain) -> dict:
    place = d["tasks"].select(F.col("id").alias("task_pk"), "region_code")
    return {
        "supplies": d["task_requirements"].join(place, "task_pk"),
        "costs": d["tasks"].where("rate_paid IS NOT NULL"),
    }


for _name in ("child_counts", "child_counts_whole"):
    check(_name, lambda d: quality.child_counts(child_tables(d)), "task_requirements tasks", """
SELECT 'supplies' AS child, region_code, count(*) AS records FROM task_requirements q JOIN tasks t ON q.task_pk = t.id GROUP BY 2
UNION ALL SELECT 'costs', region_code, count(*) FROM tasks WHERE rate_paid IS NOT NULL GROUP BY 2""")
check("field_fill",
      lambda d: quality.field_fill(d["tasks"], ["finished_by_id", "rate_paid", "started_at"], CLOCK.hours_ago(24 * 365), "created_at"),
      "tasks", f"""SELECT count(*) AS total, count(finished_by_id) AS has_finished_by_id, count(rate_paid) AS has_rate_paid,
 count(started_at) AS has_started_at FROM tasks WHERE created_at > {NOW} - INTERVAL 365 DAY""")
ENTITY_NAMES = ("properties", "reservations", "tasks", "people", "tags")
check("entity_counts", lambda d: quality.entity_counts({n: d[n] for n in ENTITY_NAMES}), " ".join(ENTITY_NAMES),
      " UNION ALL ".join(f"SELECT '{n}' AS entity, count(*) AS records FROM {n}" for n in ENTITY_NAMES))
check("orphan_counts",
      lambda d: quality.orphan_counts({"reservations": (d["reservations"], "access_code"), "tasks": (d["tasks"], "reservation_pk")}),
      "reservations tasks", """SELECT 'reservations' AS entity, count(*) FILTER (WHERE access_code IS NULL) AS orphans FROM reservations
UNION ALL SELECT 'tasks', count(*) FILTER (WHERE reservation_pk IS NULL) FROM tasks""")
check("expiry_status", lambda d: quality.expiry_status(d["tasks"].select("id", "created_at"), "created_at", CLOCK).drop("created_at"), "tasks", f"""
SELECT id, CASE WHEN created_at > {NOW} THEN 'valid' ELSE 'expired' END AS expiry_status,
 CAST(trunc((epoch_us(created_at) - epoch_us({NOW})) / 3600000000.0::DOUBLE) AS BIGINT) % 24 AS hours_until_expiry FROM tasks""")


def nation_regions(d: Domain) -> DataFrame:
    return d.raw("nation").select(
        F.col("n_regionkey").alias("tenant_id"), F.lower("n_name").alias("region_code"), (F.col("n_nationkey") % 6 != 0).alias("is_active")
    )


check("region_list", lambda d: quality.region_list(nation_regions(d), "tenant_id", "region_code"), "", """
SELECT CAST(n_regionkey AS BIGINT) AS tenant_id, string_agg(lower(n_name), ' ' ORDER BY lower(n_name)) AS regions
FROM nation WHERE n_nationkey % 6 <> 0 GROUP BY 1""")
check("properties_within_radius",
      lambda d: quality.properties_within_radius(d["properties"], 20.0, -20.0, 1_000_000.0).select("id", F.round("distance_m", 3).alias("distance_m")),
      "properties", """
WITH x AS (SELECT id, radians(latitude_numeric) AS a, radians(20.0) AS b, radians(longitude_numeric) AS e, radians(-20.0) AS f FROM properties),
y AS (SELECT id, 2 * 6378168.0::DOUBLE * asin(least(1.0, sqrt(sin((a - b) / 2) ** 2 + cos(a) * cos(b) * sin((e - f) / 2) ** 2))) AS m FROM x)
SELECT id, round(m, 3) AS distance_m FROM y WHERE m < 1000000.0""")


def swapped(d: Domain) -> DataFrame:
    bad = F.col("id") % 50 == 0
    return d["reservations"].select(
        "reservation_id", F.when(bad, F.col("checkout_date")).otherwise(F.col("checkin_date")).alias("checkin_date"),
        F.when(bad, F.col("checkin_date")).otherwise(F.col("checkout_date")).alias("checkout_date"),
    )


check("date_order_violations", lambda d: quality.date_order_violations(swapped(d)), "reservations", f"""
SELECT reservation_id, {text("r.checkout_date")} AS checkin_date, {text("r.checkin_date")} AS checkout_date FROM reservations r WHERE id % 50 = 0""")

# D: run log ---------------------------------------------------------------------------------------
LATEST = """status AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY region_code, entity_type
 ORDER BY sync_started_at DESC, sync_completed_at DESC, records_processed DESC) = 1)"""
RUN_TIMES = f"""{stamp("r.sync_started_at")} AS sync_started_at, {stamp("r.sync_completed_at")} AS sync_completed_at,
 {stamp("r.last_successful_sync_at")} AS last_successful_sync_at"""


def status(d: Domain) -> DataFrame:
    return d["sync_status"]


check("latest_status", lambda d: runlog.latest_status(d["runs"]), "runs", f"WITH {LATEST} SELECT * REPLACE ({RUN_TIMES.replace(' AS ', ' AS ').strip()}) FROM status r")
check("sync_health", lambda d: quality.sync_health(d["runs"], EVENT_CLOCK), "runs", f"""
SELECT entity_type, count(DISTINCT region_code) AS regions_synced, {stamp("max(last_successful_sync_at)")} AS most_recent_sync,
 CAST(floor(date_diff('second', max(last_successful_sync_at), {EVENT_NOW}) / 3600) AS BIGINT) % 24 AS hours_since_last,
 {cnt(f"sync_status = 'failed' AND sync_started_at > {EVENT_NOW} - INTERVAL 24 HOUR")} AS failures_24h
FROM runs GROUP BY 1""")
check("sync_recent", lambda d: runlog.sync_recent(d["runs"], EVENT_CLOCK), "runs", f"""
SELECT region_code, entity_type, sync_status, {stamp("r.sync_started_at")} AS sync_started_at,
 {stamp("r.last_successful_sync_at")} AS last_successful_sync_at, records_processed, api_calls_made
FROM runs r WHERE r.sync_started_at > {EVENT_NOW} - INTERVAL 24 HOUR""")
check("sync_failed", lambda d: runlog.sync_failed(d["runs"]), "runs", f"""
SELECT region_code, entity_type, error_message, {stamp("r.sync_started_at")} AS sync_started_at FROM runs r WHERE sync_status = 'failed'
ORDER BY r.sync_started_at DESC NULLS LAST, region_code, entity_type LIMIT 10""")
check("stale_runs", lambda d: runlog.stale_runs(d["runs"], EVENT_CLOCK).select("region_code", "entity_type", "sync_started_at"), "runs", f"""
SELECT region_code, entity_type, {stamp("r.sync_started_at")} AS sync_started_at FROM runs r
WHERE sync_status = 'running' AND r.sync_started_at < {EVENT_NOW} - INTERVAL 1 HOUR""")


def unsettled(d: Domain) -> DataFrame:
    """A run that is repeated keeps the success time of the run before it."""
    runs = d["runs"].withColumn("last_successful_sync_at", F.col("sync_completed_at"))
    return runlog.unsettled_runs(runs, EVENT_CLOCK)


check("unsettled_runs", unsettled, "runs", f"""
SELECT region_code, entity_type, sync_status, {stamp("sync_completed_at")} AS last_successful_sync_at,
 CAST(floor((epoch_us({EVENT_NOW}) - epoch_us(sync_completed_at)) / 3600000000) AS BIGINT) AS hours_ago
FROM runs WHERE sync_status IN ('failed', 'running') AND sync_completed_at > {EVENT_NOW} - INTERVAL 24 HOUR""")


def started(d: Domain) -> DataFrame:
    runs = status(d)
    again = runs.where("sync_status <> 'success'").select("region_code", "entity_type")
    fresh = d["regions"].select("region_code", F.lit("entity_new").alias("entity_type"))
    return runlog.start_runs(runs, again.unionByName(fresh), EVENT_CLOCK)


check("run_log_start", started, "runs regions", f"""
WITH {LATEST}, n AS (
  SELECT region_code, entity_type, last_successful_sync_at FROM status WHERE sync_status <> 'success'
  UNION ALL SELECT region_code, 'entity_new', NULL FROM regions)
SELECT * REPLACE ({RUN_TIMES}) FROM status r WHERE sync_status = 'success'
UNION ALL SELECT region_code, entity_type, 'running', {stamp(EVENT_NOW)}, NULL, {stamp("last_successful_sync_at")}, 0, 0, 0, NULL FROM n""")


def finished_runs(d: Domain) -> DataFrame:
    """Status after runs of entities 0-2 succeed, fail and partly fail."""
    runs = status(d)
    kind = F.right(F.col("entity_type"), F.lit(1)).cast("int")
    state = F.when(kind == 0, "success").when(kind == 1, "failed").otherwise("partial")
    results = runs.where(kind <= 2).select(
        "region_code", "entity_type", state.alias("sync_status"), F.when(kind > 0, "trouble").alias("error_message"),
        F.lit(10).cast("long").alias("records_processed"),
    )
    return runlog.finish_runs(runs, results, EVENT_CLOCK)


FINISH_CTE = f"""WITH {LATEST}, f AS (SELECT *, CAST(right(entity_type, 1) AS INT) AS k FROM status),
g AS (SELECT region_code, entity_type, CASE k WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'partial' ELSE sync_status END AS sync_status,
 sync_started_at, CASE WHEN k <= 2 THEN {EVENT_NOW} ELSE sync_completed_at END AS sync_completed_at,
 CASE WHEN k = 0 THEN {EVENT_NOW} ELSE last_successful_sync_at END AS last_successful_sync_at,
 CASE WHEN k <= 2 THEN 10 ELSE records_processed END AS records_processed, records_new, api_calls_made,
 CASE WHEN k = 0 THEN NULL WHEN k <= 2 THEN 'trouble' ELSE error_message END AS error_message, k FROM f)"""
check("run_log_transition", lambda d: finished_runs(d)[0], "runs", f"{FINISH_CTE} SELECT r.* EXCLUDE (k) REPLACE ({RUN_TIMES}) FROM g r")
check("run_log_history", lambda d: finished_runs(d)[1].select("region_code", "entity_type", "sync_status", "duration_seconds"), "runs",
      f"""{FINISH_CTE} SELECT region_code, entity_type, sync_status,
 {rnd("(epoch_us(sync_completed_at) - epoch_us(sync_started_at)) / 1000000.0::DOUBLE", 2)} AS duration_seconds FROM g WHERE k <= 2""")


def tenant_regions(d: Domain) -> DataFrame:
    return d["runs"].select("region_code").distinct().withColumn("tenant_id", F.lit("t1")).unionByName(
        d["regions"].select("region_code").withColumn("tenant_id", F.lit("t2")))


check("tenant_status", lambda d: runlog.tenant_status(tenant_regions(d), status(d).select(
    "region_code", "entity_type", "sync_status", "records_processed", F.lit(None).cast("timestamp").alias("sync_completed_at"), "error_message")),
      "runs regions", f"""
WITH {LATEST}, l AS (SELECT region_code, '[' || string_agg('{{"entity_type":"' || entity_type || '","sync_status":"' || sync_status ||
 '","records_processed":' || records_processed || CASE WHEN error_message IS NOT NULL THEN ',"error_message":"' || error_message || '"' ELSE '' END || '}}',
 ',' ORDER BY entity_type) || ']' AS entities FROM status GROUP BY 1),
t AS (SELECT DISTINCT region_code, 't1' AS tenant_id FROM runs UNION ALL SELECT region_code, 't2' FROM regions)
SELECT region_code, tenant_id, coalesce(entities, '[]') AS entities FROM t LEFT JOIN l USING (region_code)""")
SECONDS = "(epoch_us(sync_completed_at) - epoch_us(sync_started_at)) / 1000000.0::DOUBLE"
check("batch_summary", lambda d: runlog.batch_summary(d["runs"], ["region_code"]), "runs", f"""
SELECT region_code, count(*) AS total_jobs, {cnt("sync_status = 'success'")} AS successful, {cnt("sync_status <> 'success'")} AS failed,
 {rnd("(epoch_us(max(sync_completed_at)) - epoch_us(min(sync_started_at))) / 1000000.0::DOUBLE")} AS duration_seconds,
 {cnt(f"{SECONDS} > 300")} AS slow_runs FROM runs GROUP BY 1""")
check("sync_durations", lambda d: runlog.sync_durations(d["runs"], "r1", "entity_3"), "runs", f"""
SELECT region_code, entity_type, {stamp("r.sync_started_at")} AS sync_started_at, {stamp("r.sync_completed_at")} AS sync_completed_at,
 (epoch_us(r.sync_completed_at) - epoch_us(r.sync_started_at)) / 1000000.0::DOUBLE AS duration_seconds, records_processed
FROM runs r WHERE region_code = 'r1' AND entity_type = 'entity_3' ORDER BY r.sync_started_at DESC LIMIT 10""")
check("sync_volume_trend", lambda d: runlog.sync_volume_trend(d["runs"], EVENT_CLOCK), "runs", f"""
SELECT region_code, entity_type, avg(api_calls_made) AS avg_api_calls, avg(records_processed) AS avg_records, count(*) AS sync_count
FROM runs WHERE sync_status = 'success' AND sync_started_at > {EVENT_NOW} - INTERVAL 7 DAY GROUP BY 1, 2""")

# U: merge -----------------------------------------------------------------------------------------


def property_table(d: Domain) -> DataFrame:
    """Stored properties: nine in ten."""
    return d["properties"].where(F.col("id") % 10 != 0).select(
        "id", "property_id", "region_code", "property_name", "property_status", F.lit("2001-01-01").cast("timestamp").alias("updated_at"))


def property_batch(d: Domain) -> DataFrame:
    """A batch of new (0) and changed (1) properties; some come without an id."""
    k = F.col("id")
    return d["properties"].where(k % 10 < 2).select(
        F.when(k % 100 != 1, F.col("property_id")).alias("property_id"), "region_code",
        F.concat(F.upper("property_name"), F.lit("*")).alias("property_name"), F.lit("dirty").alias("property_status"))


def merged_properties(d: Domain, **options) -> DataFrame:
    return merge.upsert_parent(property_table(d), property_batch(d), ["property_id", "region_code"], stamp=CLOCK.timestamp(), **options)


def merge_sql(state: str) -> str:
    old, new = "id % 10 <> 0", "id % 10 = 1 AND id % 100 <> 1"
    return f"""
SELECT id, property_id, region_code, CASE WHEN {new} THEN upper(property_name) || '*' ELSE property_name END AS property_name,
 CASE WHEN {new} THEN {state} ELSE property_status END AS property_status,
 CASE WHEN {new} THEN {stamp(NOW)} ELSE '2001-01-01 00:00:00.000000' END AS updated_at, CASE WHEN {new} THEN 'update' ELSE 'keep' END AS op
FROM properties WHERE {old}
UNION ALL SELECT NULL, CASE WHEN id % 100 <> 1 THEN property_id END, region_code, upper(property_name) || '*', 'dirty', {stamp(NOW)}, 'insert'
FROM properties WHERE id % 10 = 0 OR id % 100 = 1"""


check("upsert_parent", merged_properties, "properties", merge_sql("'dirty'"))
check("upsert_parent_small_batch", lambda d: merged_properties(d, small_batch=True), "properties", merge_sql("'dirty'"))
check("owned_columns", lambda d: merged_properties(d, no_update=["property_status"]), "properties", merge_sql("property_status"))
check("upsert_counts", lambda d: merge.merge_counts(merged_properties(d)), "properties", f"""
SELECT {cnt("id % 10 = 0 OR id % 100 = 1")} AS inserted, {cnt("id % 10 = 1 AND id % 100 <> 1")} AS updated,
 count(*) + {cnt("id % 100 = 1")} AS table_rows FROM properties""")


def requirement_batch(d: Domain) -> DataFrame:
    """Incoming requirements by task api id; one task in seven is not stored."""
    rows = d["task_requirements"].withColumn("parent_api_id", F.col("task_pk").cast("string")).drop("task_pk")
    stored = d["tasks"].where(F.col("id") % 7 != 0).select("id", "task_id")
    return keys.require_key(rows, stored, {"parent_api_id": "task_id"}, "task_pk").drop("parent_api_id")


def child_upsert(d: Domain) -> DataFrame:
    """First of equal keys wins and updates stored rows (lines 1-2 are stored with an old response)."""
    stored = dedup.keep_first(d["task_requirements"].where("requirement_id IN ('1', '2')"), REQ_KEY, ["arrival"])
    target = stored.select("task_pk", "requirement_id", F.lit("old").alias("response"))
    return merge.upsert_child(target, requirement_batch(d), REQ_KEY, [F.col("arrival").asc()])


check("upsert_child", child_upsert, "task_requirements tasks", """
WITH f AS (SELECT * FROM task_requirements QUALIFY row_number() OVER (PARTITION BY task_pk, requirement_id ORDER BY id) = 1),
g AS (SELECT *, task_pk % 7 <> 0 AS fresh, requirement_id IN ('1', '2') AS stored FROM f)
SELECT task_pk, requirement_id, CASE WHEN fresh THEN response ELSE 'old' END AS response,
 CASE WHEN fresh AND stored THEN 'update' WHEN fresh THEN 'insert' ELSE 'keep' END AS op FROM g WHERE fresh OR stored""")


def bridge_upsert(d: Domain) -> DataFrame:
    """A bridge table of key columns only: known pairs are left alone."""
    target = d["task_tags"].where(F.col("task_pk") % 2 == 0)
    return merge.upsert_child(target, d["task_tags"], ["task_pk", "tag_pk"], [F.col("tag_pk").asc()])


check("upsert_bridge", bridge_upsert, "task_tags", "SELECT task_pk, tag_pk, CASE WHEN task_pk % 2 = 0 THEN 'keep' ELSE 'insert' END AS op FROM task_tags")
check("upsert_child_append", lambda d: merge.upsert_child(d["task_tags"], d["task_tags"], [], []), "task_tags",
      "SELECT *, 'keep' AS op FROM task_tags UNION ALL SELECT *, 'insert' FROM task_tags")
check("resolve_parent_fk", lambda d: requirement_rows(requirement_batch(d)), "task_requirements",
      f"SELECT {REQ_COLS} FROM task_requirements WHERE task_pk % 7 <> 0")
check("unresolved_parent_fk",
      lambda d: keys.unresolved_count(d["task_requirements"], d["tasks"].where(F.col("id") % 7 != 0), {"task_pk": "task_id"}),
      "task_requirements", "SELECT count(*) AS unresolved FROM task_requirements WHERE task_pk % 7 = 0")


def tag_links(d: Domain) -> DataFrame:
    known = d["tags"].where("tag_name <> 'Brand#1'").select(F.concat(F.lit("pk-"), "id").alias("id"), F.col("tag_name").alias("tag_id"))
    return keys.require_key(d["task_tags"].withColumnRenamed("tag_pk", "tag_id"), known, {"tag_id": "tag_id"}, "tag_pk").drop("tag_id")


check("resolve_tag_fk", tag_links, "task_tags", "SELECT task_pk, 'pk-' || tag_pk AS tag_pk FROM task_tags WHERE tag_pk <> 'Brand#1'")


def unkeyed_reservations(d: Domain) -> DataFrame:
    k = F.col("id")
    return d["reservations"].select(
        "reservation_id", F.when(k % 7 != 0, F.col("property_pk").cast("string")).alias("property_id"), "region_code",
        F.when(k % 2 == 0, F.lit(-1).cast("long")).alias("property_pk"))


check("fk_reservation_property",
      lambda d: keys.fill_key(unkeyed_reservations(d), active(d), {"property_id": "property_id", "region_code": "region_code"}, "property_pk"),
      "reservations properties", f"""SELECT reservation_id, CASE WHEN r.id % 7 <> 0 THEN {text("property_pk")} END AS property_id, r.region_code,
 CASE WHEN r.id % 2 = 0 THEN -1 WHEN r.id % 7 <> 0 AND p.id IS NOT NULL THEN property_pk END AS property_pk
FROM reservations r LEFT JOIN properties p ON p.id = r.property_pk AND p.property_status = 'active'""")


def homeless_tasks(d: Domain) -> DataFrame:
    k = F.col("id")
    return d["tasks"].select("task_id", F.col("property_pk").cast("string").alias("home_id"), "region_code",
                             F.when(k % 3 == 0, F.lit(-1).cast("long")).alias("property_pk"))


check("fk_task_property",
      lambda d: keys.fill_key(homeless_tasks(d), active(d), {"home_id": "property_id", "region_code": "region_code"}, "property_pk"),
      "tasks properties", f"""SELECT task_id, {text("property_pk")} AS home_id, t.region_code,
 CASE WHEN t.id % 3 = 0 THEN -1 WHEN p.id IS NOT NULL THEN property_pk END AS property_pk
FROM tasks t LEFT JOIN properties p ON p.id = t.property_pk AND p.property_status = 'active'""")


def unlinked_tasks(d: Domain) -> DataFrame:
    return d["tasks"].select("task_id", "region_code", F.col("reservation_pk").alias("linked_reservation_id"),
                             F.when(F.col("id") % 5 == 0, F.lit(-1).cast("long")).alias("reservation_pk"))


check("fk_task_reservation",
      lambda d: keys.fill_key(unlinked_tasks(d), d["reservations"], {"linked_reservation_id": "reservation_id", "region_code": "region_code"}, "reservation_pk"),
      "tasks reservations", """SELECT task_id, t.region_code, reservation_pk AS linked_reservation_id,
 CASE WHEN t.id % 5 = 0 THEN -1 ELSE r.id END AS reservation_pk
FROM tasks t LEFT JOIN reservations r ON r.id = t.reservation_pk AND r.region_code = t.region_code""")


def link_table(d: Domain) -> DataFrame:
    k = F.col("id")
    return d["tasks"].where(F.col("reservation_pk").isNotNull()).select(
        F.col("reservation_pk").cast("string").alias("reservation_id"), "task_id", "region_code", "task_name", "type_priority",
        F.when(k % 2 == 0, F.lit(-1).cast("long")).alias("reservation_pk"),
        F.when(k % 2 == 1, F.lit(-2).cast("long")).alias("task_pk"), "property_pk", "created_at", "scheduled_date", "rate_paid")


def resolved_links(d: Domain) -> DataFrame:
    live = d["reservations"].where("reservation_status = 'active'")
    one = keys.overwrite_key(link_table(d), live, {"reservation_id": "reservation_id", "region_code": "region_code"}, "reservation_pk")
    return keys.overwrite_key(one, d["tasks"], {"task_id": "task_id", "region_code": "region_code"}, "task_pk")


LINK_SQL = """SELECT CAST(t.reservation_pk AS VARCHAR) AS reservation_id, task_id, t.region_code, task_name, type_priority,
 coalesce(r.id, CASE WHEN t.id % 2 = 0 THEN -1 END) AS reservation_pk, t.id AS task_pk, t.property_pk, t.created_at, t.scheduled_date, t.rate_paid
FROM tasks t LEFT JOIN reservations r ON r.id = t.reservation_pk AND r.region_code = t.region_code AND r.reservation_status = 'active'
WHERE t.reservation_pk IS NOT NULL"""
check("fk_link_table", lambda d: resolved_links(d).select("reservation_id", "task_id", "region_code", "reservation_pk", "task_pk"),
      "tasks reservations", f"SELECT reservation_id, task_id, region_code, reservation_pk, task_pk FROM ({LINK_SQL})")


def upserted_links(d: Domain) -> DataFrame:
    stored = link_table(d).where(F.col("task_id").cast("long") % 4 != 0).select("reservation_id", "task_id", "region_code", "task_name")
    batch = link_table(d).where(F.col("task_id").cast("long") % 4 < 2).select(
        "reservation_id", "task_id", "region_code", F.concat("task_name", F.lit("!")).alias("task_name"))
    return merge.upsert_links(stored, batch)


check("upsert_link_rows", upserted_links, "tasks", f"""SELECT {text("reservation_pk")} AS reservation_id, task_id, region_code,
 task_name || CASE WHEN id % 4 < 2 THEN '!' ELSE '' END AS task_name, CASE id % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'keep' END AS op
FROM tasks WHERE reservation_pk IS NOT NULL""")


def doubled_links(d: Domain) -> DataFrame:
    """Each link of the batch comes twice; the greater name counts."""
    links = link_table(d).select("reservation_id", "task_id", "region_code", "task_name")
    batch = links.unionByName(links.withColumn("task_name", F.concat("task_name", F.lit("!"))))
    return merge.upsert_links(links.where(F.col("task_id").cast("long") % 2 == 0), batch)


check("upsert_link_duplicates", doubled_links, "tasks", f"""SELECT {text("reservation_pk")} AS reservation_id, task_id, region_code,
 task_name || '!' AS task_name, CASE id % 2 WHEN 0 THEN 'update' ELSE 'insert' END AS op FROM tasks WHERE reservation_pk IS NOT NULL""")


def dated_tasks(d: Domain) -> DataFrame:
    return d["tasks"].select("id", "property_pk", "region_code", "type_department", "scheduled_date", "checkin_date", "checkout_date",
                             F.when(F.col("id") % 3 == 0, F.col("id")).alias("reservation_pk"))


check("fk_task_reservation_by_dates",
      lambda d: keys.link_by_dates(dated_tasks(d), d["reservations"]).select("id", "reservation_pk"), "tasks reservations", """
WITH c AS (SELECT t.id, r.id AS rid, abs(date_diff('day', r.checkin_date, t.checkin_date)) AS away,
  CASE WHEN t.checkin_date = r.checkin_date AND t.checkout_date = r.checkout_date THEN 1
       WHEN t.type_department = 'housekeeping' AND t.scheduled_date BETWEEN r.checkin_date AND r.checkout_date + 1 THEN 2
       WHEN t.checkin_date <= r.checkout_date AND t.checkout_date >= r.checkin_date THEN 3 END AS rule
  FROM tasks t JOIN reservations r ON t.property_pk = r.property_pk AND t.region_code = r.region_code),
b AS (SELECT id, rid FROM c WHERE rule IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY rule, away, rid) = 1)
SELECT t.id, CASE WHEN t.id % 3 = 0 THEN t.id ELSE b.rid END AS reservation_pk FROM tasks t LEFT JOIN b USING (id)""")


def dimension(d: Domain) -> DataFrame:
    """Tenant regions: three are known (one active), all are submitted with a new name."""
    target = d["regions"].where("company_id < 103").select("region_code", F.lit("old").alias("display_name"), (F.col("company_id") == 100).alias("active"))
    batch = d["regions"].select("region_code", F.col("region_name").alias("display_name"))
    return merge.upsert_dimension(target, batch, ["region_code"], on_insert={"active": F.lit(False)}, keep=["active"])


check("upsert_dimension", dimension, "regions", """SELECT region_code, region_name AS display_name, company_id = 100 AS active,
 CASE WHEN company_id < 103 THEN 'update' ELSE 'insert' END AS op FROM regions""")


def activation(d: Domain) -> tuple[DataFrame, DataFrame]:
    places = nation_regions(d).select(F.col("tenant_id").cast("string").alias("tenant_id"), "region_code", F.lit(False).alias("active"))
    tenants = places.select(F.col("tenant_id").alias("id")).distinct().withColumn("status", F.lit("pending"))
    done = places.where(F.col("tenant_id") < "2").select("tenant_id", "region_code")
    return maintenance.activate_region(places, tenants, done)


check("activate_region", lambda d: activation(d)[0], "",
      f"SELECT {text('n_regionkey')} AS tenant_id, lower(n_name) AS region_code, n_regionkey < 2 AS active FROM nation")
check("activate_tenant", lambda d: activation(d)[1], "",
      f"SELECT DISTINCT {text('n_regionkey')} AS id, CASE WHEN n_regionkey < 2 THEN 'active' ELSE 'pending' END AS status FROM nation")

# U: reconciliation --------------------------------------------------------------------------------


def striking_tasks(d: Domain) -> DataFrame:
    k = F.col("id")
    return d["tasks"].select(
        "task_id", "region_code", F.col("property_pk").cast("string").alias("home_id"), "task_name", "scheduled_date",
        (k % 2).cast("int").alias("missing_strikes"),
        F.when(k % 2 == 1, F.lit("2001-07-01").cast("timestamp")).alias("missing_since"))


def findings(d: Domain) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Region europe listed nothing; one property in nine failed; a third of tasks is not listed."""
    k = F.col("id")
    here = d["tasks"].where("region_code <> 'europe'")
    listed = here.where(k % 3 != 0).select("region_code", "task_id")
    good = d["properties"].where(k % 9 != 0).select("region_code", F.col("property_id").alias("home_id"))
    verdict = F.when(k % 4 == 0, "present").when(k % 4 < 3, "deleted").otherwise("unknown")
    probes = here.where(k % 3 == 0).select("region_code", "task_id", verdict.alias("verdict"))
    return listed, good, probes


def reconciled(d: Domain) -> reconcile.Reconciled:
    return reconcile.reconcile_deletes(striking_tasks(d), *findings(d), CLOCK, 400, 30)


def stored_reconciled(d: Domain) -> DataFrame:
    """The same on a stored table; what was removed is in the audit."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    tasks = striking_tasks(d).withColumn("month", F.trunc("scheduled_date", "month"))
    store.write("tasks", tasks, "month", ranges=["scheduled_date"])
    runs.reconcile_stored_tasks(store, *findings(d), CLOCK, "month", 400, 30)
    kept = store.read("tasks").select("task_id", "region_code", "missing_strikes", F.lit(False).alias("removed"))
    audit = store.read("task_delete_audit")
    return kept.unionByName(audit.select("task_id", "region_code", F.lit(None).cast("int").alias("missing_strikes"), F.lit(True).alias("removed")))


ACTIONS = f"""a AS (SELECT id, task_id, region_code, {text("property_pk")} AS home_id, task_name, scheduled_date, {big("id % 2")} AS strikes,
 CASE WHEN id % 2 = 1 THEN TIMESTAMP '2001-07-01' END AS since,
 CASE WHEN NOT (scheduled_date BETWEEN DATE '2001-07-15' - 400 AND DATE '2001-07-15' + 30) OR property_pk % 9 = 0 OR region_code = 'europe' THEN 'keep'
      WHEN id % 3 <> 0 OR id % 4 = 0 THEN 'reset' WHEN id % 4 < 3 AND id % 2 = 1 THEN 'delete' WHEN id % 4 < 3 THEN 'strike' ELSE 'keep' END AS action
 FROM tasks)"""
check("reconcile_deletes", lambda d: reconciled(d).table, "tasks", f"""WITH {ACTIONS}
SELECT task_id, region_code, home_id, task_name, {text("scheduled_date")} AS scheduled_date,
 CASE action WHEN 'reset' THEN 0 WHEN 'strike' THEN strikes + 1 ELSE strikes END AS missing_strikes,
 {stamp(f"CASE action WHEN 'reset' THEN NULL WHEN 'strike' THEN coalesce(since, {NOW}) ELSE since END")} AS missing_since
FROM a WHERE action <> 'delete'""")
check("reconcile_stored_tasks", stored_reconciled, "tasks", f"""WITH {ACTIONS} SELECT task_id, region_code,
 CASE action WHEN 'reset' THEN 0 WHEN 'strike' THEN strikes + 1 WHEN 'delete' THEN NULL ELSE strikes END AS missing_strikes, action = 'delete' AS removed FROM a""")
check("reconcile_counts", lambda d: reconciled(d).counts, "tasks", f"WITH {ACTIONS} SELECT region_code, action, count(*) AS tasks FROM a GROUP BY 1, 2")
check("delete_audit", lambda d: reconciled(d).audit, "tasks", f"""WITH {ACTIONS}
SELECT {stamp(NOW)} AS deleted_at, region_code, task_id, task_name, {text("a.scheduled_date")} AS scheduled_date, 'confirmed missing on 2 successive runs' AS reason,
 '{{"task_id":"' || task_id || '","region_code":"' || region_code || '","home_id":"' || home_id || '","task_name":"' || task_name ||
 '","scheduled_date":"' || a.scheduled_date || '","missing_strikes":' || strikes || ',"missing_since":"2001-07-01T00:00:00.000Z"}}' AS task_row
FROM a WHERE action = 'delete'""")


def lifecycle(d: Domain, dry_run: bool = False, run=reconcile.reconcile_lifecycle):
    """Regions: asia's list is incomplete, europe's empty; states and ids move by key."""
    k = F.col("id")
    mirror = d["properties"].select(
        "property_id", "region_code",
        F.when(k % 5 == 0, "deleted").when(k % 5 == 1, "dirty").when(k % 5 == 2, "inactive").otherwise("active").alias("property_status"),
        F.when(k % 3 != 0, F.concat(F.lit("x"), "property_id")).alias("external_id"), F.lit("2001-01-01").cast("timestamp").alias("synced_at"))
    listed = d["properties"].where((k % 4 != 0) & (F.col("region_code") != "europe")).select(
        "region_code", "property_id", F.when(k % 7 < 3, "inactive").otherwise("active").alias("status"),
        F.when(k % 2 == 0, F.concat(F.lit("x"), "property_id")).alias("external_id"), k.alias("position"))
    complete = d["regions"].select("region_code", (F.col("region_code") != "asia").alias("complete"))
    return run(mirror, listed, complete, CLOCK, dry_run)


def stored_lifecycle(mirror: DataFrame, listed: DataFrame, complete: DataFrame, clock, dry_run: bool) -> tuple[DataFrame, DataFrame]:
    store = snapshot.SnapshotStore(mirror.sparkSession, scratch_path(mirror.sparkSession, "store"))
    store.write("properties", mirror, "region_code")
    counts = runs.reconcile_stored_properties(store, listed, complete, clock, dry_run)
    return store.read("properties"), counts


LIFE = """m AS (SELECT id, property_id, region_code, CASE id % 5 WHEN 0 THEN 'deleted' WHEN 1 THEN 'dirty' WHEN 2 THEN 'inactive' ELSE 'active' END AS st,
  CASE WHEN id % 3 <> 0 THEN 'x' || property_id END AS ext, id % 4 <> 0 AND region_code <> 'europe' AS hit,
  CASE WHEN id % 7 < 3 THEN 'inactive' ELSE 'active' END AS lst, CASE WHEN id % 2 = 0 THEN 'x' || property_id ELSE '' END AS lext FROM properties),
n AS (SELECT *, NOT hit AND region_code NOT IN ('europe', 'asia') AND st <> 'deleted' AS gone,
  hit AND lst <> st AND (lst IN ('inactive', 'deleted') OR st IN ('inactive', 'deleted')) AS moved, hit AND lext <> coalesce(ext, '') AS ext_moved FROM m)"""
LIFE_SQL = f"""WITH {LIFE}
SELECT property_id, region_code, CASE WHEN gone THEN 'deleted' WHEN moved THEN lst ELSE st END AS property_status,
 CASE WHEN ext_moved THEN lext ELSE ext END AS external_id, {stamp(f"CASE WHEN gone OR moved OR ext_moved THEN {NOW} ELSE TIMESTAMP '2001-01-01' END")} AS synced_at FROM n"""
check("reconcile_lifecycle", lambda d: lifecycle(d)[0], "properties", LIFE_SQL)
check("reconcile_stored_properties", lambda d: lifecycle(d, run=stored_lifecycle)[0], "properties", LIFE_SQL)
check("reconcile_lifecycle_report", lambda d: lifecycle(d, True)[1], "properties", f"""WITH {LIFE}
SELECT region_code, {cnt("moved")} AS status_fixed, {cnt("ext_moved")} AS external_fixed, {cnt("gone")} AS marked_deleted FROM n GROUP BY 1""")

# U: upkeep ----------------------------------------------------------------------------------------


def cascade(d: Domain, name: str) -> DataFrame:
    doomed = d["tasks"].where("task_status_stage = 'new'")
    links = d["task_assignments"].select("id", F.when(F.col("id") % 4 != 0, F.col("task_pk")).alias("task_pk"))
    return maintenance.cascade_delete(doomed, {"requirements": (requirement_rows(d["task_requirements"]), "task_pk")}, {"links": (links, "task_pk")})[name]


check("cascade_delete", lambda d: cascade(d, "requirements"), "task_requirements tasks",
      f"SELECT {REQ_COLS} FROM task_requirements WHERE task_pk NOT IN (SELECT id FROM tasks WHERE task_status_stage = 'new')")
check("cascade_set_null", lambda d: cascade(d, "links"), "task_assignments tasks", """SELECT id,
 CASE WHEN id % 4 <> 0 AND task_pk NOT IN (SELECT id FROM tasks WHERE task_status_stage = 'new') THEN task_pk END AS task_pk FROM task_assignments""")


def flagged_events(d: Domain) -> DataFrame:
    return d["change_events"].select("event_id", "received_at", (F.col("event_id") % 3 != 0).alias("processed"))


OLD = f"received_at < {EVENT_NOW} - INTERVAL 20 DAY"
check("retention", lambda d: maintenance.retain_events(flagged_events(d), EVENT_CLOCK, 20), "change_events",
      f"SELECT event_id, {stamp('e.received_at')} AS received_at, event_id % 3 <> 0 AS processed FROM change_events e WHERE NOT (e.{OLD} AND event_id % 3 <> 0)")
check("retention_report", lambda d: maintenance.retention_report(flagged_events(d), EVENT_CLOCK, 20), "change_events", f"""
SELECT count(*) AS total_events, {cnt(f"NOT ({OLD} AND event_id % 3 <> 0)")} AS keep_events, {cnt(f"{OLD} AND event_id % 3 <> 0")} AS delete_events FROM change_events""")
check("history_retention", lambda d: maintenance.retain_history(d["runs"], EVENT_CLOCK, days=10).select("region_code", "entity_type", "sync_started_at"),
      "runs", f"SELECT region_code, entity_type, {stamp('r.sync_started_at')} AS sync_started_at FROM runs r WHERE r.sync_started_at >= TIMESTAMP '2024-01-21'")
check("old_rows_report", lambda d: maintenance.old_rows_report(d["tasks"], CLOCK), "tasks",
      f"SELECT region_code, {cnt(f'created_at < {NOW} - INTERVAL 90 DAY')} AS old_rows, count(*) AS rows FROM tasks GROUP BY 1")


def tiered(d: Domain) -> DataFrame:
    """Months that ended 90 days ago go to the cold tier, once; late rows of January 2001 come beside it."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    rows = d["tasks"].select("id", "region_code", "created_at", F.trunc("created_at", "month").alias("created_month"))
    late = rows.where("created_month = DATE '2001-01-01'")
    store.write("tasks", rows.where("NOT (created_month = DATE '2001-01-01' AND id % 3 = 0)"), "created_month", key=["id", "created_month"])
    moved = runs.tier_stored(store, "tasks", CLOCK)
    before = store.folders("tasks")
    if runs.tier_stored(store, "tasks", CLOCK) or not moved:
        raise AssertionError("months are moved once")
    merge.upsert_table(store, "tasks", late, ["id", "created_month"], "created_month")
    if {v: f[:1] for v, f in before.items()} != {v: f[:1] for v, f in store.folders("tasks").items()}:
        raise AssertionError("a cold month was written again")
    counts = store.read("tasks").groupBy(F.col("created_month").cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"), F.max("created_at").alias("newest"))
    return store.tiers("tasks").select("part", "tier", "late").join(counts, "part")


check("tier_old_partitions", tiered, "tasks", f"""
SELECT {text("date_trunc('month', created_at)::DATE")} AS part, CASE WHEN date_trunc('month', created_at) < TIMESTAMP '2001-04-01' THEN 'cold' ELSE 'hot' END AS tier,
 CASE WHEN date_trunc('month', created_at) = TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END::BIGINT AS late, count(*) AS rows, {big("sum(id)")} AS ids,
 {stamp("max(created_at)")} AS newest FROM tasks GROUP BY ALL""")


def stored_log(d: Domain) -> snapshot.SnapshotStore:
    """All events in the stored log, day by day in two batches; the second is sent twice."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    log = flagged_events(d).select("event_id", F.lit("task").alias("event_kind"), "received_at", "processed")
    for number, part in ((0, log.where("event_id % 2 = 0")), (1, log.where("event_id % 2 = 1")), (1, log.where("event_id % 2 = 1"))):
        with store.begin() as change:
            ev.write_log(change, part, ("stream", number))
    return store


def retained(d: Domain) -> DataFrame:
    """Retention on the stored log writes only the dropped rows of days that keep some, and none of whole days."""
    store = stored_log(d)
    before = store.folders("event_log")
    report = runs.retain_stored_events(store, EVENT_CLOCK, 20)
    after = store.folders("event_log")
    if any(f[: len(before[v])] != before[v] for v, f in after.items()):
        raise AssertionError("a kept row was written again")
    deleted = report.first()["delete_events"]
    return store.read("event_log").select("event_id", "received_at", "processed", F.lit(deleted).alias("deleted"))


check("retention_stored", retained, "change_events", f"""SELECT event_id, {stamp('e.received_at')} AS received_at, event_id % 3 <> 0 AS processed,
 (SELECT {cnt(f"{OLD} AND event_id % 3 <> 0")} FROM change_events) AS deleted
FROM change_events e WHERE NOT (e.{OLD} AND event_id % 3 <> 0)""")


def dropped_history(d: Domain) -> DataFrame:
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    history = d["runs"].select("region_code", "entity_type", "sync_started_at", F.to_date("sync_started_at").alias("started_day"))
    store.write("sync_history", history, "started_day")
    before = store.folders("sync_history")
    runs.retain_stored_history(store, EVENT_CLOCK, days=10)
    if any(before[v] != f for v, f in store.folders("sync_history").items()):
        raise AssertionError("a kept day was written again")
    return store.read("sync_history").drop("started_day")


check("history_retention_stored", dropped_history, "runs",
      f"SELECT region_code, entity_type, {stamp('r.sync_started_at')} AS sync_started_at FROM runs r WHERE r.sync_started_at >= TIMESTAMP '2024-01-21'")


def cascaded(d: Domain) -> DataFrame:
    """Every seventh property goes, with its reservations; its tasks stay without a property."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("properties", d["properties"].select("id", "region_code"), "region_code")
    store.write("reservations", d["reservations"].select("id", "property_pk", "region_code"), "region_code")
    tasks = d["tasks"].select("id", "property_pk", F.trunc("created_at", "month").alias("created_month"))
    store.write("tasks", tasks, "created_month")
    number = store.snapshot().number
    runs.cascade_stored(store, "properties", d["properties"].where("id % 7 = 0").select("id"), {"reservations": "property_pk"}, {"tasks": "property_pk"})
    if store.snapshot().number != number + 1:
        raise AssertionError("the cascade is one commit")
    return store.read("properties").select(F.lit("properties").alias("tbl"), "id", F.lit(None).cast("long").alias("property_pk")).unionByName(
        store.read("reservations").select(F.lit("reservations").alias("tbl"), "id", "property_pk")).unionByName(
        store.read("tasks").select(F.lit("tasks").alias("tbl"), "id", "property_pk"))


check("cascade_stored", cascaded, "properties reservations tasks", """
SELECT 'properties' AS tbl, id, CAST(NULL AS BIGINT) AS property_pk FROM properties WHERE id % 7 <> 0
UNION ALL SELECT 'reservations', id, property_pk FROM reservations WHERE property_pk % 7 <> 0
UNION ALL SELECT 'tasks', id, CASE WHEN property_pk % 7 <> 0 THEN property_pk END FROM tasks""")
STALE = f"sync_status = 'running' AND r.sync_started_at < {EVENT_NOW} - INTERVAL 1 HOUR"
check("fail_stale_runs", lambda d: maintenance.fail_stale_runs(d["runs"], EVENT_CLOCK, "gone"), "runs", f"""
SELECT * REPLACE (CASE WHEN {STALE} THEN 'failed' ELSE sync_status END AS sync_status, {stamp("r.sync_started_at")} AS sync_started_at,
 {stamp(f"CASE WHEN {STALE} THEN {EVENT_NOW} ELSE r.sync_completed_at END")} AS sync_completed_at,
 {stamp("r.last_successful_sync_at")} AS last_successful_sync_at, CASE WHEN {STALE} THEN 'gone' ELSE error_message END AS error_message) FROM runs r""")
check("purge_run_log", lambda d: maintenance.purge_run_log(d["runs"], EVENT_CLOCK).select("region_code", "entity_type", "sync_status"), "runs", f"""
SELECT region_code, entity_type, sync_status FROM runs WHERE NOT (sync_status IN ('success', 'failed') AND sync_started_at < {EVENT_NOW} - INTERVAL 7 DAY)""")

# X: export ----------------------------------------------------------------------------------------


def synced(df: DataFrame, key: str = "id") -> DataFrame:
    """Sync times spread over ten days by key; some rows were never synced."""
    k = F.col(key).cast("long")
    at = F.timestamp_micros(F.unix_micros(CLOCK.timestamp()) - (k % 10) * 86_400_000_000)
    return df.withColumn("synced_at", F.when(k % 13 != 0, at))


def watermarks(d: Domain, table: str) -> DataFrame:
    """Marks three days back, but for two regions without one."""
    return d["regions"].where(~F.col("region_code").isin("asia", "africa")).select(
        F.lit(table).alias("table_name"), "region_code", CLOCK.hours_ago(72).alias("last_pushed_at"), F.lit(5).cast("long").alias("rows_pushed"))


def changed_properties(d: Domain) -> DataFrame:
    return export.changed_since(synced(d["properties"]), watermarks(d, "property_dim"), "property_dim")


def fresh(key: str = "id") -> str:
    return f"(region_code IN ('asia', 'africa') OR ({key} % 13 <> 0 AND {key} % 10 < 3))"


check("changed_since", lambda d: changed_properties(d).select("property_id", "region_code"), "properties",
      f"SELECT property_id, region_code FROM properties WHERE {fresh()}")
check("advance_watermark",
      lambda d: export.advance_watermarks(watermarks(d, "property_dim"), changed_properties(d), "property_dim",
                                          d["regions"].where("region_code = 'europe'")),
      "regions properties", f"""
WITH n AS (SELECT region_code, max(id % 13 <> 0 AND id % 10 = 0) AS today, count(*) AS c FROM properties WHERE {fresh()} AND region_code <> 'europe' GROUP BY 1)
SELECT 'property_dim' AS table_name, r.region_code, {stamp(f"CASE WHEN n.c IS NOT NULL THEN {NOW} ELSE {NOW} - INTERVAL 72 HOUR END")} AS last_pushed_at,
 coalesce(n.c, 0) + CASE WHEN region_code IN ('asia', 'africa') THEN 0 ELSE 5 END AS rows_pushed FROM regions r LEFT JOIN n USING (region_code)""")


def full_properties(d: Domain) -> DataFrame:
    none = F.lit(None).cast("string")
    k = F.col("id")
    return synced(d["properties"]).withColumns({
        "reference_external_property_id": F.when(k % 2 == 0, k * 3), "reference_company_id": k % 7, "property_zipcode": 10_000 + k,
        "property_address1": none, "property_address2": none, "property_state": none, "bedrooms": (k % 5).cast("int"),
        "bathrooms": (k % 3).cast("int"), "wifi_password": none})


EXPORT_DIM = f"""SELECT region_code, property_id AS source_property_id, CASE WHEN id % 2 = 0 THEN {text("id * 3")} END AS listing_id,
 {text("id % 7")} AS reference_company_id, property_name, property_status, CAST(NULL AS VARCHAR) AS property_address1,
 CAST(NULL AS VARCHAR) AS property_address2, property_city, CAST(NULL AS VARCHAR) AS property_state, {text("10000 + id")} AS property_zipcode,
 latitude_numeric AS latitude, longitude_numeric AS longitude, id % 5 AS bedrooms, id % 3 AS bathrooms, wifi_name AS wifi_ssid,
 CAST(NULL AS VARCHAR) AS wifi_password, CASE WHEN id % 13 <> 0 THEN strftime({NOW} - to_days(CAST(id % 10 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') END AS source_synced_at
FROM properties WHERE {fresh()}"""
check("export_property_dim", lambda d: export.export_properties(full_properties(d), watermarks(d, "property_dim")), "properties", EXPORT_DIM)


def pushed_twice(d: Domain) -> DataFrame:
    """All rows go out first; a day later only rows synced since; each row carries the number of its push."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    out = scratch_path(d.spark, "pushed")
    table = synced(d["properties"]).select("property_id", "region_code", "synced_at")
    store.write("properties", table, "region_code")
    for n in (1, 2):
        runs.push_changes(
            store, "properties", "property_dim", lambda rows, marks: export.changed_since(rows, marks, "property_dim"),
            lambda rows, n=n: rows.withColumn("push", F.lit(n)).write.mode("append").parquet(out))
        later = F.when(F.col("property_id").cast("long") % 4 == 0, CLOCK.timestamp() + F.expr("INTERVAL 1 DAY")).otherwise(F.col("synced_at"))
        store.write("properties", durable(store.read("properties").withColumn("synced_at", later)), "region_code")
    return d.spark.read.parquet(out).select("property_id", "region_code", "push")


check("push_changes", pushed_twice, "properties", """SELECT property_id, region_code, 1 AS push FROM properties
UNION ALL SELECT property_id, region_code, 2 FROM properties WHERE id % 4 = 0""")


def pushed_in_chunks(d: Domain) -> DataFrame:
    """Chunks go out from the tasks; the target takes none of region asia on the first day. A day later a quarter of the rows
    are synced anew: asia's come all, the others' only those."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    table = synced(d["properties"]).select("property_id", "region_code", "synced_at")
    store.write("properties", table, "region_code")
    reports = []

    def send_first(region: str, chunk: list[str]) -> None:
        if region == "asia" or len(chunk) > 50:
            raise ConnectionError("not now")

    for push in (send_first, lambda region, chunk: None):
        def sink(rows: DataFrame, push=push) -> DataFrame:
            reports.append(runs.send_chunks(export.json_payload(rows, ["region_code"]), push, 50))
            return reports[-1]

        runs.push_changes(store, "properties", "property_dim", lambda rows, marks: export.changed_since(rows, marks, "property_dim"), sink)
        later = F.when(F.col("property_id").cast("long") % 4 == 0, CLOCK.timestamp() + F.expr("INTERVAL 1 DAY")).otherwise(F.col("synced_at"))
        store.write("properties", durable(store.read("properties").withColumn("synced_at", later)), "region_code")
    totals = [r.groupBy("region_code").agg(F.sum("sent").alias(f"sent_{n}"), F.sum("failed").alias(f"failed_{n}")) for n, r in enumerate(reports, 1)]
    marks = store.read("push_marks").select("region_code", "last_pushed_at", "rows_pushed")
    return totals[0].join(totals[1], "region_code").join(marks, "region_code")


check("push_failed_region", pushed_in_chunks, "properties", f"""
WITH c AS (SELECT region_code, count(*) AS n, {cnt("id % 4 = 0")} AS again FROM properties GROUP BY 1)
SELECT region_code, {big("CASE WHEN region_code = 'asia' THEN 0 ELSE n END")} AS sent_1, {big("CASE WHEN region_code = 'asia' THEN n ELSE 0 END")} AS failed_1,
 {big("CASE WHEN region_code = 'asia' THEN n ELSE again END")} AS sent_2, 0::BIGINT AS failed_2, {stamp(f"{NOW} + INTERVAL 1 DAY")} AS last_pushed_at,
 {big("CASE WHEN region_code = 'asia' THEN n ELSE n + again END")} AS rows_pushed FROM c""")


def payloads(d: Domain) -> DataFrame:
    rows = export.export_rows(full_properties(d), ["property_id", "region_code", "property_zipcode", "synced_at", "wifi_name"],
                              export.PROPERTY_RENAMES, export.PROPERTY_TEXT)
    return export.json_payload(rows, ["source_property_id"])


check("json_payload_sink", payloads, "properties", f"""SELECT property_id AS source_property_id,
 '{{"source_property_id":"' || property_id || '","region_code":"' || region_code || '","property_zipcode":"' || (10000 + id) || '","source_synced_at":' ||
 CASE WHEN id % 13 <> 0 THEN '"' || strftime({NOW} - to_days(CAST(id % 10 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') || '"' ELSE 'null' END ||
 ',"wifi_ssid":' || coalesce('"' || wifi_name || '"', 'null') || '}}' AS payload FROM properties""")


def link_export(d: Domain) -> DataFrame:
    table = durable(resolved_links(d))
    present = set(table.columns)
    blank = {c: F.lit(None).cast("string") for c in export.LINK_COLUMNS if c not in present and c != "synced_at"}
    rows = synced(table.withColumns(blank), "task_id")
    out = export.export_links(rows, folded_source(d), watermarks(d, "reservation_tasks"))
    return out.select("region_code", "reservation_id", "source_task_id", "reservation_pk", "task_pk", "task_name", "type_priority",
                      "scheduled_date", "rate_paid", "part", "requirements")


check("export_link_rows", link_export, "tasks reservations task_requirements", f"""
WITH l AS ({LINK_SQL}), f AS ({FOLD_SQL})
SELECT region_code, reservation_id, task_id AS source_task_id, reservation_pk, l.task_pk, task_name, type_priority, {text("l.scheduled_date")} AS scheduled_date,
 CAST(rate_paid AS DOUBLE) AS rate_paid, coalesce(part, 0) AS part, requirements
FROM l LEFT JOIN f ON f.task_pk = l.task_pk WHERE {fresh("l.task_pk")}""")

# Events -------------------------------------------------------------------------------------------


def companies(d: Domain) -> DataFrame:
    return d["regions"].select("company_id", "region_code")


def task_events(d: Domain) -> DataFrame:
    resolved = ev.resolve_region(ev.normalise_task_events(d["change_events"]), companies(d))
    return durable(resolved.drop("payload"))


def live_tasks(d: Domain, *extra: str) -> DataFrame:
    return d["tasks"].select("task_id", "region_code", F.lit("old").alias("task_status"), "started_at", "finished_at",
                             F.lit("2001-01-01").cast("timestamp").alias("synced_at"), *extra)


check("normalise_task_event", lambda d: ev.normalise_task_events(d["change_events"]).drop("payload"), "change_events", f"""
SELECT event_id, {stamp("e.received_at")} AS received_at, task_id, company_id, action, nullif(status, '') AS status,
 {stamp("e.started_at")} AS started_at, {stamp("e.finished_at")} AS finished_at FROM change_events e""")


def flat_events(d: Domain) -> DataFrame:
    """Task events with the task's fields at the top level, and a status object."""
    k = F.col("event_id")
    body = F.struct(
        F.lit("task_updated").alias("event"), k.alias("task_id"), (k % 5).alias("company_id"),
        F.struct(F.when(k % 2 == 0, "c9").alias("code"), F.lit("Named").alias("name")).alias("status"))
    return d["change_events"].select("event_id", "received_at", F.to_json(body).alias("payload"))


check("normalise_flat_task_event", lambda d: ev.normalise_task_events(flat_events(d)).select("event_id", "task_id", "company_id", "action", "status"),
      "change_events", f"""SELECT event_id, {text("event_id")} AS task_id, nullif(event_id % 5, 0) AS company_id, 'task_updated' AS action,
 CASE WHEN event_id % 2 = 0 THEN 'c9' ELSE 'Named' END AS status FROM change_events""")


def property_events(d: Domain) -> DataFrame:
    """Property-status events: the property is the event's number modulo 500."""
    k = F.col("event_id")
    body = F.struct(
        (k % 500).alias("property_id"), F.when(k % 6 == 0, k % 5 + 100).alias("company_id"),
        F.when(k % 7 != 0, F.concat(F.lit("s"), (k % 4).cast("string"))).alias("status"),
        _items(k % 3, lambda i: F.struct((i == 1).alias("is_blocking"))).alias("sub_statuses"))
    return d["change_events"].select("event_id", "received_at", F.to_json(body).alias("payload"))


def resolved_property_events(d: Domain) -> DataFrame:
    return ev.resolve_region(ev.normalise_property_events(property_events(d)), companies(d), d["properties"])


PROPERTY_EVENTS = """pe AS (SELECT event_id, received_at, CAST(event_id % 500 AS VARCHAR) AS property_id,
  CASE WHEN event_id % 6 = 0 THEN event_id % 5 + 100 END AS company_id, CASE WHEN event_id % 7 <> 0 THEN 's' || (event_id % 4) END AS status,
  CASE WHEN event_id % 3 > 0 THEN 1 ELSE 0 END::BIGINT AS blocking_count,
  CASE event_id % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[{"is_blocking":true}]' ELSE '[{"is_blocking":true},{"is_blocking":false}]' END AS sub_statuses FROM change_events),
pr AS (SELECT pe.*, coalesce(r.region_code, p.region_code, 'unknown') AS region_code FROM pe LEFT JOIN regions r USING (company_id)
  LEFT JOIN properties p ON p.property_id = pe.property_id)"""
check("normalise_property_event",
      lambda d: ev.normalise_property_events(property_events(d)).drop("payload", "received_at"), "change_events regions properties", f"""WITH {PROPERTY_EVENTS}
SELECT event_id, property_id, company_id, 'property_status_changed' AS action, status, CAST(NULL AS VARCHAR) AS external_property_id,
 blocking_count, blocking_count > 0 AS is_blocking, sub_statuses FROM pe""")
check("resolve_event_region", lambda d: resolved_property_events(d).select("event_id", "property_id", "region_code"),
      "change_events regions properties", f"WITH {PROPERTY_EVENTS} SELECT event_id, property_id, region_code FROM pr")

UPDATES = """e AS (SELECT c.*, coalesce(r.region_code, 'unknown') AS region_code FROM change_events c LEFT JOIN regions r USING (company_id)),
u AS (SELECT task_id, region_code, arg_max(status, (received_at, event_id)) FILTER (WHERE status <> '') AS st,
  arg_max(started_at, (received_at, event_id)) FILTER (WHERE started_at IS NOT NULL) AS sa,
  arg_max(finished_at, (received_at, event_id)) FILTER (WHERE finished_at IS NOT NULL) AS fa
  FROM e WHERE action <> 'task-deleted' AND region_code <> 'unknown' GROUP BY 1, 2)"""
UPDATED = f"""SELECT t.task_id, t.region_code, coalesce(st, 'old') AS task_status, {stamp("coalesce(sa, t.started_at)")} AS started_at,
 {stamp("coalesce(fa, t.finished_at)")} AS finished_at, {stamp(f"CASE WHEN u.task_id IS NULL THEN TIMESTAMP '2001-01-01' ELSE {EVENT_NOW} END")} AS synced_at
FROM tasks t LEFT JOIN u ON u.task_id = t.task_id AND u.region_code = t.region_code"""
KILLED = """NOT EXISTS (SELECT 1 FROM e WHERE e.action = 'task-deleted' AND e.task_id = t.task_id
 AND (e.region_code = 'unknown' OR e.region_code = t.region_code))"""
EVENT_TABLES = "change_events regions tasks"
check("event_update_task", lambda d: ev.apply_task_updates(live_tasks(d), task_events(d), EVENT_CLOCK), EVENT_TABLES, f"WITH {UPDATES} {UPDATED}")
check("event_delete_task", lambda d: ev.apply_task_deletes(live_tasks(d), task_events(d)).select("task_id", "region_code"), EVENT_TABLES,
      f"WITH {UPDATES} SELECT task_id, region_code FROM tasks t WHERE {KILLED}")
check("event_apply", lambda d: ev.apply_task_events(live_tasks(d), task_events(d), EVENT_CLOCK), EVENT_TABLES, f"WITH {UPDATES} {UPDATED} WHERE {KILLED}")


def property_mirror(d: Domain) -> DataFrame:
    return d["properties"].select("property_id", "region_code", "property_status", F.lit("2001-01-01").cast("timestamp").alias("synced_at"))


MIRROR_SQL = f"""WITH {PROPERTY_EVENTS},
l AS (SELECT property_id, region_code, arg_max(status, (received_at, event_id)) AS st FROM pr WHERE status IS NOT NULL AND region_code <> 'unknown' GROUP BY 1, 2)
SELECT p.property_id, p.region_code, coalesce(st, property_status) AS property_status,
 {stamp(f"CASE WHEN st IS NULL THEN TIMESTAMP '2001-01-01' ELSE {EVENT_NOW} END")} AS synced_at
FROM properties p LEFT JOIN l ON l.property_id = p.property_id AND l.region_code = p.region_code"""
check("event_update_property", lambda d: ev.apply_property_events(property_mirror(d), resolved_property_events(d), EVENT_CLOCK),
      "change_events regions properties", MIRROR_SQL)
STATUS_COLS = "region_code, property_id, event_id, status, blocking_count, is_blocking"
STATUS_SQL = f"""WITH {PROPERTY_EVENTS} SELECT region_code, property_id, event_id, status, blocking_count, blocking_count > 0 AS is_blocking FROM pr
WHERE region_code <> 'unknown' QUALIFY row_number() OVER (PARTITION BY region_code, property_id ORDER BY received_at DESC, event_id DESC) = 1"""
check("export_property_status", lambda d: export.latest_property_status(resolved_property_events(d)).select(*STATUS_COLS.split(", ")),
      "change_events regions properties", STATUS_SQL)


def with_tests(events: DataFrame) -> DataFrame:
    """One event in a hundred is a connection test."""
    test = F.lit('{"event":"test_webhook_event"}')
    return events.withColumn("payload", F.when(F.col("event_id") % 100 == 0, test).otherwise(F.col("payload")))


def logged(d: Domain) -> DataFrame:
    events = ev.drop_test_events(with_tests(d["change_events"]))
    log = ev.event_log(ev.resolve_region(ev.normalise_task_events(events), companies(d)), "task", "task_id")
    return log.select("event_id", "event_kind", "region_code", "company_id", "entity_id", "event_action")


LOG_SQL = """SELECT event_id, 'task' AS event_kind, r.region_code, company_id, task_id AS entity_id, action AS event_action
FROM change_events LEFT JOIN regions r USING (company_id) WHERE event_id % 100 <> 0"""
check("event_log_append", logged, "change_events regions", LOG_SQL)
check("recent_events", lambda d: ev.recent_events(d["change_events"]).select("event_id"), "change_events",
      "SELECT event_id FROM change_events ORDER BY received_at DESC, event_id DESC LIMIT 50")


def landed_events(d: Domain, events: DataFrame) -> DataFrame:
    """Events landed as JSON files week by week, as many as there are cores, and read back as a stream of several batches."""
    path = scratch_path(d.spark, "events")
    files = max(2, d.spark.sparkContext.defaultParallelism)
    week = F.floor(F.datediff("received_at", F.lit("2024-01-01")) / 8)
    for n in range(4):
        part = events.where(week == n) if n < 3 else events.where(week >= n)
        part.select("event_id", "received_at", "payload").repartition(files).write.mode("append").json(path)
    return ev.read_event_stream(d.spark, path, max_files=files)


def streamed_tasks(d: Domain) -> DataFrame:
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    by_year = live_tasks(d, "created_month").withColumn("year", F.year("created_month")).drop("created_month")
    store.write("tasks", by_year, "year", key=["task_id", "region_code", "year"], finder="task_id")
    events = landed_events(d, with_tests(d["change_events"]))
    ev.start_task_stream(events, store, companies(d), EVENT_CLOCK, scratch_path(d.spark, "ckpt"), column="year").awaitTermination()
    if max(len(p.folders) for p in store.snapshot().state("tasks").parts.values()) != 1:
        raise AssertionError("a year was written again")
    return store.read("tasks").drop("year")


def compacted_tasks(d: Domain) -> DataFrame:
    """The same after changes and rows have been merged."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    rows = live_tasks(d, "created_month")
    store.write("tasks", rows, "created_month", key=["task_id", "region_code", "created_month"], finder="task_id")
    stream = landed_events(d, with_tests(d["change_events"]))
    ev.start_task_stream(stream, store, companies(d), EVENT_CLOCK, scratch_path(d.spark, "ckpt")).awaitTermination()
    store.compact("tasks", most=0)
    if any(p.changes for p in store.snapshot().state("tasks").parts.values()):
        raise AssertionError("changes are left")
    return store.read("tasks").drop("created_month")


STREAM_SQL = f"WITH {UPDATES.replace('FROM change_events c', 'FROM (SELECT * FROM change_events WHERE event_id % 100 <> 0) c')} {UPDATED} WHERE {KILLED}"
check("event_apply_stream", streamed_tasks, EVENT_TABLES, STREAM_SQL)
check("event_apply_compacted", compacted_tasks, EVENT_TABLES, STREAM_SQL)


def streamed_properties(d: Domain) -> snapshot.SnapshotStore:
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("properties", property_mirror(d), "region_code")
    stream = landed_events(d, property_events(d))
    ev.start_property_stream(stream, store, companies(d), d["properties"], EVENT_CLOCK, scratch_path(d.spark, "ckpt")).awaitTermination()
    return store


check("property_status_stream", lambda d: streamed_properties(d).read("property_status").select(*STATUS_COLS.split(", ")), "change_events regions properties", STATUS_SQL)

check("event_update_property_stream", lambda d: streamed_properties(d).read("properties"), "change_events regions properties", MIRROR_SQL)

# Roll-ups -----------------------------------------------------------------------------------------
DONE = "task_status_stage = 'finished'"


def rollup_sql(unit: str) -> str:
    states = "" if unit == "month" else f"""{cnt("task_status_stage = 'new'")} AS tasks_new, {cnt("task_status_stage = 'in_progress'")} AS tasks_in_progress,"""
    return f"""SELECT {stamp(f"date_trunc('{unit}', created_at)::TIMESTAMP")} AS bucket, region_code, type_department, count(*) AS tasks_created,
 {cnt(DONE)} AS tasks_completed, {states} {cnt("type_priority = 'urgent'")} AS urgent_tasks, {cnt("type_priority = 'high'")} AS high_tasks,
 count(DISTINCT finished_by_id) AS unique_workers, avg(us_total) FILTER (WHERE {DONE}) / 3600000000.0::DOUBLE AS avg_hours_to_complete FROM tasks"""


check("cagg_daily", lambda d: rollups.task_rollup(d["tasks"]), "tasks", f"{rollup_sql('day')} GROUP BY ALL")
check("cagg_monthly", lambda d: rollups.task_rollup(d["tasks"], "month"), "tasks", f"{rollup_sql('month')} GROUP BY ALL")


def refreshed(d: Domain) -> DataFrame:
    """A stored roll-up that lacks late tasks, refreshed from noon to noon: whole days only."""
    stored = rollups.task_rollup(d["tasks"].where(F.col("id") % 2 == 0))
    return rollups.refresh_range(stored, d["tasks"], datetime(2001, 5, 1, 12), datetime(2001, 7, 10, 12))


IN_RANGE = "created_at >= TIMESTAMP '2001-05-02' AND created_at < TIMESTAMP '2001-07-10'"
check("cagg_refresh_range", refreshed, "tasks", f"""{rollup_sql("day")} WHERE {IN_RANGE} GROUP BY ALL
UNION ALL {rollup_sql("day")} WHERE NOT ({IN_RANGE}) AND id % 2 = 0 GROUP BY ALL""")


def tail(d: Domain) -> DataFrame:
    stored = rollups.task_rollup(d["tasks"].where(F.col("id") % 2 == 0), "month")
    return rollups.real_time(stored, d["tasks"], datetime(2001, 4, 1), "month")


check("cagg_real_time", tail, "tasks", f"""{rollup_sql("month")} WHERE created_at >= TIMESTAMP '2001-04-01' GROUP BY ALL
UNION ALL {rollup_sql("month")} WHERE created_at < TIMESTAMP '2001-04-01' AND id % 2 = 0 GROUP BY ALL""")


def midmonth(d: Domain) -> DataFrame:
    """Refreshed up to the middle of April: April is not stored whole, so it is computed anew."""
    stored = rollups.task_rollup(d["tasks"].where((F.col("id") % 2 == 0) & (F.col("created_at") < "2001-04-01")), "month")
    return rollups.real_time(stored, d["tasks"], datetime(2001, 4, 15, 7), "month")


check("cagg_real_time_midmonth", midmonth, "tasks", f"""{rollup_sql("month")} WHERE created_at >= TIMESTAMP '2001-04-01' GROUP BY ALL
UNION ALL {rollup_sql("month")} WHERE created_at < TIMESTAMP '2001-04-01' AND id % 2 = 0 GROUP BY ALL""")


def emptied(d: Domain) -> DataFrame:
    """A stored daily roll-up after all tasks of one week were deleted and the month was refreshed."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    rollups.write_refreshed(d["tasks"], store, "task_days", datetime(2001, 5, 1), datetime(2001, 7, 1))
    gone = F.col("created_at").between("2001-05-08", "2001-05-14 23:59:59.999999")
    rollups.write_refreshed(d["tasks"].where(~gone), store, "task_days", datetime(2001, 5, 1), datetime(2001, 6, 1))
    return store.read("task_days").drop("bucket_day")


check("cagg_refresh_emptied", emptied, "tasks", f"""{rollup_sql("day")} WHERE created_at >= TIMESTAMP '2001-05-01' AND created_at < TIMESTAMP '2001-07-01'
 AND NOT (created_at >= TIMESTAMP '2001-05-08' AND created_at < TIMESTAMP '2001-05-15') GROUP BY ALL""")


ROLLUP_TASKS = "created_at finished_at region_code type_department type_priority task_status_stage finished_by_id created_month".split()


def month_rollup(tasks: DataFrame) -> DataFrame:
    return rollups.task_rollup(tasks).withColumn("created_month", F.trunc("bucket", "month"))


def incremental(d: Domain) -> DataFrame:
    """A stored daily roll-up of a stored table without the third of May's tasks; once they are there, only May is read."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    tasks = d["tasks"].withColumn("created_month", F.trunc("created_at", "month")).select("id", *ROLLUP_TASKS)
    late = (F.col("created_month") == "2001-05-01") & (F.col("id") % 3 == 0)
    store.write("tasks", tasks.where(~late), "created_month")
    first = rollups.refresh_changed(store, "tasks", "task_days", month_rollup)
    store.replace("tasks", tasks.where("created_month = DATE '2001-05-01'"), ["2001-05-01"])
    again = [rollups.refresh_changed(store, "tasks", "task_days", month_rollup) for _ in range(2)]
    if again != [["2001-05-01"], []] or len(first) < 2:
        raise AssertionError(f"refreshed {first}, then {again}")
    return store.read("task_days").drop("created_month")


check("cagg_refresh_changed", incremental, "tasks", f"{rollup_sql('day')} GROUP BY ALL")


def rollup_stream(d: Domain) -> DataFrame:
    """Closed day buckets of a task stream; the last day stays open until the watermark passes it."""
    source, out = scratch_path(d.spark, "tasks"), scratch_path(d.spark, "rollup")
    columns = ["created_at", "finished_at", "region_code", "type_department", "type_priority", "task_status_stage", "finished_by_id"]
    tasks = d["tasks"].select(*columns)
    tasks.write.parquet(source)
    stream = d.spark.readStream.schema(tasks.schema).parquet(source)
    rollups.start_rollup_stream(stream, out, scratch_path(d.spark, "ckpt")).awaitTermination()
    return d.spark.read.parquet(out)


check("cagg_stream", rollup_stream, "tasks", f"""SELECT * FROM ({rollup_sql("day")} GROUP BY ALL)
WHERE bucket::TIMESTAMP + INTERVAL 1 DAY <= (SELECT max(created_at) - INTERVAL 1 DAY FROM tasks)""")

# Sinks --------------------------------------------------------------------------------------------


def snapshots(d: Domain) -> DataFrame:
    """Two versions of a table; readers get the second, partitioned by region."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("properties", property_table(d))
    store.write("properties", merged_properties(d).drop("op"), "region_code")
    return store.read("properties")


check("snapshot_sink", snapshots, "properties", f"SELECT * EXCLUDE (op) FROM ({merge_sql(chr(39) + 'dirty' + chr(39))})")


def partial_upsert(d: Domain) -> DataFrame:
    """A batch for two regions is merged into the stored table; the other regions are not rewritten."""
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("properties", property_table(d), "region_code")
    batch = property_batch(d).where("region_code IN ('asia', 'europe')")
    merge.upsert_table(store, "properties", batch, ["property_id", "region_code"], "region_code", stamp=CLOCK.timestamp())
    return store.read("properties")


check("upsert_touched_partitions", partial_upsert, "properties", f"""
SELECT * EXCLUDE (op) FROM ({merge_sql("'dirty'")}) WHERE region_code IN ('asia', 'europe')
UNION ALL SELECT id, property_id, region_code, property_name, property_status, '2001-01-01 00:00:00.000000' FROM properties
WHERE id % 10 <> 0 AND region_code NOT IN ('asia', 'europe')""")


def csv_back(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "csv")
    snapshot.csv_extract(runlog.sync_recent(d["runs"], EVENT_CLOCK), path, [F.col("sync_started_at").desc()])
    return d.spark.read.option("header", True).csv(path).select("region_code", "entity_type", "sync_status", "sync_started_at", "records_processed")


check("csv_extract", csv_back, "runs", f"""SELECT region_code, entity_type, sync_status, {stamp("r.sync_started_at")} AS sync_started_at,
 {text("records_processed")} AS records_processed FROM runs r WHERE r.sync_started_at > {EVENT_NOW} - INTERVAL 24 HOUR""")


def fanout(d: Domain) -> DataFrame:
    batch = d["tasks"].select("task_id", "region_code", F.when(
        (F.col("region_code") == "asia") & (F.col("id") % 1000 == 0), "bad record").alias("error"))
    store = snapshot.SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    report = snapshot.load_all_regions(batch, store, "tasks")
    loaded = store.read("tasks").groupBy("region_code").agg(F.count(F.lit(1)).alias("loaded"))
    return report.join(loaded, "region_code", "left").fillna(0, ["loaded"])


check("region_fanout", fanout, "tasks", f"""
WITH x AS (SELECT region_code, count(*) AS records, {cnt("region_code = 'asia' AND id % 1000 = 0")} AS errors FROM tasks GROUP BY 1)
SELECT *, CASE WHEN errors > 0 THEN 'bad record' END AS error_message, CASE WHEN errors > 0 THEN 'failed' ELSE 'success' END AS sync_status,
 CASE WHEN errors > 0 THEN 0 ELSE records END AS loaded FROM x""")
