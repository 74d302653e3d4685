"""Checks of the sources and of the record, child and link transforms (S and T operators)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import landed
from checks.binding import CLOCK, Domain
from checks.registry import big, check, text
from fieldstay.functions import parsing
from fieldstay.operators import links, records, runs
from fieldstay.operators.entities import ENTITIES, PROPERTY_CONTACTS, TASK_CHILDREN, child_schema, record_schema
from fieldstay.session import scratch_path
from fieldstay.sources import pages
from fieldstay.sources.snapshot import SnapshotStore

PROPERTIES, TASKS, RESERVATIONS = ENTITIES["properties"], ENTITIES["tasks"], ENTITIES["reservations"]


def property_records(d: Domain) -> DataFrame:
    return pages.unwrap_pages(landed.property_pages(d), record_schema(PROPERTIES))


def task_records(d: Domain) -> DataFrame:
    return pages.unwrap_pages(landed.task_pages(d), record_schema(TASKS))


def mapped_properties(d: Domain) -> DataFrame:
    return records.map_parents(property_records(d), PROPERTIES, CLOCK.timestamp())


def mapped_tasks(d: Domain) -> DataFrame:
    return records.map_parents(task_records(d), TASKS, CLOCK.timestamp())


def children(d: Domain, name: str) -> DataFrame:
    return records.explode_children(task_records(d), TASKS, name).drop("arrival")


def child_pages(d: Domain, name: str, raw: DataFrame) -> DataFrame:
    child = TASK_CHILDREN[name]
    parents = d["tasks"].select("region_code", "task_id", F.col("created_at").cast("string").alias("created_at"))
    elements = pages.unwrap_child_pages(raw, child_schema(child))
    return records.map_child_pages(elements, parents, child).drop("arrival")


# Pages: every fiftieth key is delivered twice in one page.
P = "p AS (SELECT *, id AS k FROM properties), pp AS (SELECT p.*, 0 AS pos FROM p UNION ALL SELECT p.*, 1 FROM p WHERE k % 50 = 0)"
TT = "q AS (SELECT *, id AS k FROM tasks), tt AS (SELECT q.*, 0 AS pos FROM q UNION ALL SELECT q.*, 1 FROM q WHERE k % 50 = 0)"
P_NAME = "property_name || CASE WHEN pos = 1 THEN ' copy' ELSE '' END"
T_NAME = "task_name || CASE WHEN pos = 1 THEN ' copy' ELSE '' END"
P_STATUS = "CASE WHEN k % 13 <> 0 THEN property_status END"

check("unwrap_pages", lambda d: property_records(d).select("region_code", "page", "pos", F.col("record.id").alias("id"), F.col("record.name").alias("name")),
      "properties", f"WITH {P} SELECT region_code, k AS page, {big('pos')} AS pos, property_id AS id, {P_NAME} AS name FROM pp")
check("unwrap_child_pages",
      lambda d: pages.unwrap_child_pages(landed.comment_pages(d), child_schema(TASK_CHILDREN["comments"]))
      .select("region_code", "parent_id", "pos", F.col("record.id").alias("id")),
      "tasks", f"""SELECT region_code, task_id AS parent_id, i - 1 AS pos, {text('id * 10 + i')} AS id
FROM tasks, unnest(range(1, id % 3 + 1)) u(i) WHERE id % 29 <> 0""")
check("per_parent_records",
      lambda d: pages.unwrap_raw(pages.pages_of_known_parents(landed.task_pages(d), d["properties"].where("property_status = 'active'")))
      .select("region_code", "page", "pos"),
      "properties tasks", f"""WITH {TT} SELECT tt.region_code, k AS page, {big('pos')} AS pos FROM tt
WHERE property_pk IN (SELECT id FROM properties WHERE property_status = 'active')""")


def touched(d: Domain) -> DataFrame:
    return pages.recently_touched(mapped_tasks(d), CLOCK, 35).select("task_id", "page", "pos")


check("child_fetch_window", touched, "tasks", f"""WITH {TT} SELECT task_id, k AS page, {big('pos')} AS pos FROM tt
WHERE k % 41 = 0 OR k % 43 = 0 OR created_at >= TIMESTAMP '2001-07-15 12:00:00' - INTERVAL 35 DAY""")
check("reservation_scope", lambda d: pages.reservation_scope(d["reservations"], date(2001, 6, 1)).select("reservation_id", "region_code"),
      "reservations", """SELECT reservation_id, region_code FROM reservations
WHERE checkin_date >= DATE '2001-06-01' OR checkout_date >= DATE '2001-06-01'""")
check("reservation_scope_latest", lambda d: pages.reservation_scope(d["reservations"], date(2001, 1, 1), limit=25).select("reservation_id", "checkin_date"),
      "reservations", f"""SELECT reservation_id, {text('r.checkin_date')} AS checkin_date FROM reservations r
WHERE checkin_date >= DATE '2001-01-01' OR checkout_date >= DATE '2001-01-01'
ORDER BY r.checkin_date DESC NULLS LAST, reservation_id LIMIT 25""")


def incremental(d: Domain) -> DataFrame:
    """Tasks updated (created) after the last success of their region; two regions never succeeded."""
    status = d["regions"].where(~F.col("region_code").isin("asia", "europe")).select(
        "region_code", F.lit("tasks").alias("entity_type"), F.lit("2000-01-01").cast("timestamp").alias("last_successful_sync_at")
    )
    return pages.since_last_success(d["tasks"], status, "tasks", "created_at").select("task_id", "region_code")


check("incremental_since_last_success", incremental, "tasks", """SELECT task_id, region_code FROM tasks
WHERE region_code IN ('asia', 'europe') OR created_at > TIMESTAMP '2000-01-01'""")

# Parents ------------------------------------------------------------------------------------------
check("map_parent_fields",
      lambda d: mapped_properties(d).select("region_code", "page", "pos", "property_id", "property_name", "property_status",
                                            "property_city", "property_display", "bedrooms", "synced_at"),
      "properties", f"""WITH {P} SELECT region_code, k AS page, {big('pos')} AS pos, property_id, {P_NAME} AS property_name,
 {P_STATUS} AS property_status, property_city, k % 2 = 0 AS property_display, k % 5 AS bedrooms,
 '2001-07-15 12:00:00.000000' AS synced_at FROM pp""")
check("map_nested_fields",
      lambda d: mapped_properties(d).select("page", "pos", "property_notes_general", "property_notes_wifi", "property_notes_access"),
      "properties", f"""WITH {P} SELECT k AS page, {big('pos')} AS pos, CASE WHEN k % 3 <> 0 THEN 'about ' || property_id END AS property_notes_general,
 CASE WHEN k % 3 <> 0 THEN wifi_name END AS property_notes_wifi, CAST(NULL AS VARCHAR) AS property_notes_access FROM pp""")
check("map_nested_task_fields",
      lambda d: mapped_tasks(d).select("page", "pos", "task_status_code", "task_status_stage", "task_status_name", "finished_by_id",
                                       "finished_by_name", "linked_reservation_id"),
      "tasks", f"""WITH {TT} SELECT k AS page, {big('pos')} AS pos, CASE WHEN k % 17 <> 0 THEN 'c1' END AS task_status_code,
 CASE WHEN k % 17 <> 0 THEN task_status_stage END AS task_status_stage, CAST(NULL AS VARCHAR) AS task_status_name,
 finished_by_id, finished_by_name, CASE WHEN k % 3 = 1 THEN {text('k - 1')} END AS linked_reservation_id FROM tt""")
check("coerce_coordinates", lambda d: mapped_properties(d).select("page", "pos", "latitude_numeric", "longitude_numeric"),
      "properties", f"""WITH {P} SELECT k AS page, {big('pos')} AS pos, CASE k % 6 WHEN 3 THEN 0.0 WHEN 4 THEN 12.5 WHEN 5 THEN -7.25 END::DOUBLE AS latitude_numeric,
 CAST(NULL AS DOUBLE) AS longitude_numeric FROM pp""")
check("coerce_company_id", lambda d: mapped_properties(d).select("page", "pos", "company_id"),
      "properties", f"WITH {P} SELECT k AS page, {big('pos')} AS pos, CASE k % 4 WHEN 1 THEN 101 WHEN 2 THEN 102 END::BIGINT AS company_id FROM pp")
RATE = "CASE k % 7 WHEN 0 THEN 50.25 WHEN 3 THEN 0.0 WHEN 5 THEN 12.5 {zero}END::DOUBLE"
check("parse_currency", lambda d: mapped_tasks(d).select("page", "pos", "rate_paid"),
      "tasks", f"WITH {TT} SELECT k AS page, {big('pos')} AS pos, {RATE.format(zero='')} AS rate_paid FROM tt")


def rates(d: Domain) -> DataFrame:
    raw = d["tasks"].select("id", landed.pick(F.col("id"), "50.25 USD", "abc", "0", "0.00 USD", " 7 EUR x", "").alias("t"))
    return raw.select("id", parsing.amount(F.col("t")).alias("rate"))


check("parse_link_rate", rates, "tasks", """SELECT id, CASE id % 6 WHEN 0 THEN 50.25 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 4 THEN 7.0 END::DOUBLE AS rate FROM tasks""")
check("filter_source_status",
      lambda d: records.with_status(property_records(d), "active").select("page", "pos"),
      "properties", f"WITH {P} SELECT k AS page, {big('pos')} AS pos FROM pp WHERE k % 13 <> 0 AND property_status = 'active'")
check("dedup_first_parent",
      lambda d: records.transform_parents(property_records(d), PROPERTIES, CLOCK.timestamp()).select("property_id", "region_code", "property_name"),
      "properties", f"WITH {P} SELECT property_id, region_code, property_name FROM p WHERE k % 13 <> 0 AND property_status = 'active'")
check("transform_tasks",
      lambda d: records.transform_parents(task_records(d), TASKS, CLOCK.timestamp())
      .select("task_id", "region_code", "home_id", "task_name", "created_at", "type_department", "rate_paid"),
      "tasks", f"""WITH {TT} SELECT task_id, region_code, {text('property_pk')} AS home_id, task_name,
 CASE WHEN k % 41 = 0 THEN 'not a date' WHEN k % 43 <> 0 THEN strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
 type_department, {RATE.format(zero='')} AS rate_paid FROM q""")

# Children -----------------------------------------------------------------------------------------
check("explode_children", lambda d: children(d, "assignments").select("region_code", "parent_api_id", "assignee_name"),
      "tasks", f"WITH {TT} SELECT region_code, task_id AS parent_api_id, 'W' || i AS assignee_name FROM tt, unnest(range(1, k % 3 + 1)) u(i)")
check("child_property_photos", lambda d: records.explode_children(property_records(d), PROPERTIES, "photos").drop("arrival"),
      "properties", f"""WITH {P} SELECT region_code, property_id AS parent_api_id, {text('k * 10 + i')} AS photo_id, 'photo ' || i AS caption,
 i = 1 AS is_default, CAST(NULL AS VARCHAR) AS original_url, 'u/' || i AS url
FROM pp, unnest(range(1, k % 4 + 1)) u(i) WHERE k % 10 <> 9 AND k % 13 <> 0 AND property_status = 'active'""")
check("child_task_photos", lambda d: children(d, "photos"), "tasks", f"""WITH {TT}
SELECT region_code, task_id AS parent_api_id, {text('k * 10 + 1')} AS photo_id, 'u' AS url, CAST(NULL AS VARCHAR) AS caption,
 CAST(NULL AS VARCHAR) AS uploaded_at FROM tt WHERE k % 2 = 1""")


def guests(d: Domain) -> DataFrame:
    recs = pages.unwrap_pages(landed.guest_pages(d), record_schema(RESERVATIONS))
    return records.explode_children(recs, RESERVATIONS, "guests").drop("arrival")


check("child_guests", guests, "reservations", """
WITH r AS (SELECT *, 0 AS pos FROM reservations UNION ALL SELECT *, 1 FROM reservations WHERE id % 50 = 0)
SELECT region_code, reservation_id AS parent_api_id, CASE WHEN (id + i) % 3 = 0 THEN 'G' || i END AS guest_name,
 CASE WHEN (id + i) % 3 = 1 THEN 'g@example.org' END AS guest_email, CAST(NULL AS VARCHAR) AS guest_phone, i = 1 AS is_primary
FROM r, unnest(range(1, id % 4 + 1)) u(i) WHERE (id + i) % 3 < 2""")
check("child_assignments", lambda d: children(d, "assignments"), "tasks", f"""WITH {TT}
SELECT region_code, task_id AS parent_api_id, CASE WHEN i = 1 THEN {text('(k + i) % 20')} ELSE '' END AS assignee_id,
 'W' || i AS assignee_name, CAST(NULL AS VARCHAR) AS assigned_at FROM tt, unnest(range(1, k % 3 + 1)) u(i)""")
check("child_comments", lambda d: child_pages(d, "comments", landed.comment_pages(d)), "tasks", f"""
SELECT region_code, task_id AS parent_api_id, {text('id * 10 + i')} AS comment_id, 'note ' || i AS comment,
 CASE WHEN i = 1 THEN '7' ELSE '' END AS author_id, CASE WHEN i = 1 THEN 'Ann' END AS author_name,
 strftime(t.created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, CAST(NULL AS VARCHAR) AS updated_at
FROM tasks t, unnest(range(1, id % 3 + 1)) u(i) WHERE id % 29 <> 0""")
check("child_requirements", lambda d: child_pages(d, "requirements", landed.requirement_pages(d)), "tasks", f"""
SELECT region_code, task_id AS parent_api_id, {text('id * 10 + i')} AS requirement_id, 'S' || (i % 2) AS section_name,
 CASE id % 7 WHEN 2 THEN '{{"a":1}}' WHEN 3 THEN '"x"' WHEN 5 THEN '["a","b"]' END AS action, 'ok' AS response,
 'check' AS type_requirement, id % 2 = 0 AS photo_required, CASE WHEN id % 3 = 0 THEN '["p"]' END AS photos,
 CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS home_element_name, strftime(t.created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM tasks t, unnest(range(1, id % 3 + 1)) u(i) WHERE id % 29 <> 0""")
check("child_task_tags", lambda d: children(d, "task_tags"), "tasks", f"""WITH {TT}
SELECT region_code, task_id AS parent_api_id, 'Brand#' || (k % 30) AS tag_id FROM tt WHERE k % 3 >= 1""")
check("child_task_supplies",
      lambda d: children(d, "supplies").select("region_code", "parent_api_id", "supply_usage_id", "name", "quantity", "unit_cost", "total_price", "billable"),
      "tasks", f"""WITH {TT} SELECT region_code, task_id AS parent_api_id, {text('k * 100 + 1')} AS supply_usage_id, 'soap' AS name,
 CASE k % 4 WHEN 0 THEN 2.5 WHEN 1 THEN 3.0 END::DOUBLE AS quantity, CASE k % 3 WHEN 0 THEN 1.0 WHEN 2 THEN 4.75 END::DOUBLE AS unit_cost,
 CAST(NULL AS DOUBLE) AS total_price, k % 4 = 1 AS billable FROM tt WHERE k % 2 = 1""")
check("child_task_costs",
      lambda d: children(d, "costs").select("region_code", "parent_api_id", "cost_id", "cost", "type_cost_id", "type_cost_code", "type_cost_name"),
      "tasks", f"""WITH {TT} SELECT region_code, task_id AS parent_api_id, {text('k * 100 + i')} AS cost_id,
 CASE k % 4 WHEN 0 THEN 10.5 WHEN 1 THEN 7.0 WHEN 3 THEN 0.0 END::DOUBLE AS cost, CASE WHEN i = 1 THEN '1' END AS type_cost_id,
 CASE WHEN i = 1 THEN 'labor' END AS type_cost_code, CAST(NULL AS VARCHAR) AS type_cost_name
FROM tt, unnest(range(1, k % 3 + 1)) u(i)""")
check("child_contacts",
      lambda d: records.map_child_pages(pages.unwrap_child_pages(landed.contact_pages(d), child_schema(PROPERTY_CONTACTS)),
                                        d["properties"], PROPERTY_CONTACTS).drop("arrival"),
      "properties", f"""SELECT region_code, property_id AS parent_api_id, {text('id * 10 + i')} AS contact_id, 'owner' AS contact_type,
 'C' || i AS name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone FROM properties, unnest(range(1, id % 3 + 1)) u(i)""")


def inherited(d: Domain) -> DataFrame:
    """Requirements of which some lack created_at, and some have no stored task."""
    rows = d["task_requirements"].withColumn(
        "created_at", F.when(F.col("task_pk") % 2 == 0, F.lit("1999-01-01").cast("timestamp"))
    )
    parents = d["tasks"].where(F.col("id") % 5 != 0)
    return records.inherit_partition(rows, parents).select("task_pk", "requirement_id", "created_at")


check("inherit_partition_column", inherited, "tasks task_requirements", """
SELECT q.task_pk, q.requirement_id, strftime(CASE WHEN q.task_pk % 2 = 0 THEN TIMESTAMP '1999-01-01'
 ELSE coalesce(t.created_at, TIMESTAMP '2020-01-01') END, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM task_requirements q LEFT JOIN tasks t ON q.task_pk = t.id AND t.id % 5 <> 0""")
check("widen_types", lambda d: records.widen_types(d["tasks"].select("id", "rate_paid"), {"rate_paid": "decimal(15,4)", "id": "string"}),
      "tasks", f"SELECT {text('id')} AS id, CAST(rate_paid AS DOUBLE) AS rate_paid FROM tasks")
check("keep_known_external_ids",
      lambda d: records.keep_known_external_ids(d["properties"].select("id", F.col("wifi_name").alias("external_id")),
                                                d["properties"].where("id < 3").select(F.col("wifi_name").alias("listing_id")), "external_id"),
      "properties", "SELECT id, wifi_name AS external_id FROM properties WHERE wifi_name IN (SELECT wifi_name FROM properties WHERE id < 3)")


def delimited(d: Domain) -> DataFrame:
    k = F.col("id")
    n = F.sequence(F.lit(1).cast("long"), k % 3 + 1)
    ids = F.concat_ws("", F.transform(n, lambda i: F.concat((k * 10 + i).cast("string"), F.lit("--x--"))))
    urls = F.concat_ws("", F.transform(n, lambda i: F.concat(F.when(i == 2, "").otherwise(F.concat(F.lit("u"), i.cast("string"))), F.lit("--x--"))))
    legacy = d["properties"].select("property_id", ids.alias("photo_id"), urls.alias("url"))
    return records.split_delimited_columns(legacy, ["photo_id", "url"], ["property_id"])


check("split_delimited_columns", delimited, "properties", f"""SELECT property_id, i - 1 AS pos, {text('id * 10 + i')} AS photo_id,
 CASE WHEN i <> 2 THEN 'u' || i END AS url FROM properties, unnest(range(1, id % 3 + 2)) u(i)""")


# Links, folding, blocking -------------------------------------------------------------------------
def raw_links(d: Domain) -> DataFrame:
    rows = d["tasks"].where(F.col("reservation_pk").isNotNull())
    k = F.col("id")
    record = F.when(k % 19 == 0, F.lit('{"name":"no id"}')).otherwise(landed.task_record(F.col("task_name")))
    return rows.select("region_code", F.col("reservation_pk").alias("reservation_id"), record.alias("record"))


def all_links(d: Domain) -> DataFrame:
    return links.link_rows(raw_links(d), CLOCK.timestamp())


check("link_row",
      lambda d: all_links(d).select("region_code", "reservation_id", "task_id", "home_id", "task_name", "task_status_stage", "scheduled_date",
                                    "task_created_at", "rate_paid", "assignments", "tags", "report_url",
                                    (F.length("raw_payload") > 0).alias("has_payload")),
      "tasks", f"""SELECT region_code, {text('reservation_pk')} AS reservation_id, task_id, {text('property_pk')} AS home_id, task_name,
 CASE WHEN id % 17 <> 0 THEN task_status_stage END AS task_status_stage, {text('t.scheduled_date')} AS scheduled_date,
 CASE WHEN id % 41 <> 0 AND id % 43 <> 0 THEN strftime(t.created_at, '%Y-%m-%d %H:%M:%S.%f') END AS task_created_at,
 CASE id % 7 WHEN 0 THEN 50.25 WHEN 2 THEN 0.0 WHEN 3 THEN 0.0 WHEN 5 THEN 12.5 END::DOUBLE AS rate_paid,
 CASE id % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[{{"assignee_id":' || ((id + 1) % 20) || ',"name":"W1"}}]' END AS assignments,
 '[]' AS tags, CAST(NULL AS VARCHAR) AS report_url, true AS has_payload
FROM tasks t WHERE reservation_pk IS NOT NULL AND id % 19 <> 0""")


def folded_source(d: Domain) -> DataFrame:
    none = F.lit(None).cast("string")
    return d["task_requirements"].select(
        "task_pk", "requirement_id",
        F.when(F.col("task_pk") % 4 != 0, F.col("section_name")).alias("section_name"), none.alias("action"),
        F.col("response"), none.alias("type_requirement"), "photo_required", none.alias("note"), none.alias("home_element_name"),
    )


def folded(d: Domain) -> DataFrame:
    return links.fold_requirements(folded_source(d))


FOLD_SQL = """
SELECT task_pk, 0::BIGINT AS part, '[' || string_agg(
  '{"requirement_id":"' || requirement_id || '"' || CASE WHEN s IS NOT NULL THEN ',"section_name":"' || s || '"' ELSE '' END ||
  CASE WHEN response IS NOT NULL THEN ',"response":"' || response || '"' ELSE '' END || ',"photo_required":' || photo_required || '}', ','
  ORDER BY s NULLS LAST, requirement_id, response NULLS LAST, photo_required) || ']' AS requirements
FROM (SELECT *, CASE WHEN task_pk % 4 <> 0 THEN section_name END AS s FROM task_requirements) GROUP BY 1"""
check("fold_requirements", folded, "task_requirements", FOLD_SQL)


def blocking(d: Domain) -> DataFrame:
    k = F.col("id")
    item = landed._items(k % 4, lambda i: F.struct(
        (i % 2 == 1).alias("is_blocking"),
        F.when(i > 1, landed._items(i, lambda j: F.struct((j % 2 == 0).alias("is_blocking")))).alias("tasks"),
    ))
    rows = d["properties"].select("property_id", F.when(k % 7 != 0, F.to_json(item)).alias("sub_statuses"))
    n = links.count_blocking(F.from_json("sub_statuses", links.SUB_STATUS))
    return rows.select("property_id", n.alias("blocking_count"), (n > 0).alias("is_blocking"))


check("count_blocking", blocking, "properties", """
WITH b AS (SELECT property_id, CASE WHEN id % 7 = 0 THEN 0 ELSE CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 4 END END::BIGINT AS n FROM properties)
SELECT property_id, n AS blocking_count, n > 0 AS is_blocking FROM b""")
PART_SQL = """
SELECT task_pk, CAST(pos // 2 AS BIGINT) AS part, '[' || string_agg('{"requirement_id":"' || requirement_id || '"' ||
  CASE WHEN s IS NOT NULL THEN ',"section_name":"' || s || '"' ELSE '' END || CASE WHEN response IS NOT NULL THEN ',"response":"' || response || '"' ELSE '' END ||
  ',"photo_required":' || photo_required || '}', ',' ORDER BY pos) || ']' AS requirements
FROM (SELECT *, row_number() OVER (PARTITION BY task_pk ORDER BY s NULLS LAST, requirement_id, response NULLS LAST, photo_required) - 1 AS pos
  FROM (SELECT *, CASE WHEN task_pk % 4 <> 0 THEN section_name END AS s FROM task_requirements)) GROUP BY ALL"""
check("fold_requirements_parts", lambda d: links.fold_requirements(folded_source(d), part_rows=2), "task_requirements", PART_SQL)


def loaded_links(d: Domain) -> DataFrame:
    """Links of odd tasks are loaded on one day, all links on the next, with stored reservations and tasks as keys."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    store.write("reservations", d["reservations"].select("id", "reservation_id", "region_code"), "region_code")
    store.write("tasks", d["tasks"].select("id", "task_id", "region_code"), "region_code")
    records = raw_links(d)
    runs.load_links(store, records.where(F.col("reservation_id") % 2 == 1), CLOCK)
    counts = runs.load_links(store, records, CLOCK)
    rows = store.read("reservation_tasks").groupBy("region_code").agg(
        F.count(F.lit(1)).alias("links"), F.count("reservation_pk").alias("with_reservation"), F.count("task_pk").alias("with_task"))
    return rows.join(counts, "region_code")


check("load_links", loaded_links, "tasks reservations", """
SELECT t.region_code, count(*) AS links, count(r.id) AS with_reservation, count(*) AS with_task,
 count(*) FILTER (WHERE reservation_pk % 2 = 0) AS inserted, count(*) FILTER (WHERE reservation_pk % 2 = 1) AS updated
FROM tasks t LEFT JOIN reservations r ON r.id = t.reservation_pk AND r.region_code = t.region_code
WHERE reservation_pk IS NOT NULL AND t.id % 19 <> 0 GROUP BY 1""")
