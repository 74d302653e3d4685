"""Checks of whole entity loads, and of the entities that have only a transform."""

from __future__ import annotations

from unittest import mock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks import landed
from checks.binding import CLOCK, Domain
from checks.registry import big, check, stamp, text
from fieldstay.functions.times import Clock
from fieldstay.operators import load, records, runs
from fieldstay.operators.entities import ENTITIES, record_schema
from fieldstay.operators.load import load_entity
from fieldstay.session import scratch_path
from fieldstay.sources.pages import unwrap_pages
from fieldstay.sources.snapshot import SnapshotStore

EARLIER = Clock(CLOCK.now.replace(day=14))
LISTED = "property_status = 'active' AND id % 13 <> 0"


def loaded_properties(d: Domain) -> SnapshotStore:
    """All properties on the first day; a third of them again, renamed, on the second."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    pages = landed.property_pages(d)
    load_entity(store, "properties", pages, EARLIER)
    again = pages.where(F.col("page") % 3 == 0).withColumn("body", F.replace("body", F.lit("Customer#"), F.lit("House ")))
    load_entity(store, "properties", again, CLOCK)
    return store


def property_result(d: Domain) -> DataFrame:
    table = loaded_properties(d).read("properties")
    return table.select("property_id", "region_code", "property_name", "company_id", "latitude_numeric", "property_notes_wifi", "updated_at")


check("load_properties", property_result, "properties", f"""
SELECT property_id, region_code, CASE WHEN id % 3 = 0 THEN replace(property_name, 'Customer#', 'House ') ELSE property_name END AS property_name,
 CASE id % 4 WHEN 1 THEN 101 WHEN 2 THEN 102 END::BIGINT AS company_id,
 CASE id % 6 WHEN 3 THEN 0.0 WHEN 4 THEN 12.5 WHEN 5 THEN -7.25 END::DOUBLE AS latitude_numeric,
 CASE WHEN id % 3 <> 0 THEN wifi_name END AS property_notes_wifi,
 CASE WHEN id % 3 = 0 THEN {stamp("TIMESTAMP '2001-07-15 12:00:00'")} ELSE {stamp("TIMESTAMP '2001-07-14 12:00:00'")} END AS updated_at
FROM properties WHERE {LISTED}""")
check("load_property_photos", lambda d: _photos(loaded_properties(d)), "properties", f"""
SELECT property_id, {text("id * 10 + i")} AS photo_id, i = 1 AS is_default FROM properties, unnest(range(1, id % 4 + 1)) u(i)
WHERE {LISTED} AND id % 10 <> 9""")


def _photos(store: SnapshotStore) -> DataFrame:
    owners = store.read("properties").select(F.col("id").alias("property_pk"), "property_id")
    return store.read("property_photos").join(owners, "property_pk").select("property_id", "photo_id", "is_default")


def loaded_tasks(d: Domain) -> DataFrame:
    """Tasks of listed properties with their key and the number of their costs and requirements."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    load_entity(store, "properties", landed.property_pages(d), EARLIER)
    load_entity(store, "tasks", landed.task_pages(d), CLOCK, {"requirements": landed.requirement_pages(d)})
    homes = store.read("properties").select(F.col("id").alias("property_pk"), "property_id")

    def children(table: str) -> DataFrame:
        return store.read(table).groupBy(F.col("task_pk").alias("id")).agg(F.count(F.lit(1)).alias(f"{table}_rows"))

    tasks = store.read("tasks").join(homes, "property_pk", "left")
    for table in ("task_costs", "task_requirements"):
        tasks = tasks.join(children(table), "id", "left").fillna(0, [f"{table}_rows"])
    return tasks.select("task_id", "region_code", "home_id", "property_id", "task_name", "created_at", "task_costs_rows", "task_requirements_rows")


# Costs carry their own created_at; requirements come with the stored task's month.
check("load_tasks", loaded_tasks, "tasks properties", f"""
SELECT task_id, t.region_code, {text("property_pk")} AS home_id, p.property_id, task_name,
 CASE WHEN t.id % 41 <> 0 AND t.id % 43 <> 0 THEN {stamp("t.created_at")} END AS created_at, t.id % 3 AS task_costs_rows,
 CASE WHEN t.id % 29 <> 0 THEN t.id % 3 ELSE 0 END AS task_requirements_rows
FROM tasks t JOIN properties p ON p.id = t.property_pk WHERE {LISTED.replace("id %", "p.id %")}""")


def broken_load(d: Domain) -> DataFrame:
    """One region sends a page that is cut off: it fails and keeps its last success, the others load."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    pages = landed.property_pages(d)
    load_entity(store, "properties", pages, EARLIER)
    cut = F.when((F.col("region_code") == "asia") & (F.col("page") % 7 == 0), F.lit('[{"id": "1", "na')).otherwise(F.col("body"))
    return load_entity(store, "properties", pages.withColumn("body", cut), CLOCK).select(
        "region_code", "sync_status", (F.col("last_successful_sync_at") == CLOCK.timestamp()).alias("moved"), F.col("error_message").isNotNull().alias("told"))


check("load_unreadable_page", broken_load, "regions", """
SELECT region_code, CASE region_code WHEN 'asia' THEN 'failed' ELSE 'success' END AS sync_status, region_code <> 'asia' AS moved, region_code = 'asia' AS told FROM regions""")


def rolled_back(d: Domain) -> DataFrame:
    """The second load stops between parents and children: all tables are as after the first, the runs have failed."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    pages = landed.property_pages(d)
    load_entity(store, "properties", pages, EARLIER)
    again = pages.withColumn("body", F.replace("body", F.lit("Customer#"), F.lit("House ")))
    try:
        with mock.patch.object(load, "load_children", side_effect=ConnectionError("photos are lost")):
            load_entity(store, "properties", again, CLOCK)
        raise AssertionError("the load did not stop")
    except ConnectionError:
        pass
    status = store.read("sync_status").select("region_code", "sync_status", "error_message", "last_successful_sync_at")
    photos = _photos(store).groupBy("property_id").agg(F.count(F.lit(1)).alias("photos"))
    rows = store.read("properties").select("property_id", "region_code", "property_name", "updated_at")
    return rows.join(photos, "property_id", "left").fillna(0, ["photos"]).join(status, "region_code")


check("load_rollback", rolled_back, "properties", f"""
SELECT region_code, property_id, property_name, {stamp("TIMESTAMP '2001-07-14 12:00:00'")} AS updated_at,
 {big("CASE WHEN id % 10 <> 9 THEN id % 4 ELSE 0 END")} AS photos, 'failed' AS sync_status, 'ConnectionError: photos are lost' AS error_message,
 {stamp("TIMESTAMP '2001-07-14 12:00:00'")} AS last_successful_sync_at
FROM properties WHERE {LISTED}""")


def partly_loaded(d: Domain) -> DataFrame:
    """Requests for every fifth reservation of region asia fail: it is ``partial`` and does not count as a success; what came
    is stored."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))

    def lost(key: str) -> Column:
        return (F.col("region_code") == "asia") & (F.col(key) % 5 == 0)

    made = d["reservations"].select("region_code", "reservation_id", lost("id").alias("failed"))
    body = F.to_json(F.struct("id", F.col("task_name").alias("name")))
    links = d["tasks"].where(F.col("reservation_pk").isNotNull() & ~lost("reservation_pk"))
    runs.load_links(store, links.select("region_code", F.col("reservation_pk").alias("reservation_id"), body.alias("record")), CLOCK, made)
    links = store.read("reservation_tasks").groupBy("region_code").agg(F.count(F.lit(1)).alias("links"))
    return store.read("sync_status").select(
        "region_code", "sync_status", "error_message", "records_new", "api_calls_made", "last_successful_sync_at").join(links, "region_code")


check("load_partial", partly_loaded, "reservations tasks", f"""
WITH calls AS (SELECT region_code, count(*) AS calls, count(*) FILTER (WHERE region_code = 'asia' AND id % 5 = 0) AS lost FROM reservations GROUP BY 1),
links AS (SELECT region_code, count(*) AS links FROM tasks WHERE reservation_pk IS NOT NULL AND NOT (region_code = 'asia' AND reservation_pk % 5 = 0) GROUP BY 1)
SELECT region_code, CASE WHEN lost > 0 THEN 'partial' ELSE 'success' END AS sync_status, CASE WHEN lost > 0 THEN lost || ' reservation fetch failures' END AS error_message,
 links AS records_new, calls AS api_calls_made, CASE WHEN lost = 0 THEN {stamp("TIMESTAMP '2001-07-15 12:00:00'")} END AS last_successful_sync_at, links
FROM calls JOIN links USING (region_code)""")


def not_loaded(d: Domain) -> DataFrame:
    """A load that ends in an exception leaves ``failed``, never ``running``."""
    store = SnapshotStore(d.spark, scratch_path(d.spark, "store"))
    pages = landed.property_pages(d).withColumn("body", F.when(F.col("page") == -1, "").otherwise(F.raise_error(F.lit("the feed broke off"))))
    try:
        load_entity(store, "properties", pages, CLOCK)
        raise AssertionError("the load did not stop")
    except AssertionError:
        raise
    except Exception:  # noqa: BLE001 - whatever Spark makes of the error
        pass
    return store.read("sync_status").select(
        "region_code", "sync_status", F.col("error_message").contains("broke off").alias("told"), "sync_completed_at", "last_successful_sync_at",
        F.lit(store.exists("properties")).alias("made"))


check("load_failed", not_loaded, "regions", f"""
SELECT region_code, 'failed' AS sync_status, true AS told, {stamp("TIMESTAMP '2001-07-15 12:00:00'")} AS sync_completed_at,
 CAST(NULL AS VARCHAR) AS last_successful_sync_at, false AS made FROM regions""")


# Entities with a transform only -------------------------------------------------------------------
def transformed(d: Domain, name: str, rows: DataFrame, region: Column, key: Column, *columns: Column) -> DataFrame:
    """Records built from ``rows``, landed one per page (every fiftieth twice) and transformed."""
    record = F.to_json(F.struct(*columns))
    pages = rows.select(region.alias("region_code"), key.alias("page"), landed._page(key, record, record).alias("body"))
    parsed = unwrap_pages(pages, record_schema(ENTITIES[name]))
    return records.transform_parents(parsed, ENTITIES[name], CLOCK.timestamp()).drop("synced_at")


def col(name: str, alias: str | None = None) -> Column:
    return F.col(name).alias(alias or name)


check("transform_people", lambda d: transformed(
    d, "people", d.raw("supplier"), F.lit("all"), F.col("s_suppkey"), col("s_suppkey", "id"), col("s_name", "name"),
    (F.col("s_acctbal") >= 0).alias("active"), F.struct(F.when(F.col("s_suppkey") % 3 == 0, "09-17").alias("monday")).alias("availability"),
).select("person_id", "region_code", "person_name", "active", "accept_decline_tasks", "availability_monday", "availability_sunday"), "", f"""
SELECT {text("s_suppkey")} AS person_id, 'all' AS region_code, s_name AS person_name, s_acctbal >= 0 AS active, CAST(NULL AS BOOLEAN) AS accept_decline_tasks,
 CASE WHEN s_suppkey % 3 = 0 THEN '09-17' END AS availability_monday, CAST(NULL AS VARCHAR) AS availability_sunday FROM supplier""")
check("transform_supplies", lambda d: transformed(
    d, "supplies", d.raw("part"), F.lit("all"), F.col("p_partkey"), col("p_partkey", "id"), col("p_name", "name"), col("p_size", "size"),
    col("p_retailprice", "unit_cost"), (F.col("p_size") * 2).alias("stock_count"), (F.col("p_size") < 5).alias("low_stock_alert"),
    F.struct(col("p_brand", "code"), col("p_type", "name")).alias("type_stock_status"),
).select("supply_id", "supply_name", "size", "unit_cost", "stock_count", "low_stock_alert", "stock_status_code", "stock_status_name"), "", f"""
SELECT {text("p_partkey")} AS supply_id, p_name AS supply_name, {text("p_size")} AS size, p_retailprice AS unit_cost, {big("p_size * 2")} AS stock_count,
 p_size < 5 AS low_stock_alert, p_brand AS stock_status_code, p_type AS stock_status_name FROM part""")
check("transform_reservations", lambda d: transformed(
    d, "reservations", d["reservations"], F.col("region_code"), F.col("id"), col("id"), col("property_pk", "property_id"),
    col("reservation_status", "status"), col("checkin_date"), col("checkin_time"), col("checkout_date"), col("checkout_time"), col("pets"),
    (F.col("id") % 2 == 0).alias("checkin_early"),
).select("reservation_id", "region_code", "property_id", "reservation_status", "checkin_date", "checkout_time", "pets", "checkin_early"),
      "reservations", f"""SELECT reservation_id, region_code, {text("property_pk")} AS property_id, reservation_status, {text("r.checkin_date")} AS checkin_date,
 checkout_time, {big("pets")} AS pets, id % 2 = 0 AS checkin_early FROM reservations r""")
check("transform_tags", lambda d: transformed(
    d, "tags", d["tags"], F.col("region_code"), F.length("id"), col("id"), col("tag_name", "name"),
), "tags", "SELECT id AS tag_id, region_code, tag_name, CAST(NULL AS VARCHAR) AS tag_description FROM tags")
for _name, _columns, _sql in (
    ("subdepartments", {"id": "n_nationkey", "name": "n_name", "reference_company_id": "n_regionkey"},
     f"{text('n_nationkey')} AS subdepartment_id, n_name AS subdepartment_name, {text('n_regionkey')} AS reference_company_id"),
    ("templates", {"id": "n_nationkey", "template_name": "n_name", "department_code": "n_regionkey"},
     f"{text('n_nationkey')} AS template_id, n_name AS template_name, {text('n_regionkey')} AS department_code"),
    ("property_tags", {"id": "n_nationkey", "name": "n_name", "company_id": "n_regionkey"},
     f"{text('n_nationkey')} AS property_tag_id, n_name AS tag_name, {big('nullif(n_regionkey, 0)')} AS company_id"),
    ("reservation_tags", {"id": "n_nationkey", "name": "n_name", "company_id": "n_regionkey"},
     f"{text('n_nationkey')} AS reservation_tag_id, n_name AS tag_name, {big('nullif(n_regionkey, 0)')} AS company_id"),
):
    check(f"transform_{_name}", lambda d, n=_name, c=_columns: transformed(
        d, n, d.raw("nation"), F.lit("all"), F.col("n_nationkey"), *[col(v, k) for k, v in c.items()]),
          "", f"SELECT {_sql}, 'all' AS region_code FROM nation")
