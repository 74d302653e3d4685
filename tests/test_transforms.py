"""Record transforms on hand-written source records."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldstay.functions import parsing
from fieldstay.functions.times import Clock
from fieldstay.operators import links, records
from fieldstay.operators.entities import ENTITIES, TASK_CHILDREN, child_schema, record_schema
from fieldstay.sources import pages

CLOCK = Clock(datetime(2025, 3, 1, 6, 30))


@pytest.fixture
def landed(spark):
    def build(*bodies):
        data = [("north", i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
        return spark.createDataFrame(data, "region_code string, page long, body string")

    return build


def parents(landed_pages, name):
    entity = ENTITIES[name]
    recs = pages.unwrap_pages(landed_pages, record_schema(entity))
    return records.transform_parents(recs, entity, CLOCK.timestamp()).collect()


def kids(landed_pages, name, child):
    recs = pages.unwrap_pages(landed_pages, record_schema(ENTITIES[name]))
    return records.explode_children(recs, ENTITIES[name], child).collect()


PROPERTY = {
    "id": "11", "company_id": 501, "name": "Pine Hut", "status": "active", "latitude": "45.5", "longitude": "",
    "notes": {"about": "quiet", "wifi": "on the fridge"}, "bedrooms": 2,
    "photos": [{"id": 1, "url": "a", "default": True}, {"id": 2, "url": "b"}, {"url": "c"}],
}


def test_property_fields_and_notes(landed):
    (row,) = parents(landed([PROPERTY]), "properties")
    assert (row.property_id, row.company_id, row.property_name) == ("11", 501, "Pine Hut")
    assert (row.latitude_numeric, row.longitude_numeric) == (45.5, None)
    assert (row.property_notes_general, row.property_notes_wifi, row.property_notes_access) == ("quiet", "on the fridge", None)
    assert row.region_code == "north" and row.synced_at == datetime(2025, 3, 1, 6, 30)


@pytest.mark.parametrize(
    "given,wanted",
    [("12.5", 12.5), ("", None), ("x", None), (0, None), ("0", 0.0), (3, 3.0), (None, None), (" 7 ", 7.0)],
)
def test_coordinates(landed, given, wanted):
    (row,) = parents(landed([{**PROPERTY, "latitude": given}]), "properties")
    assert row.latitude_numeric == wanted


@pytest.mark.parametrize("given,wanted", [(7, 7), ("7", 7), ("", None), ("x", None), (0, None), (7.9, 7), ("7.9", None)])
def test_company_id(landed, given, wanted):
    (row,) = parents(landed([{**PROPERTY, "company_id": given}]), "properties")
    assert row.company_id == wanted


@pytest.mark.parametrize(
    "given,wanted",
    [("50.00 USD", 50.0), ("50", 50.0), ("bad", None), ("", None), ("  ", None), (None, None), (0, None), (12.5, 12.5), ("0.00 USD", 0.0)],
)
def test_rate_paid(landed, given, wanted):
    (row,) = parents(landed([{"id": 1, "rate_paid": given}]), "tasks")
    assert row.rate_paid == wanted


def test_link_rate_keeps_zero(rows):
    df = rows("t string", ("0",), ("9.5 EUR",), ("",), (None,))
    assert [r[0] for r in df.select(parsing.amount(F.col("t"))).collect()] == [0.0, 9.5, None, None]


def test_status_filter_drops_missing_status(landed):
    got = parents(landed([PROPERTY, {"id": "12", "status": "inactive"}, {"id": "13"}]), "properties")
    assert [r.property_id for r in got] == ["11"]


def test_first_duplicate_wins_in_arrival_order(landed):
    got = parents(
        landed({"results": [PROPERTY]}, [{**PROPERTY, "name": "later page"}, {**PROPERTY, "name": "later still"}]),
        "properties",
    )
    assert [r.property_name for r in got] == ["Pine Hut"]


def test_records_without_id_share_one_key(landed):
    got = parents(landed([{"name": "a"}, {"name": "b"}]), "tags")
    assert [(r.tag_id, r.tag_name) for r in got] == [(None, "a")]


def test_all_null_task(landed):
    (row,) = parents(landed([{"id": 5, "created_by": None, "type_task_status": None, "assignments": [], "summary": None}]), "tasks")
    assert row.task_id == "5"
    assert all(row[c] is None for c in ("created_by_id", "task_status_stage", "summary_note", "rate_paid", "created_at"))


def test_empty_and_broken_pages(landed):
    df = landed([], {"results": []}, {"results": None}, "null", "not json", {"other": 1})
    assert pages.unwrap_pages(df, record_schema(ENTITIES["tags"])).count() == 0


def test_property_photos(landed):
    got = kids(landed([PROPERTY, {**PROPERTY, "id": "12", "photos": None}]), "properties", "photos")
    assert [(r.photo_id, r.is_default, r.parent_api_id) for r in got] == [
        ("1", True, "11"), ("2", False, "11"), ("", False, "11")
    ]


def test_list_field_that_is_no_list_gives_no_children(landed):
    assert kids(landed([{**PROPERTY, "photos": "none"}]), "properties", "photos") == []


def test_guests_without_content_are_skipped(landed):
    rec = {"id": "r1", "guests": [{"name": "Kim"}, {"primary": True}, {"phone": "1", "primary": True}]}
    got = kids(landed([rec]), "reservations", "guests")
    assert [(r.guest_name, r.guest_phone, r.is_primary) for r in got] == [("Kim", None, False), (None, "1", True)]


def test_assignments_read_top_level_ids(landed):
    rec = {"id": 3, "assignments": [{"assignee_id": 9, "name": "Sam"}, {"assignee": {"id": 4}, "name": "Lee"}]}
    got = kids(landed([rec]), "tasks", "assignments")
    assert [(r.assignee_id, r.assignee_name) for r in got] == [("9", "Sam"), ("", "Lee")]


def test_costs_and_supplies(landed):
    rec = {
        "id": 3,
        "costs": [{"id": 1, "cost": "12.5", "type_cost": {"code": "labor"}}, {"id": 2, "cost": "x", "type_cost": None}],
        "supplies": [{"id": 1, "quantity": "2", "unit_cost": None, "markup_rate": "n/a"}],
    }
    got = kids(landed([rec]), "tasks", "costs")
    assert [(r.cost_id, r.cost, r.type_cost_code) for r in got] == [("1", 12.5, "labor"), ("2", None, None)]
    (supply,) = kids(landed([rec]), "tasks", "supplies")
    assert (supply.quantity, supply.unit_cost, supply.markup_rate) == (2.0, None, None)


def test_requirements_keep_json_and_inherit_created_at(spark, rows):
    body = json.dumps({"data": [
        {"id": 1, "action": {"k": [1]}, "photos": [], "type": "check"}, {"id": 2, "action": "text", "photos": ["p"]},
        {"id": 3, "action": 0, "photos": None},
    ]})
    landed_pages = rows("region_code string, parent_id string, body string", ("north", "5", body), ("north", "", body))
    tasks = rows("region_code string, task_id string, created_at string", ("north", "5", "2025-01-02"))
    child = TASK_CHILDREN["requirements"]
    got = records.map_child_pages(pages.unwrap_child_pages(landed_pages, child_schema(child)), tasks, child).collect()
    assert [(r.requirement_id, r.action, r.photos, r.created_at) for r in sorted(got, key=lambda r: r.requirement_id)] == [
        ("1", '{"k":[1]}', None, "2025-01-02"), ("2", '"text"', '["p"]', "2025-01-02"), ("3", None, None, "2025-01-02")
    ]


def test_child_fetch_window(rows):
    df = rows(
        "task_id string, created_at string",
        ("new", "2025-02-27T00:00:00Z"), ("old", "2024-01-01T00:00:00Z"), ("none", None), ("odd", "yesterday"),
        ("offset", "2025-02-22T08:00:00+02:00"),
    )
    assert sorted(r[0] for r in pages.recently_touched(df, CLOCK, 7).collect()) == ["new", "none", "odd"]
    assert pages.recently_touched(df, CLOCK, 0).count() == 5
    touched = df.withColumn("updated_at", F.lit("2025-02-28T00:00:00Z"))
    assert pages.recently_touched(touched, CLOCK, 7).count() == 5


def test_link_row_defaults(rows):
    df = rows(
        "region_code string, reservation_id long, record string",
        ("north", 1, '{"id":7,"rate_paid":"0","paused":true,"scheduled_time":"","assignments":[{"a":1}],"type_task_status":"x"}'),
        ("north", 1, '{"id":null,"name":"skip"}'),
    )
    (row,) = links.link_rows(df, CLOCK.timestamp()).collect()
    assert (row.task_id, float(row.rate_paid), row.scheduled_time, row.paused) == ("7", 0.0, None, True)
    assert (row.assignments, row.tags, row.task_status_code) == ('[{"a":1}]', "[]", None)
    assert json.loads(row.raw_payload)["id"] == 7


def test_fold_continues_in_parts(spark, rows):
    none = F.lit(None).cast("string")
    df = spark.range(25).select(
        (F.col("id") % 2).alias("task_pk"), F.lpad(F.col("id").cast("string"), 3, "0").alias("requirement_id"),
        F.when(F.col("id") < 20, F.concat(F.lit("S"), (F.col("id") % 3).cast("string"))).alias("section_name"),
        *[none.alias(c) for c in ("action", "response", "type_requirement", "note", "home_element_name")],
        F.lit(True).alias("photo_required"),
    )
    got = {(r.task_pk, r.part): json.loads(r.requirements) for r in links.fold_requirements(df, part_rows=5).collect()}
    for task, total in ((0, 13), (1, 12)):
        parts = [got[task, p] for p in range(3)]
        entries = [e for part in parts for e in part]
        assert [len(p) for p in parts] == [5, 5, total - 10]
        order = [(e.get("section_name") is None, e.get("section_name") or "", e["requirement_id"]) for e in entries]
        assert order == sorted(order)


def test_fold_numbers_only_the_tasks_too_large_for_a_list(spark, monkeypatch):
    none = F.lit(None).cast("string")
    df = spark.range(30).select(
        F.when(F.col("id") < 14, 1).when(F.col("id") < 21, 2).cast("long").alias("task_pk"),
        F.lpad((F.col("id") % 9).cast("string"), 3, "0").alias("requirement_id"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("S"), (F.col("id") % 2).cast("string"))).alias("section_name"),
        *[none.alias(c) for c in ("action", "response", "type_requirement", "note", "home_element_name")],
        F.lit(True).alias("photo_required"),
    )

    def folded():
        return {(r.task_pk, r.part): r.requirements for r in links.fold_requirements(df, part_rows=3).collect()}

    monkeypatch.setattr(links, "LISTED", 8)
    numbered = folded()
    monkeypatch.undo()
    monkeypatch.setattr(links, "positions", None)
    assert folded() == numbered and len(numbered) == 5 + 3 + 3
    assert not links.fold_requirements(df.limit(0)).collect()


def test_count_blocking(rows):
    df = rows(
        "s string",
        ('[{"is_blocking":true,"tasks":[{"is_blocking":true},{"is_blocking":false},null]},{"tasks":null},null]',), ("[]",), (None,),
    )
    n = links.count_blocking(F.from_json("s", links.SUB_STATUS))
    assert [r[0] for r in df.select(n).collect()] == [2, 0, 0]


def test_split_delimited(rows):
    df = rows("property_id string, ids string, urls string", ("p", "1--x--2--x--", "u1--x----x--"), ("q", "", None))
    got = records.split_delimited_columns(df, ["ids", "urls"], ["property_id"]).collect()
    assert [(r.property_id, r.pos, r.ids, r.urls) for r in got] == [("p", 0, "1", "u1"), ("p", 1, "2", None)]


def test_since_last_success(rows):
    recs = rows("id int, region_code string, updated_at timestamp", (1, "a", datetime(2025, 1, 1)), (2, "a", datetime(2025, 1, 3)),
                (3, "b", datetime(2020, 1, 1)))
    status = rows("region_code string, entity_type string, last_successful_sync_at timestamp", ("a", "tasks", datetime(2025, 1, 2)),
                  ("b", "people", datetime(2025, 1, 2)))
    assert sorted(r.id for r in pages.since_last_success(recs, status, "tasks").collect()) == [2, 3]
