"""Whole entity loads into a store."""

import json
from datetime import datetime
from unittest import mock

import pytest
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators import keys, load, runs
from fieldstay.operators.load import load_entity, repair_keys
from fieldstay.sources.snapshot import SnapshotStore

DAY1, DAY2 = Clock(datetime(2025, 3, 1)), Clock(datetime(2025, 3, 2))


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


@pytest.fixture
def pages(rows):
    def build(*bodies, region="n"):
        data = [(region, i, json.dumps(b[1]), str(b[0])) for i, b in enumerate(bodies)]
        return rows("region_code string, page long, body string, parent_id string", *data)

    return build


def prop(i, **over):
    return {"id": str(i), "name": f"House {i}", "status": "active", "photos": [{"id": i * 10, "url": "u"}], **over}


def task(i, home, **over):
    return {"id": i, "home_id": home, "name": f"T{i}", "created_at": "2025-01-15T08:00:00Z", "assignments": [{"assignee_id": 5, "name": "Sam"}], **over}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_properties_twice(store, pages):
    load_entity(store, "properties", pages((0, [prop(1), prop(2), prop(3, status="inactive")])), DAY1)
    first = by(store.read("properties"), "property_id")
    assert set(first) == {"1", "2"}
    status = load_entity(store, "properties", pages((0, {"results": [prop(1, name="New", photos=[{"id": 10, "url": "v"}, {"id": 11}]), prop(4)]})), DAY2)
    second = by(store.read("properties"), "property_id")
    assert set(second) == {"1", "2", "4"}
    assert (second["1"].property_name, second["1"].id, second["1"].updated_at) == ("New", first["1"].id, DAY2.now)
    assert second["2"].updated_at == DAY1.now and len({r.id for r in second.values()}) == 3
    photos = {(r.property_pk, r.photo_id): r.url for r in store.read("property_photos").collect()}
    assert photos == {(first["1"].id, "10"): "v", (first["1"].id, "11"): None, (first["2"].id, "20"): "u", (second["4"].id, "40"): "u"}
    (row,) = status.collect()
    assert (row.sync_status, row.records_processed, row.records_new) == ("success", 2, 1)
    assert store.read("sync_history").count() == 2


def test_stream_owned_status_is_not_overwritten(store, pages):
    load_entity(store, "properties", pages((0, [prop(1)])), DAY1)
    store.write("properties", store.read("properties").replace("active", "dirty", ["property_status"]), "region_code")
    load_entity(store, "properties", pages((0, [prop(1, name="New")])), DAY2)
    (row,) = store.read("properties").collect()
    assert (row.property_name, row.property_status) == ("New", "dirty")


def test_tasks_with_children_and_keys(store, pages, rows):
    load_entity(store, "properties", pages((0, [prop(1)])), DAY1)
    load_entity(store, "tags", pages((0, [{"id": 7, "name": "urgent"}])), DAY1)
    load_entity(store, "reservations", pages((0, [{"id": "r1", "property_id": "1", "checkin_date": "2025-01-10"}])), DAY1)
    body = [
        task(100, 1, linked_reservation={"id": "r1"}, task_tags=[{"id": 7}, {"id": 99}], costs=[{"id": 1, "cost": "3.5"}]),
        task(101, 1, created_at="2025-02-01T00:00:00Z"),
    ]
    reqs = rows("region_code string, parent_id string, body string", ("n", "100", json.dumps({"data": [{"id": 1, "response": "ok"}, {"id": 1, "response": "again"}]})),
                ("n", "404", '[{"id":2}]'))
    load_entity(store, "tasks", pages((1, body), (999, [task(500, 999)])), DAY1, {"requirements": reqs})
    house, stay = store.read("properties").first(), store.read("reservations").first()
    tasks = by(store.read("tasks"), "task_id")
    assert set(tasks) == {"100", "101"} and stay.property_pk == house.id
    assert (tasks["100"].property_pk, tasks["100"].reservation_pk, tasks["101"].reservation_pk) == (house.id, stay.id, None)
    assert tasks["100"].created_at == datetime(2025, 1, 15, 8)
    assert [(r.task_pk, r.response, r.created_at) for r in store.read("task_requirements").collect()] == [(tasks["100"].id, "ok", datetime(2025, 1, 15, 8))]
    assert [(r.task_pk, r.tag_pk) for r in store.read("task_tags").collect()] == [(tasks["100"].id, store.read("tags").first().id)]
    assert [(r.task_pk, r.cost) for r in store.read("task_costs").collect()] == [(tasks["100"].id, 3.5)]
    assert store.read("task_assignments").count() == 2
    before = store.folders("tasks")
    load_entity(store, "tasks", pages((1, [task(101, 1, created_at="2025-02-01T00:00:00Z", name="renamed")])), DAY2)
    after = store.folders("tasks")
    assert after["2025-01-01"] == before["2025-01-01"] and after["2025-02-01"] != before["2025-02-01"]
    assert by(store.read("tasks"), "task_id")["101"].task_name == "renamed"


def test_keys_are_repaired_when_the_parent_arrives_later(store, pages):
    load_entity(store, "reservations", pages((0, [{"id": "r1", "property_id": "1"}, {"id": "r2", "property_id": "2"}])), DAY1)
    load_entity(store, "properties", pages((0, [prop(1)])), DAY1)
    assert repair_keys(store, "reservations") == 1
    got = by(store.read("reservations"), "reservation_id")
    assert got["r1"].property_pk == store.read("properties").first().id and got["r2"].property_pk is None
    assert repair_keys(store, "reservations") == 0


def test_links_find_their_keys_without_their_text(store, rows):
    def records(*data):
        return rows("region_code string, reservation_id string, record string", *[(r, s, json.dumps(b)) for r, s, b in data])

    def stored():
        got = store.read("reservation_tasks").collect()
        return sorted((r.region_code or "", r.reservation_id or "", r.task_id, r.task_name, r.reservation_pk or 0, r.task_pk or 0, r.synced_at.day) for r in got)

    store.write("reservations", rows("id long, reservation_id string, region_code string", (1, "r1", "n")), "region_code")
    store.write("tasks", rows("id long, task_id string, region_code string", (7, "t1", "n"), (8, "t2", "n")), "region_code")
    seen, find = [], keys.overwrite_key
    with mock.patch.object(keys, "overwrite_key", side_effect=lambda df, *a: seen.append(df.columns) or find(df, *a)):
        runs.load_links(store, records(
            ("n", "r1", {"id": "t1", "name": "a"}), ("n", "r1", {"id": "t1", "name": "b"}), ("n", "r2", {"id": "t2", "name": "c"}),
            ("n", None, {"id": "t1", "name": "d"}), ("n", "r1", {"name": "no id"}), ("s", "r1", {"id": "t1", "name": "e"})), DAY1)
        first = [("n", "", "t1", "d", 0, 7, 1), ("n", "r1", "t1", "b", 1, 7, 1), ("n", "r2", "t2", "c", 0, 8, 1), ("s", "r1", "t1", "e", 0, 0, 1)]
        assert stored() == first
        # Rows that are kept get a key that has arrived meanwhile; a key that is gone stays; a NULL in a key matches nothing.
        store.write("reservations", rows("id long, reservation_id string, region_code string", (2, "r2", "n")), "region_code")
        counts = runs.load_links(store, records(("n", "r1", {"id": "t1", "name": "z"}), ("n", None, {"id": "t1", "name": "d"})), DAY2)
    assert stored() == [("n", "", "t1", "d", 0, 7, 1), ("n", "", "t1", "d", 0, 7, 2), ("n", "r1", "t1", "z", 1, 7, 2), ("n", "r2", "t2", "c", 2, 8, 1), first[3]]
    assert [tuple(r) for r in counts.collect()] == [("n", 1, 1)]
    runs.load_links(store, records(("n", "r9", {"id": "t9"})), DAY2)
    assert len(stored()) == 6
    assert len(seen) == 4 and not any("raw_payload" in columns or "assignments" in columns for columns in seen)


def test_pages_are_read_once_and_new_months_are_not_merged(spark, store, pages):
    load_entity(store, "properties", pages((0, [prop(1)])), DAY1)
    read = spark.sparkContext.accumulator(0)

    def landed(*bodies):
        return pages(*bodies).withColumn("body", F.udf(lambda text: read.add(1) or text, "string")("body"))

    costs = [{"id": 1, "cost": "3.5"}, {"id": 1, "cost": "9"}, {"id": 2, "cost": "1"}]
    with mock.patch.object(load, "upsert_child", side_effect=AssertionError), mock.patch.object(load, "upsert_parent", side_effect=AssertionError):
        status = load_entity(store, "tasks", landed((1, [task(100, 1, costs=costs), task(100, 1, name="again")]), (999, [task(500, 999)]), (1, [])), DAY1)
    assert read.value == 3
    assert [(r.sync_status, r.records_processed, r.records_new) for r in status.collect()] == [("success", 1, 1)]
    (first,) = store.read("tasks").collect()
    assert (first.task_id, first.task_name, first.updated_at) == ("100", "T100", DAY1.now)
    assert sorted((r.task_pk, r.cost_id, r.cost) for r in store.read("task_costs").collect()) == [(first.id, "1", 3.5), (first.id, "2", 1.0)]
    ids = {r.cost_id: r.id for r in store.read("task_costs").collect()}
    load_entity(store, "tasks", landed((1, [task(100, 1, costs=[{"id": 2, "cost": "7"}, {"id": 3, "cost": "8"}]), task(101, 1)])), DAY2)
    assert by(store.read("tasks"), "task_id")["100"].id == first.id and store.read("tasks").select("id").distinct().count() == 2
    after = by(store.read("task_costs"), "cost_id")
    assert {k: r.cost for k, r in after.items()} == {"1": 3.5, "2": 7.0, "3": 8.0}
    assert {k: after[k].id for k in ids} == ids and after["3"].id not in ids.values()
