"""Event normalisation, application, streams and roll-ups."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.session import durable
from fieldstay.sources.snapshot import SnapshotStore
from fieldstay.streaming import events as ev
from fieldstay.streaming import rollups

CLOCK = Clock(datetime(2025, 3, 1, 6, 30))


@pytest.fixture
def events(spark):
    def build(*payloads):
        data = [(i, datetime(2025, 1, 1, 0, i), p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
        return spark.createDataFrame(data, ev.EVENT_SCHEMA)

    return build


@pytest.fixture
def companies(rows):
    return rows("company_id long, region_code string", (1, "n"), (2, "s"))


@pytest.fixture
def tasks(rows):
    return rows(
        "task_id string, region_code string, task_status string, started_at timestamp, finished_at timestamp, synced_at timestamp",
        ("7", "n", "new", None, None, None), ("7", "s", "new", None, None, None), ("8", "n", "new", None, None, None),
    )


def test_payload_variants(events):
    df = events(
        {"event_type": "task-updated", "task": {"id": 7, "company_id": 1, "status": {"code": "", "name": "Done"}, "finished_at": "2025-01-01T10:00:00Z"}},
        {"event": "x", "task_id": "8", "company_id": 0, "status": "open", "started_at": ""},
        {"id": 9}, {"task": {"id": 7}, "company_id": "2"}, {"task": {}, "task_id": 5},
    )
    got = ev.normalise_task_events(df).orderBy("event_id").collect()
    assert [r.task_id for r in got] == ["7", "8", "9", "7", "5"]
    assert [r.company_id for r in got] == [1, None, None, 2, None]
    assert [r.action for r in got] == ["task-updated", "x", "task_updated", "task_updated", "task_updated"]
    assert [r.status for r in got] == ["Done", "open", None, None, None]
    assert (got[0].finished_at, got[1].started_at) == (datetime(2025, 1, 1, 10), None)


def applied(tasks, df, companies):
    resolved = ev.resolve_region(ev.normalise_task_events(df), companies)
    return {(r.task_id, r.region_code): r for r in ev.apply_task_events(tasks, resolved, CLOCK).collect()}


def test_last_non_empty_value_per_field(events, tasks, companies):
    got = applied(tasks, events(
        {"task": {"id": 7, "company_id": 1, "status": "a", "started_at": "2025-01-01T10:00:00Z"}},
        {"task": {"id": 7, "company_id": 1, "status": "b"}}, {"task": {"id": 7, "company_id": 1, "status": ""}},
        {"task": {"id": 7, "company_id": 99, "status": "unmapped"}}, {"task": {"id": 404, "company_id": 1, "status": "x"}},
    ), companies)
    assert (got["7", "n"].task_status, got["7", "n"].started_at, got["7", "n"].synced_at) == ("b", datetime(2025, 1, 1, 10), CLOCK.now)
    assert (got["7", "s"].task_status, got["7", "s"].synced_at) == ("new", None)
    assert len(got) == 3


def test_delete_by_region_and_by_id_alone(events, tasks, companies):
    known = events({"event_type": "Task-DELETED", "task": {"id": 7, "company_id": 1}}, {"task": {"id": 7, "company_id": 1, "status": "late"}})
    assert set(applied(tasks, known, companies)) == {("7", "s"), ("8", "n")}
    unknown = events({"event_type": "task-deleted", "task": {"id": 7}}, {"event_type": "task-deleted", "task": {"id": 1234}})
    assert set(applied(tasks, unknown, companies)) == {("8", "n")}


def test_property_event_region_and_blocking(events, companies, rows):
    stored = rows("property_id string, region_code string, property_status string, synced_at timestamp", ("11", "s", "dirty", None), ("12", "n", "dirty", None))
    df = events(
        {"property_id": 11, "status": "clean", "sub_statuses": [{"is_blocking": True, "tasks": [{"is_blocking": True}]}]},
        {"id": "12", "company_id": 1}, {"property_id": "404", "status": "x"},
    )
    norm = ev.resolve_region(ev.normalise_property_events(df), companies, stored)
    got = {r.property_id: r for r in norm.collect()}
    assert [(got[p].region_code, got[p].blocking_count) for p in ("11", "12", "404")] == [("s", 2), ("n", 0), ("unknown", 0)]
    after = {r.property_id: r.property_status for r in ev.apply_property_events(stored, norm, CLOCK).collect()}
    assert after == {"11": "clean", "12": "dirty"}


def test_task_stream_survives_bad_events_and_logs(spark, tmp_path, tasks, companies):
    landing = tmp_path / "in"
    landing.mkdir()

    def land(name, *payloads):
        lines = [json.dumps({"event_id": i, "received_at": f"2025-01-01T00:00:0{i}Z", "payload": p}) for i, p in payloads]
        (landing / name).write_text("\n".join(lines) + "\n")

    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write("tasks", tasks.withColumn("created_month", F.lit("2025-01-01")), "created_month")

    def run():
        stream = ev.read_event_stream(spark, str(landing))
        ev.start_task_stream(stream, store, companies, CLOCK, str(tmp_path / "ckpt")).awaitTermination()

    land("a.json", (1, '{"task":{"id":7,"company_id":1,"status":"first"}}'), (2, "{broken"), (3, '{"event":"test_webhook_event"}'))
    run()
    land("b.json", (4, '{"task":{"id":7,"company_id":1,"status":"second"}}'), (5, '{"event_type":"task-deleted","task":{"id":8,"company_id":1}}'))
    run()
    got = {(r.task_id, r.region_code): r.task_status for r in store.read("tasks").collect()}
    assert got == {("7", "n"): "second", ("7", "s"): "new"}
    log = {r.event_id: r.error_message for r in store.read("event_log").collect()}
    assert log == {1: None, 2: "payload is not JSON", 4: None, 5: None}


def test_a_batch_is_parsed_and_stored_once(spark, tmp_path, companies, rows, monkeypatch):
    stored = []
    monkeypatch.setattr(ev, "durable", lambda df: stored.append(df.columns) or durable(df))
    table = rows("task_id string, region_code string, task_status string, started_at timestamp, finished_at timestamp, synced_at timestamp, created_month string",
                 ("7", "n", "new", None, None, None, "2025-01-01"))
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write("tasks", table, "created_month")
    landing = tmp_path / "in"
    landing.mkdir()
    payloads = ['{"task":{"id":7,"company_id":1,"status":"first"}}', "{broken"]
    (landing / "a.json").write_text("\n".join(json.dumps({"event_id": i, "received_at": "2025-01-01T00:00:00Z", "payload": p}) for i, p in enumerate(payloads)))
    ev.start_task_stream(ev.read_event_stream(spark, str(landing)), store, companies, CLOCK, str(tmp_path / "ckpt")).awaitTermination()
    assert sum("event_id" in columns for columns in stored) == 1
    assert [r.task_status for r in store.read("tasks").collect()] == ["first"]
    log = store.read("event_log")
    assert {r.event_id: (r.processed, r.error_message) for r in log.collect()} == {0: (True, None), 1: (True, "payload is not JSON")}
    assert ev.ERROR not in log.columns


def test_a_batch_writes_as_much_as_it_changes(spark, tmp_path, companies, rows):
    schema = "task_id string, region_code string, task_status string, started_at timestamp, finished_at timestamp, synced_at timestamp, created_month string"
    table = rows(schema, *((str(i), "n", "new", None, None, None, f"2025-{i % 12 + 1:02d}-01") for i in range(1200)))
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write("tasks", table, "created_month", key=["task_id", "region_code", "created_month"], finder="task_id")
    landing = tmp_path / "in"
    landing.mkdir()
    before = store.folders("tasks")

    def run(name, *payloads):
        lines = [json.dumps({"event_id": i, "received_at": "2025-01-01T00:00:00Z", "payload": json.dumps(p)}) for i, p in enumerate(payloads)]
        (landing / name).write_text("\n".join(lines) + "\n")
        ev.start_task_stream(ev.read_event_stream(spark, str(landing)), store, companies, CLOCK, str(tmp_path / "ckpt")).awaitTermination()

    run("a.json", {"task": {"id": 12, "company_id": 1, "status": "x"}}, {"event_type": "task-deleted", "task": {"id": 25, "company_id": 1}},
        {"task": {"id": 24, "company_id": 1, "status": "y"}}, {"task": {"id": 9999, "company_id": 1, "status": "z"}})
    after = store.folders("tasks")
    assert {v for v in after if after[v] != before[v]} == {"2025-01-01", "2025-02-01"}
    assert all(f[0] == before[v][0] for v, f in after.items())
    written = spark.read.parquet(*[f for v, fs in after.items() for f in fs[1:]])
    assert written.count() == 3 and set(written.columns) >= {"_seq", "_gone"}
    assert set(store.find("tasks", rows("task_id string", ("12",), ("25",)))) >= {"2025-01-01", "2025-02-01"}
    assert len(store.find("tasks", rows("task_id string", ("12",)))) < 4
    # The filters of changed months are still good.
    assert len(store.find("tasks", rows("task_id string", ("5",)))) < 4 and store.find("tasks", rows("task_id string", ("none",))) in ([], *([[m] for m in after]))
    run("b.json", {"task": {"id": 12, "company_id": 1, "status": "again"}})
    got = {r.task_id: r.task_status for r in store.read("tasks").where("task_status <> 'new'").collect()}
    assert got == {"12": "again", "24": "y"} and store.read("tasks").count() == 1199
    store.compact("tasks", most=0)
    assert {r.task_id: r.task_status for r in store.read("tasks").where("task_status <> 'new'").collect()} == got
    assert store.read("tasks").count() == 1199 and store.read("event_log").count() == 5


def test_property_stream_keeps_the_newest(spark, tmp_path, companies, rows):
    mirror = rows("property_id string, region_code string, property_status string, synced_at timestamp",
                  ("11", "n", "dirty", None), ("12", "s", "dirty", None))
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.write("properties", mirror, "region_code")
    landing = tmp_path / "in"
    landing.mkdir()

    def run(name, *lines):
        text = [json.dumps({"event_id": i, "received_at": f"2025-01-01T00:00:0{i}Z", "payload": p if isinstance(p, str) else json.dumps(p)}) for i, p in lines]
        (landing / name).write_text("\n".join(text) + "\n")
        stream = ev.read_event_stream(spark, str(landing))
        ev.start_property_stream(stream, store, companies, mirror, CLOCK, str(tmp_path / "ckpt")).awaitTermination()

    run("a.json", (5, {"property_id": 11, "status": "clean"}), (6, "{broken"), (7, {"property_id": "404", "status": "x"}))
    run("b.json", (4, {"property_id": 11, "company_id": 1, "status": "late"}), (8, {"property_id": 12, "status": "inspected"}))
    assert {r.property_id: (r.status, r.event_id) for r in store.read("property_status").collect()} == {"11": ("clean", 5), "12": ("inspected", 8)}
    assert {r.property_id: r.property_status for r in store.read("properties").collect()} == {"11": "late", "12": "inspected"}
    log = {r.event_id: (r.error_message, r.event_kind) for r in store.read("event_log").collect()}
    assert set(log) == {4, 5, 6, 7, 8} and log[6] == ("payload is not JSON", "property-status")


def test_whole_buckets_only():
    at = datetime
    assert rollups.bucket_range(at(2025, 1, 1, 12), at(2025, 1, 4, 12), "day") == (at(2025, 1, 2), at(2025, 1, 4))
    assert rollups.bucket_range(at(2025, 1, 1), at(2025, 3, 1), "month") == (at(2025, 1, 1), at(2025, 3, 1))
    assert rollups.bucket_range(at(2025, 1, 2), at(2025, 3, 31), "month") == (at(2025, 2, 1), at(2025, 3, 1))
    first, last = rollups.bucket_range(at(2025, 1, 1, 1), at(2025, 1, 1, 2), "day")
    assert first == last
    assert rollups.policy_range(Clock(at(2025, 2, 28, 5)), "month") == (at(2024, 11, 28, 5), at(2025, 2, 28, 4))
    assert rollups.policy_range(Clock(at(2025, 5, 31, 5)), "month")[0] == at(2025, 2, 28, 5)


ROLLUP = "created_at timestamp, finished_at timestamp, region_code string, type_department string, type_priority string, task_status_stage string, finished_by_id string"


def test_write_refreshed_replaces_only_its_days(spark, rows, tmp_path):
    def made(day, worker):
        return (datetime(2025, 1, day, 8), datetime(2025, 1, day, 10), "n", "housekeeping", "urgent", "finished", worker)

    store = SnapshotStore(spark, str(tmp_path / "store"))
    early = rows(ROLLUP, made(1, "a"), made(2, "a"), made(3, "a"))
    rollups.write_refreshed(early, store, "days", datetime(2025, 1, 1), datetime(2025, 1, 4))
    late = rows(ROLLUP, made(1, "b"), made(2, "b"), made(2, "c"), made(3, "b"))
    rollups.write_refreshed(late, store, "days", datetime(2025, 1, 1, 6), datetime(2025, 1, 3, 6))
    got = {str(r.bucket_day)[-2:]: (r.tasks_created, r.unique_workers, r.avg_hours_to_complete) for r in store.read("days").collect()}
    assert got == {"01": (1, 1, 2.0), "02": (2, 2, 2.0), "03": (1, 1, 2.0)}


def test_refresh_reads_only_what_has_changed(spark, rows, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    schema = "m string, v int"
    store.write("facts", rows(schema, ("a", 1), ("a", 2), ("b", 5), ("c", 7)), "m")
    seen = []

    def build(facts):
        seen.append(sorted({r.m for r in facts.collect()}))
        return facts.groupBy("m").agg(F.sum("v").alias("total"))

    def totals():
        return {r.m: r.total for r in store.read("sums").collect()}

    assert rollups.refresh_changed(store, "facts", "sums", build) == ["a", "b", "c"] and totals() == {"a": 3, "b": 5, "c": 7}
    store.replace("facts", rows(schema, ("b", 50)), ["b"])
    store.drop("facts", ["c"])
    assert rollups.refresh_changed(store, "facts", "sums", build) == ["b"] and totals() == {"a": 3, "b": 50}
    assert rollups.refresh_changed(store, "facts", "sums", build) == [] and seen == [["a", "b", "c"], ["b"]]


def test_log_marks(events, companies):
    log = ev.event_log(ev.resolve_region(ev.normalise_task_events(events({"task": {"id": 1}})), companies), "task", "task_id")
    (row,) = ev.mark_processed(log, CLOCK, F.lit("boom")).collect()
    assert (row.processed, row.error_message, row.region_code, row.entity_id) == (True, "boom", None, "1")
