"""Merge, keys, reconciliation, upkeep, run log and export rules."""

import json
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators import dedup, export, keys, maintenance, merge, quality, reconcile, runlog
from fieldstay.sources import snapshot, store as stores

CLOCK = Clock(datetime(2025, 3, 1, 6, 30))
KEY = st.sampled_from([None, "a", "b", "c", "d"])


def unique(data):
    """Rows with complete keys once, rows with NULL in the key as they are."""
    seen, out = set(), []
    for row in data:
        if None in row[:2] or row[:2] not in seen:
            seen.add(row[:2])
            out.append(row)
    return out


ROWS = st.lists(st.tuples(KEY, KEY, st.integers(0, 9), st.integers(0, 9)), max_size=12).map(unique)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, source=ROWS, how=st.sampled_from(["full", "small", "ignore", "update_only", "owned"]))
def test_merge_against_a_plain_model(spark, target, source, how):
    schema = "k string, r string, v int, w int"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    options = {
        "full": {}, "small": {"small_batch": True}, "ignore": {"update": False},
        "update_only": {"insert": False}, "owned": {"no_update": ["w"]},
    }[how]
    got = sorted(map(repr, (tuple(r) for r in merge.merge(t, s, ["k", "r"], **options).collect())))
    batch = {row[:2]: row for row in source if None not in row[:2]}
    wanted = []
    for row in target:
        hit = batch.get(row[:2])
        if hit is None or how == "ignore":
            wanted.append((*row, "keep"))
        else:
            wanted.append((*(hit[:3] + (row[3],) if how == "owned" else hit), "update"))
    stored = {row[:2] for row in target if None not in row[:2]}
    if how != "update_only":
        wanted += [(*row, "insert") for row in source if None in row[:2] or row[:2] not in stored]
    assert got == sorted(map(repr, wanted))


def test_upsert_parent_partition_column_and_created_at(rows):
    schema = "task_id string, region_code string, created_at timestamp, name string, updated_at timestamp"
    old, new = datetime(2025, 1, 1), datetime(2025, 2, 1)
    target = rows(schema, ("1", "n", old, "a", None), ("2", "n", old, "b", None))
    batch = rows("task_id string, region_code string, created_at timestamp, name string", ("1", "n", new, "A"), ("2", "n", old, "B"))
    out = merge.upsert_parent(
        target, batch, ["task_id", "region_code"], partition_column="created_at", stamp=CLOCK.timestamp()
    ).collect()
    assert sorted((r.task_id, r.created_at, r.name, r.op) for r in out) == [
        ("1", old, "a", "keep"), ("1", new, "A", "insert"), ("2", old, "B", "update")
    ]
    plain = merge.upsert_parent(target, batch, ["task_id", "region_code"]).collect()
    assert sorted((r.task_id, r.created_at, r.name) for r in plain) == [("1", old, "A"), ("2", old, "B")]


def test_merge_is_repeatable(rows):
    target = rows("k string, v int", ("a", 1))
    batch = rows("k string, v int", ("a", 2), ("b", 3))
    once = merge.merge(target, batch, ["k"]).drop("op")
    twice = merge.merge(once, batch, ["k"]).drop("op")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 2), ("b", 3)]


def test_upsert_child_dedup_is_null_safe_and_null_keys_insert_again(rows):
    target = rows("p int, q string, v int", (1, None, 0))
    batch = rows("p int, q string, v int, pos int", (1, None, 5, 1), (1, None, 6, 0), (1, "x", 7, 0))
    out = merge.upsert_child(target, batch, ["p", "q"], [F.col("pos").asc()]).collect()
    assert sorted((r.p, r.q or "", r.v, r.op) for r in out) == [
        (1, "", 0, "keep"), (1, "", 6, "insert"), (1, "x", 7, "insert")
    ]


def test_fill_overwrite_and_require(rows):
    df = rows("id int, code string, region_code string, fk int", (1, "a", "n", None), (2, "a", "n", 9), (3, None, "n", None),
              (4, "zz", "n", None), (5, "a", "s", 7))
    ref = rows("id int, code string, region_code string", (100, "a", "n"), (101, "b", "n"), (99, "a", "n"))
    on = {"code": "code", "region_code": "region_code"}
    assert {r.id: r.fk for r in keys.fill_key(df, ref, on, "fk").collect()} == {1: 99, 2: 9, 3: None, 4: None, 5: 7}
    assert {r.id: r.fk for r in keys.overwrite_key(df, ref, on, "fk").collect()} == {1: 99, 2: 99, 3: None, 4: None, 5: 7}
    assert {r.id: r.pk for r in keys.require_key(df, ref, on, "pk").collect()} == {1: 99, 2: 99}
    assert keys.unresolved_count(df, ref, on).first()[0] == 3


def test_link_by_dates_rule_order_and_ties(rows):
    d = date
    tasks = rows(
        "id int, property_pk int, region_code string, type_department string, scheduled_date date, checkin_date date,"
        " checkout_date date, reservation_pk int",
        (1, 1, "n", "inspection", d(2025, 1, 5), d(2025, 1, 1), d(2025, 1, 5), None),
        (2, 1, "n", "housekeeping", d(2025, 1, 6), None, None, None),
        (3, 1, "n", "inspection", d(2025, 1, 6), None, None, None),
        (4, 1, "n", "inspection", None, d(2025, 1, 4), d(2025, 3, 30), None),
        (5, 1, "s", "inspection", d(2025, 1, 5), d(2025, 1, 1), d(2025, 1, 5), None),
        (6, 1, "n", "inspection", d(2025, 1, 5), d(2025, 1, 1), d(2025, 1, 5), 77),
        (7, 1, "n", "housekeeping", d(2025, 6, 1), None, None, None),
    )
    stays = rows(
        "id int, property_pk int, region_code string, checkin_date date, checkout_date date",
        (12, 1, "n", d(2025, 1, 1), d(2025, 1, 5)), (11, 1, "n", d(2025, 1, 1), d(2025, 1, 5)),
        (10, 1, "n", d(2025, 1, 3), d(2025, 1, 4)), (9, 1, "n", d(2025, 3, 1), d(2025, 3, 9)),
    )
    got = {r.id: r.reservation_pk for r in keys.link_by_dates(tasks, stays).collect()}
    assert got == {1: 11, 2: 11, 3: None, 4: 10, 5: None, 6: 77, 7: None}


DAY = st.one_of(st.none(), st.integers(0, 30).map(lambda n: date(2025, 1, 1).fromordinal(date(2025, 1, 1).toordinal() + n)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    tasks=st.lists(st.tuples(st.sampled_from([1, 2]), st.sampled_from(["housekeeping", "other", None]), DAY, DAY, DAY), max_size=12),
    stays=st.lists(st.tuples(st.sampled_from([1, 2]), DAY, DAY), max_size=12),
)
def test_link_by_dates_against_all_pairs(spark, tasks, stays):
    t = spark.createDataFrame(
        [(i, p, "n", dept, sched, cin, cout, None) for i, (p, dept, sched, cin, cout) in enumerate(tasks)],
        "id int, property_pk int, region_code string, type_department string, scheduled_date date, checkin_date date,"
        " checkout_date date, reservation_pk int")
    r = spark.createDataFrame([(i, p, "n", a, b) for i, (p, a, b) in enumerate(stays)],
                              "id int, property_pk int, region_code string, checkin_date date, checkout_date date")
    wanted = {}
    for i, (p, dept, sched, cin, cout) in enumerate(tasks):
        best = None
        for j, (q, a, b) in enumerate(stays):
            if p != q or a is None or b is None:
                continue
            if cin == a and cout == b:
                rule = 1
            elif dept == "housekeeping" and sched and a <= sched and sched.toordinal() <= b.toordinal() + 1:
                rule = 2
            elif cin and cout and cin <= b and cout >= a:
                rule = 3
            else:
                continue
            key = (rule, abs(((cin or sched) - a).days), j)
            best = key if best is None else min(best, key)
        wanted[i] = best and best[2]
    assert {x.id: x.reservation_pk for x in keys.link_by_dates(t, r).collect()} == wanted


def test_reconcile_deletes_needs_two_strikes(rows):
    day = date(2025, 3, 1)
    tasks = rows(
        "task_id string, region_code string, home_id string, task_name string, scheduled_date date, missing_strikes int, missing_since timestamp",
        ("listed", "n", "h", "t", day, 1, datetime(2025, 1, 1)), ("first", "n", "h", "t", day, None, None),
        ("second", "n", "h", "t", day, 1, datetime(2025, 1, 1)), ("present", "n", "h", "t", day, 1, datetime(2025, 1, 1)),
        ("unknown", "n", "h", "t", day, 1, datetime(2025, 1, 1)), ("far", "n", "h", "t", date(2024, 1, 1), 1, None),
        ("badhome", "n", "x", "t", day, 1, None), ("noregion", "s", "h", "t", day, 1, None),
    )
    listed = rows("region_code string, task_id string", ("n", "listed"))
    good = rows("region_code string, home_id string", ("n", "h"), ("s", "h"))
    names = ["first", "second", "far", "badhome"]
    probes = rows("region_code string, task_id string, verdict string", *[("n", n, "deleted") for n in names],
                  ("n", "present", "present"), ("s", "noregion", "deleted"))
    out = reconcile.reconcile_deletes(tasks, listed, good, probes, CLOCK)
    table = {r.task_id: (r.missing_strikes, r.missing_since) for r in out.table.collect()}
    assert "second" not in table and len(table) == 7
    assert table["listed"] == table["present"] == (0, None)
    assert table["unknown"] == (1, datetime(2025, 1, 1))
    assert table["far"] == table["badhome"] == table["noregion"] == (1, None)
    (audit,) = out.audit.collect()
    assert json.loads(audit.task_row)["task_id"] == "second" and audit.deleted_at == CLOCK.now
    dry = reconcile.reconcile_deletes(tasks, listed, good, probes, CLOCK, dry_run=True)
    assert dry.table.count() == 8 and dry.audit.count() == 0 and dry.counts.where("action = 'delete'").count() == 1
    again = reconcile.reconcile_deletes(out.table, listed, good, probes, CLOCK)
    assert {r.action for r in again.counts.where("action = 'strike'").collect()} <= {"strike"}


def test_lifecycle_rules(rows):
    mirror = rows(
        "property_id string, region_code string, property_status string, external_id string, synced_at timestamp",
        ("1", "n", "dirty", "x", None), ("2", "n", "dirty", "x", None), ("3", "n", "inactive", "x", None),
        ("4", "n", "active", None, None), ("5", "n", "deleted", None, None), ("6", "p", "active", None, None), ("7", "e", "active", None, None),
    )
    listed = rows("region_code string, property_id string, status string, external_id string, position int",
                  ("n", "1", "active", "x", 0), ("n", "2", "inactive", "", 1), ("n", "3", "active", "y", 2), ("p", "60", "active", "", 3))
    complete = rows("region_code string, complete boolean", ("n", True), ("p", False), ("e", True))
    table, counts = reconcile.reconcile_lifecycle(mirror, listed, complete, CLOCK)
    got = {r.property_id: (r.property_status, r.external_id, r.synced_at is not None) for r in table.collect()}
    assert got == {
        "1": ("dirty", "x", False), "2": ("inactive", "", True), "3": ("active", "y", True), "4": ("deleted", None, True),
        "5": ("deleted", None, False), "6": ("active", None, False), "7": ("active", None, False),
    }
    by = {r.region_code: (r.status_fixed, r.external_fixed, r.marked_deleted) for r in counts.collect()}
    assert by["n"] == (2, 2, 1)
    same, _ = reconcile.reconcile_lifecycle(mirror, listed, complete, CLOCK, dry_run=True)
    assert sorted(map(str, same.collect())) == sorted(map(str, mirror.collect()))


def test_cascade(rows):
    doomed = rows("id int", (1,))
    out = maintenance.cascade_delete(
        doomed, {"kids": (rows("fk int, v int", (1, 1), (2, 2)), "fk")}, {"soft": (rows("fk int, v int", (1, 1), (2, 2), (None, 3)), "fk")}
    )
    assert [tuple(r) for r in out["kids"].collect()] == [(2, 2)]
    assert sorted((r.v, r.fk) for r in out["soft"].collect()) == [(1, None), (2, 2), (3, None)]


def test_retention_keeps_unprocessed(rows):
    df = rows("id int, received_at timestamp, processed boolean", (1, datetime(2024, 1, 1), True), (2, datetime(2024, 1, 1), False),
              (3, datetime(2024, 1, 1), None), (4, datetime(2025, 2, 28), True))
    assert sorted(r.id for r in maintenance.retain_events(df, CLOCK).collect()) == [2, 3, 4]
    assert tuple(maintenance.retention_report(df, CLOCK).first()) == (4, 3, 1)


STATUS = ("region_code string, entity_type string, sync_status string, sync_started_at timestamp, sync_completed_at timestamp,"
          " last_successful_sync_at timestamp, records_processed long, records_new long, api_calls_made long, error_message string")


def test_run_log_cycle(rows):
    t0 = datetime(2025, 1, 1)
    table = rows(STATUS, ("n", "tasks", "failed", t0, t0, t0, 5, 1, 2, "old"))
    started = runlog.start_runs(table, rows("region_code string, entity_type string", ("n", "tasks"), ("s", "tasks")), CLOCK)
    got = {r.region_code: r for r in started.collect()}
    assert got["n"].sync_status == got["s"].sync_status == "running"
    assert (got["n"].records_processed, got["n"].error_message, got["n"].last_successful_sync_at) == (0, None, t0)
    later = Clock(datetime(2025, 3, 1, 6, 30, 12, 500000))
    results = rows("region_code string, entity_type string, sync_status string, error_message string, records_processed long",
                   ("n", "tasks", "partial", "1 fetch failed", 8), ("s", "tasks", "success", None, 9), ("x", "tasks", "success", None, 1))
    closed, history = runlog.finish_runs(started, results, later)
    got = {r.region_code: r for r in closed.collect()}
    assert set(got) == {"n", "s"}
    assert got["n"].last_successful_sync_at == t0 and got["s"].last_successful_sync_at == later.now
    assert {(r.region_code, float(r.duration_seconds)) for r in history.collect()} == {("n", 12.5), ("s", 12.5)}


def test_stale_and_purge(rows):
    table = rows(STATUS, ("n", "a", "running", datetime(2025, 3, 1, 5, 0), None, None, 0, 0, 0, None),
                 ("n", "b", "running", datetime(2025, 3, 1, 6, 0), None, None, 0, 0, 0, None),
                 ("n", "c", "success", datetime(2025, 2, 1), None, None, 0, 0, 0, None),
                 ("n", "d", "running", datetime(2025, 2, 1), None, None, 0, 0, 0, None))
    got = {r.entity_type: r.sync_status for r in maintenance.fail_stale_runs(table, CLOCK, "gone").collect()}
    assert got == {"a": "failed", "b": "running", "c": "success", "d": "failed"}
    assert sorted(r.entity_type for r in maintenance.purge_run_log(table, CLOCK).collect()) == ["a", "b", "d"]


def test_watermarks(rows):
    old, new = datetime(2025, 1, 5), datetime(2025, 1, 1)
    marks = rows("table_name string, region_code string, last_pushed_at timestamp, rows_pushed long", ("t", "n", old, 10), ("t", "f", old, 1))
    pushed = rows("region_code string, synced_at timestamp", ("n", new), ("n", None), ("s", old), ("f", datetime(2025, 2, 1)), ("z", None))
    failed = rows("region_code string", ("f",))
    got = {r.region_code: (r.last_pushed_at, r.rows_pushed) for r in export.advance_watermarks(marks, pushed, "t", failed).collect()}
    assert got == {"n": (old, 12), "f": (old, 1), "s": (old, 1)}
    assert export.advance_watermarks(marks, pushed, "t", dry_run=True) is marks
    changed = export.changed_since(pushed, marks, "t").collect()
    assert sorted(r.region_code for r in changed) == ["f", "s", "z"]
    assert export.changed_since(pushed, marks, "t", full=True).count() == 5


def test_null_parts_count_as_keys(rows):
    df = rows("a int, b string", (1, None), (1, None), (1, "x"))
    (line,) = dedup.duplicate_report({"t": (df, ["a", "b"])}).collect()
    assert (line.total_records, line.unique_records, line.duplicates) == (3, 2, 1)
    kept = dedup.keep_first(df, ["a", "b"], ["a"])
    dedup.assert_dedup(df, df, kept, ["a", "b"])
    with pytest.raises(ValueError):
        dedup.assert_dedup(df, df, df, ["a", "b"])


def test_sync_health_drops_days_from_hours(rows):
    table = rows(STATUS, ("n", "a", "success", CLOCK.now, CLOCK.now, datetime(2025, 2, 26, 3, 0), 0, 0, 0, None))
    (row,) = quality.sync_health(table, CLOCK).collect()
    assert row.hours_since_last == 3


def test_radius(rows):
    df = rows("id int, latitude_numeric double, longitude_numeric double", (1, 36.0, -86.0), (2, 36.008, -86.0), (3, 36.01, -86.0), (4, None, None))
    assert sorted(r.id for r in quality.properties_within_radius(df, 36.0, -86.0, 1000).collect()) == [1, 2]


def test_snapshot_versions(spark, rows, tmp_path):
    store = snapshot.SnapshotStore(spark, str(tmp_path))
    assert not store.exists("t")
    store.write("t", rows("k string, v int", ("a", 1)))
    before = store.read("t")
    store.write("t", merge.merge(before, rows("k string, v int", ("a", 2), ("b", 3)), ["k"]).drop("op"))
    assert sorted(map(tuple, store.read("t").collect())) == [("a", 2), ("b", 3)]
    assert [tuple(r) for r in before.collect()] == [("a", 1)]
    with pytest.raises(FileNotFoundError):
        store.read("missing")


def test_replace_rewrites_only_the_touched_partitions(spark, rows, tmp_path):
    store = snapshot.SnapshotStore(spark, str(tmp_path))
    schema = "k string, p string, v int"
    store.write("t", rows(schema, ("a", "x", 1), ("b", "y/1 %", 2), ("c", None, 3)), "p")
    before = store.folders("t")
    counts = merge.upsert_table(store, "t", rows(schema, ("b", "y/1 %", 9), ("n", "new", 5)), ["k", "p"], "p")
    assert tuple(counts.first())[:2] == (1, 1)
    assert sorted(map(repr, map(tuple, store.read("t").collect()))) == sorted(
        map(repr, [("a", "x", 1), ("b", "y/1 %", 9), ("c", None, 3), ("n", "new", 5)])
    )
    after = store.folders("t")
    assert after["x"] == before["x"] and after["y/1 %"] != before["y/1 %"]
    assert store.vacuum("t") == 0 and store.vacuum("t", older_than_hours=-1) == 1
    store.replace("t", store.read("t", ["x"]).where("false"), ["x"])
    assert store.read("t").count() == 3 and store.read("t", ["x"]).count() == 0


def test_replace_partitions_leaves_others(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    snapshot.replace_partitions(rows("d string, v int", ("x", 1), ("y", 2)), path, ("d",))
    snapshot.replace_partitions(rows("d string, v int", ("y", 9)), path, ("d",))
    assert sorted((r.d, r.v) for r in spark.read.parquet(path).collect()) == [("x", 1), ("y", 9)]


def test_write_by_month_prunes(spark, rows, tmp_path):
    path = str(tmp_path / "m")
    snapshot.write_by_month(rows("id int, created_at timestamp", (1, datetime(2025, 1, 5)), (2, datetime(2025, 2, 5)), (3, None)), path)
    df = spark.read.parquet(path)
    assert df.count() == 3
    plan = df.where("created_month >= date'2025-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month" in plan


def test_vacuum_knows_current_folders_by_qualified_path(spark, rows, tmp_path):
    # The pointer was written with a scheme and an authority; listings come without it.
    store = snapshot.SnapshotStore(spark, f"file://{tmp_path}/s")
    store.write("t", rows("p string, v int", ("x", 1), ("y", 2)), "p")
    assert store.vacuum("t", older_than_hours=-1) == 0
    again = snapshot.SnapshotStore(spark, f"{tmp_path}/s")
    assert again.vacuum("t", older_than_hours=-1) == 0 and again.read("t").count() == 2


def test_qualified_paths_keep_the_authority(spark):
    fs = spark._jvm.org.apache.hadoop.fs
    local = fs.Path("HEAD").getFileSystem(spark._jsc.hadoopConfiguration())
    one = stores.qualified(fs.Path("file:///wh/t/v-1"), local)
    assert one == stores.qualified(fs.Path("/wh/t/v-1"), local)
    assert one != stores.qualified(fs.Path("file:///wh/t/v-2"), local)


def test_second_writer_fails_and_loses_nothing(spark, rows, tmp_path):
    store = snapshot.SnapshotStore(spark, str(tmp_path))
    store.write("t", rows("p string, v int", ("x", 1), ("y", 2)), "p")
    seen = store.snapshot()
    store.replace("t", rows("p string, v int", ("x", 5)), ["x"])
    with pytest.raises(snapshot.ConflictError):
        store.replace("t", rows("p string, v int", ("x", 6)), ["x"], based_on=seen)
    assert sorted((r.p, r.v) for r in store.read("t").collect()) == [("x", 5), ("y", 2)]
    assert [r.p for r in store.read("t", between=("y", "z")).collect()] == ["y"]


def test_task_without_assignee_gets_no_name(rows):
    from fieldstay.plans.trends import task_assignees

    tables = {
        "people": rows("person_id string, person_name string", (None, "Nobody"), ("7", "Ann")),
        "task_assignments": rows("task_pk long, assignee_id string", (1, None), (2, "7")),
        "tasks": rows("id long, task_name string, task_status_stage string, scheduled_date string", (1, "a", "new", None), (2, "b", "new", None)),
    }
    assert {r.task_pk: r.registered_name for r in task_assignees(tables, None).collect()} == {1: None, 2: "Ann"}


def test_whole_numbers_sent_as_text(rows):
    from fieldstay.functions.parsing import whole_number

    texts = ["4", " 4 ", "2.0", "2.5", "x", None, "99999999999"]
    got = [r[0] for r in rows("i int, t string", *enumerate(texts)).orderBy("i").select(whole_number(F.col("t"), "int")).collect()]
    assert got == [4, 4, 2, None, None, None, None]


def test_links_by_dates_with_very_long_ranges(rows):
    day = date
    stays = rows(
        "id long, property_pk long, region_code string, checkin_date date, checkout_date date",
        (1, 1, "a", day(2025, 1, 1), day(2025, 1, 5)), (2, 1, "a", day(2025, 1, 5), day(9025, 1, 1)), (3, 2, "a", day(25, 1, 1), day(2025, 1, 1)),
    )
    tasks = rows(
        "id long, property_pk long, region_code string, type_department string, scheduled_date date, checkin_date date, checkout_date date, reservation_pk long",
        (1, 1, "a", "housekeeping", day(2025, 1, 3), None, None, None), (2, 1, "a", "x", day(4000, 1, 1), day(4000, 1, 1), day(4000, 1, 2), None),
        (3, 2, "a", "x", day(1025, 1, 1), day(1, 1, 1), day(9000, 1, 1), None), (4, 3, "a", "x", day(2025, 1, 1), day(2025, 1, 1), day(2025, 1, 2), None),
    )
    got = {r.id: r.reservation_pk for r in keys.link_by_dates(tasks, stays).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: None}


def test_a_property_with_any_photo_is_not_listed(rows):
    from checks.tables import photoless

    properties = rows("id long, property_id string, region_code string, property_name string", *((i, f"p{i}", "a", f"P{i}") for i in (1, 2, 3)))
    photos = rows("property_pk long, photo_id string", (1, "0"), (2, "7"), (2, "8"), (None, "0"))
    assert [r.id for r in photoless({"properties": properties, "property_photos": photos}).collect()] == [3]


def test_every_requirement_counts_as_supply(rows):
    from checks.tables import child_tables

    tasks = rows("id long, region_code string, rate_paid double", (1, "a", None), (2, "b", 3.0))
    requirements = rows("task_pk long, photos string", (1, '["p"]'), (1, "[]"), (2, None), (9, "[]"))
    counts = quality.child_counts(child_tables({"tasks": tasks, "task_requirements": requirements})).collect()
    assert {(r.child, r.region_code): r.records for r in counts} == {("supplies", "a"): 2, ("supplies", "b"): 1, ("costs", "b"): 1}
