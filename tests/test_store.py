"""The store of table snapshots: conflicts, transactions, ids, ranges, filters, changes, tiers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fieldstay.operators import merge
from fieldstay.operators.load import _number_new_rows
from fieldstay.sources.snapshot import ConflictError, SnapshotStore

SCHEMA = "k string, p string, v int"


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


@pytest.fixture
def filled(store, rows):
    store.write("t", rows(SCHEMA, ("a", "x", 1), ("b", "y", 2), ("c", "z", 3)), "p", key=["k"], ranges=["k"], finder="k")
    return store


def content(store, table="t", *values):
    return sorted(tuple(r) for r in store.read(table, *values).collect())


def test_a_change_from_an_older_version_is_refused(filled, rows):
    seen = filled.snapshot()
    filled.replace("t", rows(SCHEMA, ("a", "x", 10)), ["x"])
    with pytest.raises(ConflictError):
        filled.replace("t", rows(SCHEMA, ("a", "x", 20)), ["x"], based_on=seen)
    filled.replace("t", rows(SCHEMA, ("b", "y", 30)), ["y"], based_on=seen)
    assert content(filled) == [("a", "x", 10), ("b", "y", 30), ("c", "z", 3)]
    with pytest.raises(ConflictError):
        filled.write("t", rows(SCHEMA, ("q", "x", 1)), "p", based_on=seen)
    assert sorted(tuple(r) for r in seen.read("t").collect()) == [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)]


def test_an_upsert_is_done_again_on_the_newer_version(filled, rows):
    calls = []
    real = filled.begin

    def begin(based_on=None):
        if not calls:
            calls.append(1)
            filled.replace("t", rows(SCHEMA, ("a", "x", 5), ("n", "x", 6)), ["x"])
        return real(based_on)

    filled.begin = begin
    counts = merge.upsert_table(filled, "t", rows(SCHEMA, ("a", "x", 7)), ["k", "p"], "p").first()
    assert (counts.updated, content(filled, "t", ["x"])) == (1, [("a", "x", 7), ("n", "x", 6)])


def test_several_tables_change_together_or_not_at_all(filled, rows):
    number = filled.snapshot().number
    with pytest.raises(RuntimeError), filled.begin() as change:
        change.replace("t", rows(SCHEMA, ("a", "x", 100)), ["x"])
        change.write("u", rows("v int", (1,)))
        assert [r.v for r in change.read("t", ["x"]).collect()] == [100] and change.read("u").count() == 1
        raise RuntimeError("half way")
    assert filled.snapshot().number == number and not filled.exists("u") and content(filled, "t", ["x"]) == [("a", "x", 1)]
    with filled.begin() as change:
        change.drop("t", ["z"])
        change.write("u", rows("v int", (1,)))
    assert filled.snapshot().number == number + 1 and len(content(filled)) == 2 and content(filled, "u") == [(1,)]


def test_a_conflict_in_one_table_leaves_the_others(filled, rows):
    change = filled.begin()
    change.replace("t", rows(SCHEMA, ("a", "x", 100)), ["x"])
    change.write("u", rows("v int", (1,)))
    filled.drop("t", ["x"])
    with pytest.raises(ConflictError):
        change.commit()
    assert not filled.exists("u") and content(filled, "t") == [("b", "y", 2), ("c", "z", 3)]


def test_appends_do_not_conflict_and_come_once(filled, rows):
    one, two = filled.begin(), filled.begin()
    assert one.append("t", rows(SCHEMA, ("d", "x", 4)), token=("s", 1)) and two.append("t", rows(SCHEMA, ("e", "x", 5)), token=("r", 1))
    one.commit()
    two.commit()
    again = filled.begin()
    assert not again.append("t", rows(SCHEMA, ("d", "x", 4)), token=("s", 1))
    again.commit()
    assert content(filled, "t", ["x"]) == [("a", "x", 1), ("d", "x", 4), ("e", "x", 5)]
    assert filled.compact("t", most=1) == ["x"] and len(filled.folders("t")["x"]) == 1 and len(content(filled)) == 5


def test_writers_side_by_side_lose_nothing(filled, rows):
    parts = [rows(SCHEMA, (f"n{i}", f"p{i}", i)) for i in range(6)]

    def work(i):
        filled.replace("t", parts[i], [f"p{i}"])
        return filled.reserve("ids", 10)

    with ThreadPoolExecutor(6) as pool:
        firsts = list(pool.map(work, range(6)))
    assert len(content(filled)) == 9 and sorted(firsts) == [1, 11, 21, 31, 41, 51]


def test_two_loads_from_one_version_get_disjoint_ids(store, rows):
    store.write("t", rows("id long, k string, op string", (7, "a", "keep")))
    merged = rows("id long, k string, op string", (7, "a", "keep"), (None, "b", "insert"), (None, "c", "insert")).repartition(3)
    one, two = store.begin(), store.begin()
    ids = [{r.id for r in _number_new_rows(change, "t", merged).collect()} for change in (one, two)]
    assert all(len(i) == 3 and min(i - {7}) > 7 for i in ids) and ids[0] & ids[1] == {7}


def test_ranges_choose_folders(store, rows):
    data = rows("p string, day date", *[(f"{m:02d}", None) for m in range(1, 3)]).withColumn("day", F.make_date(F.lit(2025), F.col("p").cast("int"), F.lit(5)))
    store.write("t", data.unionByName(rows("p string, day date", ("03", None))), "p", ranges=["day"])
    seen = store.snapshot()
    assert seen.chosen("t", day=("2025-02-01", "9999")) == ["02"]
    assert [r.p for r in store.read("t", day=("2025-01-05", "2025-01-05")).collect()] == ["01"]
    files = store.read("t", day=("2025-02-01", "9999")).inputFiles()
    assert len(files) == 1 and sorted(seen.chosen("t")) == ["01", "02", "03"]


def test_finder_names_every_partition_with_a_key(store, rows, spark):
    data = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 7).cast("string").alias("p"), F.col("id").alias("v"))
    store.write("t", data, "p", key=["k"], finder="k")
    for wanted in (["k5"], ["k0", "k2999"], ["none"], []):
        keys = spark.createDataFrame([(w,) for w in wanted], "k string")
        truth = {r.p for r in data.where(F.col("k").isin(wanted)).collect()}
        found = set(store.find("t", keys))
        assert truth <= found and len(found) <= len(truth) + 1
    with store.begin() as change:
        change.append("t", data.where("id = 5").selectExpr("'new' AS k", "p", "v"))
    assert "5" in store.find("t", spark.createDataFrame([("new",)], "k string"))


def test_changes_win_until_they_are_compacted(filled, rows):
    with filled.begin() as change:
        assert sorted(change.change("t", rows(SCHEMA, ("a", "x", 10), ("n", "new", 9)))) == ["new", "x"]
    with filled.begin() as change:
        change.change("t", rows("k string, p string, v int, d boolean", ("a", "x", 11, False), ("b", "y", 2, True)), F.col("d"))
    want = [("a", "x", 11), ("c", "z", 3), ("n", "new", 9)]
    assert content(filled) == want and {v: len(f) for v, f in filled.folders("t").items()} == {"x": 3, "y": 2, "z": 1, "new": 1}
    assert set(filled.snapshot().chosen("t", k=("q", "r"))) == {"x", "y", "new"}
    assert filled.compact("t", most=1) == ["x"]
    with filled.begin() as change:
        change.change("t", rows(SCHEMA, ("a", "x", 12)))
    assert content(filled, "t", ["x"]) == [("a", "x", 12)]
    assert set(filled.compact("t", most=0)) >= {"x", "y", "new"} and content(filled) == [("a", "x", 12), *want[1:]]
    assert filled.vacuum("t", older_than_hours=-1) > 0 and content(filled) == [("a", "x", 12), *want[1:]]


def test_change_after_compaction_of_another_partition(filled, rows):
    for v in (1, 2, 3):
        with filled.begin() as change:
            change.change("t", rows(SCHEMA, ("a", "x", 10 + v), ("b", "y", 20 + v)))
    filled.compact("t", most=0, values=["y"])
    with filled.begin() as change:
        change.change("t", rows(SCHEMA, ("a", "x", 99)))
    assert content(filled) == [("a", "x", 99), ("b", "y", 23), ("c", "z", 3)]


def test_cold_partitions_keep_late_rows_beside_them(filled, rows):
    assert filled.tier("t", "y") == ["x"] and filled.tier("t", "y") == []
    before = filled.folders("t")["x"]
    merge.upsert_table(filled, "t", rows(SCHEMA, ("a", "x", 10), ("l", "x", 8), ("b", "y", 20)), ["k", "p"], "p")
    assert content(filled) == [("a", "x", 10), ("b", "y", 20), ("c", "z", 3), ("l", "x", 8)]
    assert filled.folders("t")["x"][:1] == before
    assert {(r.part, r.tier, r.late) for r in filled.tiers("t").collect()} == {("x", "cold", 1), ("y", "hot", 0), ("z", "hot", 0)}
    filled.compact("t", most=0)
    assert {(r.part, r.tier, r.late) for r in filled.tiers("t").collect()} == {("x", "cold", 0), ("y", "hot", 0), ("z", "hot", 0)}
    assert content(filled) == [("a", "x", 10), ("b", "y", 20), ("c", "z", 3), ("l", "x", 8)]


def test_a_change_needs_a_key(store, rows):
    store.write("t", rows(SCHEMA, ("a", "x", 1)), "p")
    with pytest.raises(ValueError), store.begin() as change:
        change.change("t", rows(SCHEMA, ("a", "x", 2)))
    assert content(store) == [("a", "x", 1)]


def test_rows_appended_and_then_replaced_count_once(filled, rows):
    with filled.begin() as change:
        change.append("t", rows(SCHEMA, ("d", "x", 4), ("e", "y", 5)))
        change.replace("t", change.read("t", ["x"]), ["x"])
        filled.replace("t", rows(SCHEMA, ("c", "z", 30)), ["z"])
    assert content(filled) == [("a", "x", 1), ("b", "y", 2), ("c", "z", 30), ("d", "x", 4), ("e", "y", 5)]
