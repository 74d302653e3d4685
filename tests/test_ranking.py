"""Ranks, positions and percentiles against brute force."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldstay.operators.ranking import (
    Percentile,
    Rank,
    dense_ranks,
    exact_percentiles,
    first_per_key,
    join_on,
    join_sparse,
    positions,
)


def dense(values, descending):
    known = sorted({v for v in values if v is not None}, reverse=descending)
    order = {v: i + 1 for i, v in enumerate(known)}
    return [order.get(v, len(known) + 1) for v in values]


@pytest.mark.parametrize("descending", [True, False])
def test_dense_ranks(spark, descending):
    rng = random.Random(3)
    data = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, region string, v int")
    out = dense_ranks(
        df, [Rank("r", "v", ("region",), descending), Rank("g", "v", (), descending)]
    ).collect()
    got = {r["id"]: (r["r"], r["g"]) for r in out}
    overall = dense([d[2] for d in data], descending)
    for region in ("a", "b", None):
        members = [d for d in data if d[1] == region]
        for d, rank in zip(members, dense([m[2] for m in members], descending), strict=True):
            assert got[d[0]] == (rank, overall[d[0]])


def test_positions_count_every_copy(spark):
    rng = random.Random(5)
    data = [("hot" if i % 3 else f"k{i}", rng.choice([None, "x", "y"]), rng.randrange(5)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, s string, n int")
    out = positions(df, ["k"], ["s", "n"], "pos").collect()
    assert len(out) == len(data)
    for key in {d[0] for d in data}:
        mine = sorted((r for r in out if r["k"] == key), key=lambda r: r["pos"])
        assert [r["pos"] for r in mine] == list(range(len(mine)))
        wanted = sorted(((d[1], d[2]) for d in data if d[0] == key), key=lambda t: (t[0] is None, t[0] or "", t[1]))
        assert [(r["s"], r["n"]) for r in mine] == wanted


def brute_percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo, hi = int(at), min(int(at) + (at > int(at)), len(values) - 1)
    return values[lo] + (values[hi] - values[lo]) * (at - int(at))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(st.none(), st.integers(-(2**40), 2**40), st.integers(0, 3)),
            st.integers(0, 2**28),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_exact_percentiles(spark, data):
    df = spark.createDataFrame(data, "g string, x long, y long")
    wanted = [
        Percentile("x50", "x", 0.5, 1), Percentile("x90", "x", 0.9, 1), Percentile("y25", "y", 0.25, 1000)
    ]
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], wanted).collect()}
    for g in {d[0] for d in data}:
        xs = [d[1] for d in data if d[0] == g and d[1] is not None]
        ys = [d[2] for d in data if d[0] == g]
        assert got[g]["y25"] == pytest.approx(brute_percentile(ys, 0.25) / 1000)
        for name, p in (("x50", 0.5), ("x90", 0.9)):
            assert got[g][name] == (pytest.approx(brute_percentile(xs, p)) if xs else None)


def test_percentile_agrees_with_builtin_on_many_rows(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7).alias("g"), (F.xxhash64("id") % 10_000_000_000).alias("v")
    )
    ours = exact_percentiles(df, ["g"], [Percentile("p", "v", 0.9, 1)])
    theirs = df.groupBy("g").agg(F.percentile("v", F.lit(0.9)).alias("q"))
    for r in ours.join(theirs, "g").collect():
        assert r["p"] == pytest.approx(r["q"], rel=1e-12)


def test_first_per_key_treats_null_keys_as_equal(rows):
    df = rows("k string, n int", ("a", 2), ("a", 1), (None, 4), (None, 3))
    out = first_per_key(df, ["k"], [F.col("n").asc()])
    assert sorted((r["k"] or "", r["n"]) for r in out.collect()) == [("", 3), ("a", 1)]


def test_first_per_key_limits_before_the_exchange(rows):
    df = rows("k string, n int", ("a", 2))
    plan = first_per_key(df, ["k"], [F.col("n").asc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_join_on_is_null_safe(rows):
    left, right = rows("k string, a int", ("x", 1), (None, 2)), rows("k string, b int", (None, 9))
    out = {r["k"]: r["b"] for r in join_on(left, right, ["k"]).collect()}
    assert out == {"x": None, None: 9}


def test_join_sparse_keeps_null_rows_unmatched(rows):
    left = rows("k string, a int", ("x", 1), (None, 2), (None, 3))
    right = rows("k string, b int", ("x", 7))
    assert sorted((r["a"], r["b"]) for r in join_sparse(left, right, "k").collect()) == [(1, 7), (2, None), (3, None)]
