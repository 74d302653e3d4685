"""Foreign-key resolution against reference tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.operators.ranking import join_on, row_slot
from fieldstay.session import durable

# Widths in days of the bins of each level, and how many bins of a level a range may touch before the next is its own.
BIN_DAYS = (8, 512, 32_768, 2_097_152)
MOST_BINS = 65


def _lookup(ref: DataFrame, on: Mapping[str, str], take: str, into: str, also: Sequence[str] = ()) -> DataFrame:
    """(key columns as text, found id): one row per key, the lowest id of equal keys, with its ``also`` columns."""
    named = ref.select(*[F.col(r).cast("string").alias(f"_k_{d}") for d, r in on.items()], F.col(take).alias(into), *also)
    keys = [f"_k_{d}" for d in on]
    return named.groupBy(*keys).agg(F.min(into).alias(into), *[F.min_by(c, into).alias(c) for c in also])


def _find(df: DataFrame, ref: DataFrame, on: Mapping[str, str], take: str, into: str, how: str, also: Sequence[str] = ()) -> DataFrame:
    keys = {f"_k_{d}": F.col(d).cast("string") for d in on}
    return df.withColumns(keys).join(_lookup(ref, on, take, into, also), list(keys), how).drop(*keys)


def _find_sparse(
    df: DataFrame, ref: DataFrame, on: Mapping[str, str], take: str, into: str, needs: Column
) -> DataFrame:
    """Left join of the rows that ``needs`` names; the others have no key and are spread over all tasks."""
    asked = {f"_k_{d}": F.when(needs, F.col(d).cast("string")) for d in on}
    slot = F.when(needs, F.lit(0).cast("long")).otherwise(row_slot(df))
    there = _lookup(ref, on, take, into).withColumn("_slot", F.lit(0).cast("long"))
    keys = [*asked, "_slot"]
    return df.withColumns({**asked, "_slot": slot}).join(there, keys, "left").drop(*keys)


def fill_key(df: DataFrame, ref: DataFrame, on: Mapping[str, str], fk: str, take: str = "id") -> DataFrame:
    """Set ``fk`` where it is NULL and a reference row matches; other values stay.

    One pass over ``df``. Rows that need nothing (key absent, or ``fk`` there) match nothing and are
    spread, so a mass of resolved or keyless rows never meets in one task.
    """
    needs = F.col(fk).isNull()
    for d in on:
        needs = needs & F.col(d).isNotNull()
    found = _find_sparse(df, ref, on, take, "_found", needs)
    return found.withColumn(fk, F.coalesce(fk, "_found")).select(*df.columns)


def overwrite_key(df: DataFrame, ref: DataFrame, on: Mapping[str, str], fk: str, take: str = "id") -> DataFrame:
    """Set ``fk`` on every match, replacing an older value; without a match the old value stays."""
    has_key = F.lit(True)
    for d in on:
        has_key = has_key & F.col(d).isNotNull()
    found = _find_sparse(df, ref, on, take, "_found", has_key)
    return found.withColumn(fk, F.coalesce("_found", fk)).select(*df.columns)


def require_key(df: DataFrame, ref: DataFrame, on: Mapping[str, str], fk: str, take: str = "id", also: Sequence[str] = ()) -> DataFrame:
    """Add ``fk``, and ``also`` columns of the row it was found in; rows without a match are dropped."""
    return _find(df, ref, on, take, fk, "inner", also)


def unresolved_count(df: DataFrame, ref: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """How many rows :func:`require_key` would drop."""
    keys = {f"_k_{d}": F.col(d).cast("string") for d in on}
    known = ref.select(*[F.col(r).cast("string").alias(f"_k_{d}") for d, r in on.items()])
    return df.withColumns(keys).join(known, list(keys), "left_anti").agg(F.count(F.lit(1)).alias("unresolved"))


def _level(first: Column, last: Column) -> Column:
    """The finest level on which a date range touches few day bins."""
    lo, hi = F.unix_date(F.least(first, last)), F.unix_date(F.greatest(first, last))
    level = F.lit(len(BIN_DAYS) - 1)
    for n in reversed(range(len(BIN_DAYS) - 1)):
        level = F.when(F.floor(hi / BIN_DAYS[n]) - F.floor(lo / BIN_DAYS[n]) < MOST_BINS, n).otherwise(level)
    return level


def _bins(first: Column, last: Column, levels: Sequence[int], wanted: Callable[[int], Column]) -> Column:
    """(_at, _bin) of the day bins a date range touches on the wanted ones of some levels. No coarser than its own level, a
    range of a thousand years takes no more rows than one of a year."""
    lo, hi = F.unix_date(F.least(first, last)), F.unix_date(F.greatest(first, last))

    def at(n: int) -> Column:
        numbers = F.sequence(F.floor(lo / BIN_DAYS[n]), F.floor(hi / BIN_DAYS[n]))
        rows = F.transform(numbers, lambda b: F.struct(F.lit(n).alias("_at"), b.alias("_bin")))
        return F.when(wanted(n), rows).otherwise(F.array())

    return F.inline(F.concat(*(at(n) for n in levels)))


def _meetings(questions: DataFrame, stays: DataFrame, place: Sequence[str]) -> DataFrame:
    """Questions with the stays of their place whose dates (``_from``, ``_to``, with their ``_level``) share a day bin.

    Ranges meet on the level of the longer one. Short ranges, nearly all, only take bins of the finest level; on
    coarser levels only the places with a longer range on the other side take part.
    """
    first, last, fine, coarse = F.col("_from"), F.col("_to"), [0], range(1, len(BIN_DAYS))
    on = [*place, "_at", "_bin"]

    def bins(side: DataFrame, levels, wanted) -> DataFrame:
        return side.select("*", _bins(first, last, levels, wanted)).drop("_from", "_to", "_level")

    def short(side: DataFrame) -> DataFrame:
        return bins(side.where("_level = 0"), fine, lambda n: F.lit(True))

    def longer(side: DataFrame) -> DataFrame:
        return bins(side.where("_level > 0"), coarse, lambda n: F.col("_level") == n)

    def around(side: DataFrame, other: DataFrame, wanted) -> DataFrame:
        places = other.where("_level > 0").select(*place).distinct()
        return bins(side.join(places, list(place), "left_semi"), coarse, wanted)

    met = short(questions).join(short(stays), on)
    met = met.unionByName(around(questions, stays, lambda n: F.col("_level") <= n).join(longer(stays), on))
    return met.unionByName(longer(questions).join(around(stays, questions, lambda n: F.col("_level") < n), on))


def link_by_dates(tasks: DataFrame, reservations: DataFrame) -> DataFrame:
    """Fill ``reservation_pk`` from dates on the same property and region.

    Three rules in order: equal arrival and departure; a housekeeping task scheduled from arrival to
    the day after departure; overlapping date ranges. Among matches of one rule the nearest arrival
    wins, then the lowest id.

    Reservations with equal dates and tasks with equal dates have equal answers, so both sides are
    reduced to distinct dates first. They then meet on (property, region, day bin): neither a busy property
    nor a long history makes a group of all pairs, and a date far off by a typing error takes few rows.
    """
    place = ["property_pk", "region_code"]
    asked = [*place, "_cleaning", "scheduled_date", "checkin_date", "checkout_date"]
    open_tasks = tasks.where(F.col("reservation_pk").isNull()).withColumn(
        "_cleaning", F.col("type_department").eqNullSafe("housekeeping")
    )
    starts = F.least("checkin_date", "checkout_date", "scheduled_date")
    ends = F.greatest("checkin_date", "checkout_date", "scheduled_date")
    questions = (
        open_tasks.select(*asked).distinct()
        .where(F.col("property_pk").isNotNull() & F.col("region_code").isNotNull() & starts.isNotNull())
        .select("*", starts.alias("_from"), ends.alias("_to"), _level(starts, ends).alias("_level"))
    )
    stays = (
        reservations.where(F.col("checkin_date").isNotNull() & F.col("checkout_date").isNotNull())
        .groupBy(*place, F.col("checkin_date").alias("_in"), F.col("checkout_date").alias("_out"))
        .agg(F.min("id").alias("_res"))
        .select("*", F.col("_in").alias("_from"), F.date_add("_out", 1).alias("_to"), _level(F.col("_in"), F.date_add("_out", 1)).alias("_level"))
    )
    same = (F.col("checkin_date") == F.col("_in")) & (F.col("checkout_date") == F.col("_out"))
    around = F.col("_cleaning") & F.col("scheduled_date").between(F.col("_in"), F.date_add("_out", 1))
    overlap = (F.col("checkin_date") <= F.col("_out")) & (F.col("checkout_date") >= F.col("_in"))
    rule = F.when(same, 1).when(around, 2).when(overlap, 3)
    distance = F.abs(F.date_diff(F.coalesce("checkin_date", "scheduled_date"), F.col("_in")))
    answers = (
        _meetings(durable(questions), durable(stays), place)
        .withColumn("_rule", rule)
        .where(F.col("_rule").isNotNull())
        .groupBy(*asked)
        .agg(F.min(F.struct("_rule", distance.alias("_d"), "_res"))["_res"].alias("_res"))
    )
    linked = join_on(open_tasks, answers, asked).withColumn("reservation_pk", F.col("_res"))
    done = tasks.where(F.col("reservation_pk").isNotNull())
    return done.unionByName(linked.select(*tasks.columns))
