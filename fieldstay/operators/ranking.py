"""Ranks, percentiles and one-row-per-key selections that do not gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldstay.session import durable

# Percentile buckets are 2**26 microseconds (about 67 s) wide: a bucket holds at most 2**26
# distinct values and ten years of durations make fewer than 5 million buckets.
BUCKET_BITS = 26


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL, keeping the left side's key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def row_slot(df: DataFrame) -> Column:
    """A number by the row's content, from 1 to eight times the shuffle partitions, so that every partition gets some.

    It depends on nothing but the row, so a task that is run again after a lost executor sends every
    row where the first run sent it.
    """
    slots = 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*plain), F.lit(slots)) + 1


def join_sparse(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that many left rows lack: rows with a NULL key are spread over all tasks."""
    slot = F.when(F.col(key).isNotNull(), F.lit(0)).otherwise(row_slot(left))
    there = right.withColumn("_slot", F.lit(0).cast("long"))
    return left.withColumn("_slot", slot).join(there, [key, "_slot"], "left").drop("_slot")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; NULL keys are equal to each other.

    The rank limit is applied before the exchange as well as after it, so a key with very many
    copies sends one row per input partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pos", F.row_number().over(w)).where(F.col("_pos") == 1).drop("_pos")


@dataclass(frozen=True)
class Rank:
    """A dense rank to add: name, value ranked, the columns it restarts at, and direction.

    NULL values come last in both directions.
    """

    name: str
    value: str
    within: tuple[str, ...] = ()
    descending: bool = True

    def order(self) -> Column:
        c = F.col(self.value)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_last()


def dense_ranks(df: DataFrame, ranks: Sequence[Rank]) -> DataFrame:
    """Add dense ranks to an aggregated frame.

    The frame is materialised once and ranked by its distinct values: these are range-partitioned
    into slices, ranked inside each slice, shifted by the number of values in earlier slices and
    joined back.
    """
    base = durable(df)
    for r in ranks:
        base = join_on(base, sliced_dense_rank(base, r), [*r.within, r.value])
    return base


def sliced_dense_rank(df: DataFrame, rank: Rank) -> DataFrame:
    """(within columns, value, rank) for every distinct value, no task seeing a whole group."""
    keys = list(rank.within)
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = durable(
        df.select(*keys, rank.value)
        .distinct()
        .repartitionByRange(slices, *[F.col(k) for k in keys], rank.order())
        .withColumn("_slice", F.spark_partition_id())
    )
    local = F.dense_rank().over(Window.partitionBy(*keys, "_slice").orderBy(rank.order()))
    ranked = join_on(
        sliced.withColumn("_local", local), _rows_before(sliced, keys, F.count(F.lit(1))), [*keys, "_slice"]
    )
    return ranked.select(
        *keys,
        rank.value,
        (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("int").alias(rank.name),
    )


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add each row's 0-based position within its key, NULLs last.

    Equal rows are first reduced to a count, the rest is range-partitioned by key and order, counted
    up inside each slice and shifted by the rows of the key in earlier slices: neither a key nor its
    copies meet in one task. ``order`` must name every column that is not a key.
    """
    keys, by = list(keys), [F.col(c).asc_nulls_last() for c in order]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = durable(
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .repartitionByRange(slices, *[F.col(k) for k in keys], *by)
        .withColumn("_slice", F.spark_partition_id())
    )
    earlier = Window.partitionBy(*keys, "_slice").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    counted = join_on(
        sliced.withColumn("_local", F.coalesce(F.sum("_copies").over(earlier), F.lit(0))),
        _rows_before(sliced, keys, F.sum("_copies")),
        [*keys, "_slice"],
    )
    first = F.col("_local") + F.coalesce("_before", F.lit(0))
    return counted.select(*df.columns, F.explode(F.sequence(first, first + F.col("_copies") - 1)).alias(name))


def _rows_before(sliced: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Rows of a key in its earlier slices: (keys, _slice, _before)."""
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = sliced.groupBy(*keys, "_slice").agg(size.alias("_n"))
    return counts.withColumn("_before", F.sum("_n").over(earlier)).drop("_n")


@dataclass(frozen=True)
class Percentile:
    """``name`` = continuous percentile ``p`` of the microsecond column ``micros``, over ``unit``."""

    name: str
    micros: str
    p: float
    unit: int


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], wanted: Sequence[Percentile]
) -> DataFrame:
    """Interpolated percentiles per group, exact for groups of any size.

    Values are counted first (a map-side combined histogram spread over all tasks by value). Counts
    per coarse bucket locate the buckets that hold the wanted ranks; only the values of those
    buckets are then put in order. NULL values are ignored; a group without values has no row.
    """
    keys = list(keys)
    metrics = sorted({w.micros for w in wanted})
    # One struct holds the group: structs compare NULL parts as equal, so plain joins and windows on
    # it agree on their partitioning.
    owner = F.struct(*[F.col(k) for k in keys]).alias("_k") if keys else F.lit(0).alias("_k")
    if len(metrics) == 1:
        values = df.select(owner, F.lit(0).alias("_m"), F.col(metrics[0]).alias("_v"))
    else:
        pairs = [F.struct(F.lit(i).alias("_m"), F.col(m).alias("_v")) for i, m in enumerate(metrics)]
        values = df.select(owner, F.inline(F.array(*pairs)))
    group = ["_k", "_m"]
    # The filter names every join column, so that the join adds none of its own below the histogram
    # and both of its readers share one exchange.
    counted = values.withColumn("_b", F.shiftright(F.col("_v"), BUCKET_BITS)).where(
        F.col("_v").isNotNull() & F.col("_b").isNotNull() & F.col("_m").isNotNull() & F.col("_k").isNotNull()
    )
    hist = counted.groupBy(*group, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))

    whole = Window.partitionBy(*group)
    buckets = (
        hist.groupBy(*group, "_b")
        .agg(F.sum("_c").alias("_c"))
        .withColumn("_end", F.sum("_c").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_c").over(whole))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )

    def position(w: Percentile) -> Column:
        return F.lit(float(w.p)) * (F.col("_total") - 1)

    def in_range(w: Percentile, lo: str, hi: str) -> tuple[Column, Column, Column]:
        mine = F.col("_m") == metrics.index(w.micros)
        below, above = F.floor(position(w)), F.ceil(position(w))
        return (
            mine,
            (below >= F.col(lo)) & (below < F.col(hi)),
            (above >= F.col(lo)) & (above < F.col(hi)),
        )

    holds_any = F.lit(False)
    for w in wanted:
        mine, at_lo, at_hi = in_range(w, "_start", "_end")
        holds_any = holds_any | (mine & (at_lo | at_hi))
    needed = buckets.where(holds_any).select(*group, "_b", "_start", "_total")

    inside = Window.partitionBy(*group, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = (
        hist.join(needed, [*group, "_b"])
        .withColumn("_hi", F.col("_start") + F.sum("_c").over(inside))
        .withColumn("_lo", F.col("_hi") - F.col("_c"))
    )
    picks, results = [], []
    for i, w in enumerate(wanted):
        mine, at_lo, at_hi = in_range(w, "_lo", "_hi")
        picks += [
            F.max(F.when(mine & at_lo, F.col("_v"))).alias(f"_lo{i}"),
            F.max(F.when(mine & at_hi, F.col("_v"))).alias(f"_hi{i}"),
            F.max(F.when(mine, position(w) - F.floor(position(w)))).alias(f"_f{i}"),
        ]
        low, high = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        results.append(((low + (high - low) * F.col(f"_f{i}")) / w.unit).alias(w.name))
    return ordered.groupBy("_k").agg(*picks).select(*[F.col(f"_k.{k}").alias(k) for k in keys], *results)
