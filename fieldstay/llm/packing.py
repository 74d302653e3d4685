"""Pack token pieces into sequences of a fixed length by cutting-stock column generation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldstay.llm.cutting_stock import column_generation, rounded
from fieldstay.llm.storage import materialise, numbered, slots_for

OWN = ("_class", "_row", "_slot", "_from", "_to", "_first", "_each", "_place", "rank", "sequence_id", "offset")


def plan(histogram: dict[int, int], classes: int) -> tuple[list[tuple], int]:
    """Rank intervals ``(class, from, to, first sequence, pieces a sequence, place)`` and the number of sequences."""
    demand = np.zeros(classes, np.int64)
    for c, n in histogram.items():
        demand[c - 1] = n
    taken = np.zeros(classes, np.int64)
    rows, sequences = [], 0
    for pattern, bins in rounded(demand, column_generation(demand)):
        place = 0
        # The longest pieces come first in a sequence.
        for k in np.flatnonzero(pattern)[::-1]:
            each = int(pattern[k])
            rows.append((int(k) + 1, int(taken[k]), int(taken[k]) + each * bins, sequences, each, place))
            taken[k] += each * bins
            place += each
        sequences += bins
    return rows, sequences


def pack(pieces: DataFrame, *, capacity: int = 2048, grain: int = 8, key: tuple[str, ...] = ("id", "start")) -> DataFrame:
    """``pieces`` (a materialised table with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``:
    sequences are numbered from 0 without gaps and filled without gaps from offset 0.

    Lengths are rounded up to ``grain`` tokens for the plan only, so the histogram that reaches the driver has at
    most ``capacity / grain`` rows at any scale and a piece wastes less than ``grain`` tokens. The linear program's
    patterns, rounded down, and first-fit bins for the rest say how many pieces of which class share a sequence;
    pieces get a rank in their class (dealt out by a number of their own, so that no class is numbered in one task) and
    find their sequence by the interval of ranks. Pieces without a length are left out; no pieces give no rows.
    Other columns are carried; columns named like those added are replaced.
    """
    if capacity % grain:
        raise ValueError("the grain must divide the capacity")
    classes = capacity // grain
    spark = pieces.sparkSession
    kept = pieces.drop(*[c for c in pieces.columns if c in OWN])
    kept = kept.filter("length is not null").withColumn("_class", F.ceil(F.col("length") / grain).cast("int"))
    # At most ``classes`` rows.
    histogram = {r[0]: r[1] for r in kept.groupBy("_class").count().collect()}
    if any(c < 1 or c > classes for c in histogram):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    intervals, _ = plan(histogram, classes)
    # Bounded by the classes, not by the pieces: patterns times the classes in them.
    table = F.broadcast(
        spark.createDataFrame(intervals, "_class int, _from long, _to long, _first long, _each long, _place long")
    )
    # Rows are dealt out by a number of their own, so many pieces with one key are dealt out too; stored, so that
    # every pass sees the same numbers.
    slotted = materialise(
        kept.withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_slot", F.pmod(F.xxhash64("_row"), F.lit(slots_for(spark))).cast("int")),
        "slotted-pieces",
    )
    order = [F.desc("length"), *key, "_row"]
    ranked = numbered(slotted, "_class", order, "_slot")
    placed = (
        ranked.join(table, "_class")
        .filter((F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
        .withColumn("sequence_id", F.col("_first") + F.floor((F.col("rank") - F.col("_from")) / F.col("_each")))
        .withColumn("_place", F.col("_place") + (F.col("rank") - F.col("_from")) % F.col("_each"))
    )
    # A sequence holds at most ``capacity`` pieces.
    ahead = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop(
        "_class", "_row", "_slot", "_from", "_to", "_first", "_each", "_place", "rank"
    )


def sequences(packed: DataFrame, *, capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """``(sequence_id, n_tokens, length, ids)`` of packed pieces that carry ``ids`` (binary, 4 bytes an id): the ids
    one after the other, padded to ``capacity`` unless their number is a power of two."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"]))).alias("_hex")
    )
    whole = F.bit_count("n_tokens") == 1
    length = F.when(whole, F.col("n_tokens")).otherwise(F.lit(capacity))
    pad = F.hex(F.lit(int(pad_id).to_bytes(4, "little")))
    return joined.select(
        "sequence_id",
        "n_tokens",
        length.cast("long").alias("length"),
        F.unhex(F.concat("_hex", F.repeat(pad, (length - F.col("n_tokens")).cast("int")))).alias("ids"),
    )
