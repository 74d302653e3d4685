"""Preference formatting: a shared prompt and masked completions of chosen and rejected conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 64
# The turn template.
OPEN, CLOSE = "<|", "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    """One turn: ``<|role|>``, a line feed, the text and an end mark."""
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE))


def one_per_turn(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``(pair_id, turn, said)``: rows without a key or turn number have no place and are left out; of several rows with
    the same place the one that sorts first by role and text counts."""
    placed = turns.filter(F.col(key).isNotNull() & F.col(turn).isNotNull())
    said = F.struct(F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return placed.groupBy(F.col(key).alias("pair_id"), F.col(turn).cast("long").alias("turn")).agg(F.min(said).alias("said"))


def format_preferences(
    chosen: DataFrame, rejected: DataFrame, *, key: str = "pair_id", turn: str = "turn", role: str = "role",
    text: str = "text", learner: str = "assistant", part_turns: int = PART_TURNS,
) -> DataFrame:
    """``(pair_id, segment, part, n_turns, text, mask)``: the longest common prefix of turns of the chosen and the
    rejected conversation of each pair as segment ``prompt``, once, and what follows as segments ``chosen`` and
    ``rejected``. ``mask`` lists start (from 0) and length, in characters, of what a loss may count: the texts with
    their end marks of the ``learner``'s turns in the completions, nothing in the prompt.

    Turns are equal if role and text are (null: empty) at the same turn number. Turns meet by pair and number, so a
    conversation of any length is compared in many tasks; only the first difference of a pair is joined back. Segments
    come in parts of turn numbers ``part * part_turns`` and up, so no conversation is gathered whole; a segment's text
    is its parts in order. A pair with one side only has no common prefix; equal sides have a prompt only. Columns
    other than the four named are not carried; no rows give no rows.
    """
    good = one_per_turn(chosen, key, turn, role, text).withColumnRenamed("said", "good")
    bad = one_per_turn(rejected, key, turn, role, text).withColumnRenamed("said", "bad")
    both = good.join(bad, ["pair_id", "turn"], "full")
    differs = F.col("good").isNull() | F.col("bad").isNull() | (F.col("good") != F.col("bad"))
    first = both.filter(differs).groupBy(F.col("pair_id").alias("_pair")).agg(F.min("turn").alias("_first"))
    split = both.join(first, F.col("pair_id") == F.col("_pair"), "left")
    shared = F.col("_first").isNull() | (F.col("turn") < F.col("_first"))
    segments = F.when(
        shared, F.array(F.struct(F.lit("prompt").alias("segment"), F.col("good").alias("said")))
    ).otherwise(
        F.filter(
            F.array(
                F.struct(F.lit("chosen").alias("segment"), F.col("good").alias("said")),
                F.struct(F.lit("rejected").alias("segment"), F.col("bad").alias("said")),
            ),
            lambda s: s["said"].isNotNull(),
        )
    )
    turns = split.select("pair_id", "turn", F.explode(segments).alias("s")).select(
        "pair_id", "turn", "s.segment", "s.said.role", "s.said.text"
    )
    learned = (F.col("segment") != "prompt") & (F.col("role") == learner)
    shaped = turns.select(
        "pair_id",
        "segment",
        F.floor(F.col("turn") / part_turns).alias("part"),
        F.struct(
            "turn",
            rendered(F.col("role"), F.col("text")).alias("line"),
            F.when(learned, F.length(F.col("role")) + len(OPEN) + 3).alias("from"),
            (F.length("text") + len(CLOSE)).alias("size"),
        ).alias("t"),
    )
    parts = shaped.groupBy("pair_id", "segment", "part").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    # Characters before each turn, added up along the part.
    sums = F.aggregate(
        "ts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("mask")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["line"])).alias("at"),
            F.when(
                t["from"].isNotNull(),
                F.concat(acc["mask"], F.array(F.struct((acc["at"] + t["from"]).alias("start"), t["size"].alias("length")))),
            )
            .otherwise(acc["mask"])
            .alias("mask"),
        ),
        lambda acc: acc["mask"],
    )
    return parts.select(
        "pair_id",
        "segment",
        "part",
        F.size("ts").cast("long").alias("n_turns"),
        F.array_join(F.transform("ts", lambda t: t["line"]), "").alias("text"),
        sums.alias("mask"),
    )
