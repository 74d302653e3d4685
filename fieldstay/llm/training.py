"""A bounded, repeatable sample of labelled documents to train a classifier on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, *, id_col: str, text_col: str, folds: int, held_out: int, rows: int,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, text, label, x0, x1, ...)`` of at most ``rows`` labelled documents whose fold is not ``held_out``, chosen by a
    hash of the id, with the ``extra`` columns. Null ids and labels are left out; an id labelled twice counts once, with
    its larger label; of an id with several texts the one with the least hash counts (ties: the least extra columns).

    The chosen ids are at most ``rows``, so they are broadcast and the texts are not exchanged.
    """
    usable = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("label")).filter(
        F.col("_id").isNotNull() & F.col("label").isNotNull() & (remainder("_id", folds) != held_out)
    )
    chosen = usable.groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    more = [F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(extra)]
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *more)
    met = own.join(F.broadcast(chosen), own["id"] == chosen["_id"]).drop("_id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "label", *[f"x{i}" for i in range(len(extra))]))
    return met.groupBy("id").agg(first.alias("r")).select("id", "r.text", "r.label", *[f"r.x{i}" for i in range(len(extra))])


def fitting(sizes: DataFrame, most: int) -> list:
    """Ids of ``(id, n)`` in the order of a hash of the id, as many as together stay within ``most``; one that does not fit
    is left out and the next are tried. The rows are those of a bounded sample."""
    taken, held = [], 0
    for row in sizes.filter(F.col("n") <= most).orderBy(F.xxhash64("id"), "id").toLocalIterator():
        if held + row["n"] <= most:
            held += row["n"]
            taken.append(row["id"])
    return taken


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn raw scores into probabilities, by Newton steps on the smoothed log loss."""
    up, down = (labels == 1).sum(), (labels == 0).sum()
    if not up or not down:
        return 1.0, 0.0
    target = np.where(labels == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * scores + b)
        g = p - target
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * scores * scores).sum() + 1e-6, (w * scores).sum()], [(w * scores).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, np.array([(g * scores).sum() + 1e-6 * a, g.sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)
