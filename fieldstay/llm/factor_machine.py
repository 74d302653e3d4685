"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fieldstay.llm.storage import map_arrow, materialise, release, whole_row
from fieldstay.llm.training import fitting, labelled_sample, platt, sigmoid
from fieldstay.llm.words import Words, batches_of, buckets, plain, split_words

STATISTICS = (
    "log_words", "word_length", "distinct_share", "top_share", "echo_share", "symbol_share", "upper_share", "digit_share",
    "mark_share", "log_lines", "repeated_lines",
)
SEED = 17
# Text handled at a time; a worker's arrays are a few dozen times as large.
STEP_BYTES = 1 << 21


class Model(NamedTuple):
    """Weights of the hashed words, then of the statistics and the metadata; how to scale those; the calibration."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    slope: float
    offset: float


class Rows(NamedTuple):
    """Sparse rows: row i has the entries from ``offsets[i]`` to ``offsets[i + 1]``."""

    index: np.ndarray
    value: np.ndarray
    offsets: np.ndarray


def _sums(values: np.ndarray, words: Words) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[words.offsets[1:]] - total[words.offsets[:-1]]


def statistics(texts: pa.Array, words: Words) -> np.ndarray:
    """One row of structure statistics a text; texts without words have zeros."""
    n = np.diff(words.offsets).astype(float)
    some = np.maximum(n, 1)
    values, codes = words.values, words.codes
    length = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(float)

    def count(pattern: str) -> np.ndarray:
        found = pc.count_substring_regex(values, pattern=pattern).to_numpy(zero_copy_only=False).astype(float)
        return _sums(found[codes], words)

    letters = np.maximum(_sums(length[codes], words), 1)
    owner = np.repeat(np.arange(len(n)), np.diff(words.offsets))
    echo = np.zeros(len(codes))
    echo[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    lines = [[x for x in t.split("\n") if x.strip()] for t in texts.to_pylist()]
    n_lines = np.array([len(x) for x in lines], float)
    own = np.array([len(set(x)) for x in lines], float)
    pairs, counts = np.unique(owner * np.int64(len(values) + 1) + codes, return_counts=True)
    of = (pairs // (len(values) + 1)).astype(np.int64)
    distinct = np.bincount(of, minlength=len(n)).astype(float)
    top = np.zeros(len(n))
    np.maximum.at(top, of, counts)
    return np.column_stack(
        [
            np.log1p(n), _sums(length[codes], words) / some, distinct / some, top / some, _sums(echo, words) / some,
            count("[#*$%&|<>]") / letters, count("[A-Z]") / letters, count("[0-9]") / letters, count("[!?]") / letters,
            np.log1p(n_lines), (n_lines - own) / np.maximum(n_lines, 1),
        ]
    )


def word_rows(words: Words, size: int) -> Rows:
    """The hashed words of each text, counts scaled to length one."""
    n = len(words.offsets) - 1
    bucket = buckets(words.values, size, SEED)[words.codes]
    owner = np.repeat(np.arange(n), np.diff(words.offsets))
    pairs, counts = np.unique(owner * np.int64(size) + bucket, return_counts=True)
    of, index = pairs // size, pairs % size
    norm = np.sqrt(np.bincount(of, weights=counts.astype(float) ** 2, minlength=n))
    return Rows(index, counts / norm[of], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]))


def dense_features(batch: pa.RecordBatch, words: Words) -> np.ndarray:
    """Statistics, then the logarithm of each metadata column (null: zero), the batch's columns from the third on."""
    texts = pc.fill_null(plain(batch.column(1)), "")
    extra = [
        np.log1p(np.maximum(np.nan_to_num(pc.fill_null(batch.column(i), 0.0).to_numpy(zero_copy_only=False)), 0))
        for i in range(2, batch.num_columns)
    ]
    return np.column_stack([statistics(texts, words), *extra])


def joined(rows: Rows, dense: np.ndarray, model: Model, size: int) -> Rows:
    """The words' entries with the scaled dense features behind them."""
    z = np.clip((dense - model.centre) / model.spread, -4, 4)
    n, d = z.shape
    index = np.insert(rows.index, np.repeat(rows.offsets[1:], d), np.tile(size + np.arange(d), n))
    value = np.insert(rows.value, np.repeat(rows.offsets[1:], d), z.ravel())
    return Rows(index, value, rows.offsets + d * np.arange(n + 1))


def raw_scores(model: Model, rows: Rows) -> np.ndarray:
    """Bias, linear part and all pairwise interactions, in time linear in the entries: the pairs' sum is half the
    square of the factors' sum less the sum of their squares."""
    if len(rows.offsets) == 1:
        return np.zeros(0)
    at = rows.offsets[:-1]
    weighted = model.factors[rows.index] * rows.value[:, None]
    sums = np.add.reduceat(weighted, at, axis=0)
    squares = np.add.reduceat((weighted * weighted).sum(axis=1), at)
    return model.bias + np.add.reduceat(model.linear[rows.index] * rows.value, at) + 0.5 * ((sums * sums).sum(axis=1) - squares)


def _select(rows: Rows, chosen: np.ndarray) -> Rows:
    sizes = np.diff(rows.offsets)[chosen]
    ends = np.cumsum(sizes)
    at = np.repeat(rows.offsets[:-1][chosen] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return Rows(rows.index[at], rows.value[at], np.concatenate([[0], ends]))


def train(
    rows: Rows, dense: np.ndarray, labels: np.ndarray, *, size: int, rank: int = 8, epochs: int = 12, rate: float = 0.08,
    penalty: float = 2e-4, batch: int = 128,
) -> Model:
    """Fit by AdaGrad on four fifths of the rows and calibrate on the last fifth; the best epoch there is kept."""
    centre, spread = dense.mean(axis=0), np.maximum(dense.std(axis=0), 1e-6)
    n, width = len(labels), size + dense.shape[1]
    random = np.random.default_rng(SEED)
    rate_up = np.clip(labels.mean(), 0.01, 0.99)
    model = Model(
        float(np.log(rate_up / (1 - rate_up))), np.zeros(width), random.normal(0, 0.05, (width, rank)), centre, spread, 1.0, 0.0
    )
    full = joined(rows, dense, model, size)
    order = random.permutation(n)
    fit, check = order[n // 5 :], order[: n // 5]
    check_rows = _select(full, check)
    bias, linear, factors = model.bias, model.linear, model.factors
    bias_sum, linear_sum, factor_sum = 1e-8, np.full(width, 1e-8), np.full((width, rank), 1e-8)
    best = (np.inf, model)
    for _ in range(epochs):
        random.shuffle(fit)
        for i in range(0, len(fit), batch):
            chosen = fit[i : i + batch]
            part = _select(full, chosen)
            now = Model(bias, linear, factors, centre, spread, 1.0, 0.0)
            error = (sigmoid(raw_scores(now, part)) - labels[chosen]) / len(chosen)
            entry = np.repeat(error, np.diff(part.offsets)) * part.value
            own = np.repeat(np.arange(len(chosen)), np.diff(part.offsets))
            weighted = factors[part.index] * part.value[:, None]
            sums = np.add.reduceat(weighted, part.offsets[:-1], axis=0)
            used, place = np.unique(part.index, return_inverse=True)
            by_feature = np.argsort(place, kind="stable")
            first = np.searchsorted(place[by_feature], np.arange(len(used)))
            g_linear = np.add.reduceat(entry[by_feature], first) + penalty * linear[used]
            g_factor = np.add.reduceat((entry[:, None] * (sums[own] - weighted))[by_feature], first, axis=0) + penalty * factors[used]
            bias_sum += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(bias_sum)
            linear_sum[used] += g_linear**2
            linear[used] -= rate * g_linear / np.sqrt(linear_sum[used])
            factor_sum[used] += g_factor**2
            factors[used] -= 0.5 * rate * g_factor / np.sqrt(factor_sum[used])
        now = Model(bias, linear.copy(), factors.copy(), centre, spread, 1.0, 0.0)
        raw = raw_scores(now, check_rows)
        p = np.clip(sigmoid(raw), 1e-6, 1 - 1e-6)
        loss = -np.mean(labels[check] * np.log(p) + (1 - labels[check]) * np.log(1 - p)) if len(check) else 0.0
        if loss < best[0]:
            slope, offset = platt(raw, labels[check])
            best = (loss, now._replace(slope=slope, offset=offset))
    model = best[1]
    return model._replace(linear=model.linear.astype(np.float32), factors=model.factors.astype(np.float32))


def features(texts: DataFrame, *, size: int) -> DataFrame:
    """``(id, label, index, value, dense)`` of ``(id, text, *metadata, label)``: what training needs of each text."""

    def run(batches):
        for whole in batches:
            for part in batches_of(whole, "text", STEP_BYTES):
                words = split_words(part.column(1))
                rows = word_rows(words, size)
                dense = dense_features(part.drop_columns(["label"]), words)
                lists = pa.array(rows.offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(part.schema.get_field_index("label")),
                        pa.ListArray.from_arrays(lists, pa.array(rows.index.astype(np.int32))),
                        pa.ListArray.from_arrays(lists, pa.array(rows.value.astype(np.float32))),
                        pa.FixedSizeListArray.from_arrays(pa.array(dense.ravel()), dense.shape[1]).cast(pa.list_(pa.float64())),
                    ],
                    names=["id", "label", "index", "value", "dense"],
                )

    kind = texts.schema["id"].dataType.simpleString()
    return map_arrow(texts, run, f"id {kind}, label int, index array<int>, value array<float>, dense array<double>")


def fit(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    metadata: tuple[str, ...] = (), folds: int = 5, held_out: int = 0, size: int = 1 << 16, train_rows: int = 6_000,
    train_entries: int = 6_000_000,
) -> Model | None:
    """Train on at most ``train_rows`` labelled documents outside the held-out fold, with at most ``train_entries``
    distinct words together; both bound what reaches the driver. Documents are taken in the order of a hash of their
    id; one that would pass the bound is left out and those after it are still taken. They are learned in that order,
    so the model depends on the rows and not on how they are partitioned. Of an id with several texts the one with the
    least hash counts. None where no row is labelled."""
    sample = labelled_sample(
        docs, labels, label, id_col=id_col, text_col=text_col, folds=folds, held_out=held_out, rows=train_rows, extra=metadata
    )
    # Numbers in a column of any name; the label is the last column.
    shaped = sample.select("id", "text", *(F.col(f"x{i}").cast("double").alias(f"m{i}") for i in range(len(metadata))), "label")
    made = materialise(features(shaped, size=size), "quality-features")
    taken = fitting(made.select("id", F.size("index").alias("n")), train_entries)
    chosen = made.sparkSession.createDataFrame([(i,) for i in taken], made.select("id").schema)
    rows = made.join(F.broadcast(chosen), "id").toLocalIterator()
    parts = {r["id"]: (r["label"], np.array(r["index"]), np.array(r["value"]), np.array(r["dense"])) for r in rows}
    release(made)
    parts = [parts[i] for i in taken]
    if not parts:
        return None
    rows = Rows(
        np.concatenate([p[1] for p in parts]).astype(np.int64),
        np.concatenate([p[2] for p in parts]).astype(float),
        np.concatenate([[0], np.cumsum([len(p[1]) for p in parts])]).astype(np.int64),
    )
    return train(rows, np.vstack([p[3] for p in parts]), np.array([p[0] for p in parts], float), size=size)


def score(
    docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = (),
    keep: tuple[str, ...] = (), size: int = 1 << 16,
) -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of every whole text. Null and empty texts are scored by their (zero)
    statistics; without a model the score is 0.5. Kept columns may have any names, one named ``score`` is replaced; no
    rows give no rows.
    """
    keep = tuple(c for c in keep if c != "score")
    kept = docs.select(
        F.struct(F.lit(1).alias("one"), F.struct(F.lit(1).alias("one"), *(F.col(f"`{c}`") for c in keep)).alias("row")).alias("kept"),
        F.col(f"`{text_col}`").alias("text"),
        *(F.col(f"`{c}`").cast("double").alias(f"m{i}") for i, c in enumerate(metadata)),
    )

    def run(batches):
        for whole in batches:
            for part in batches_of(whole, "text", STEP_BYTES):
                if model is None:
                    result = np.full(part.num_rows, 0.5)
                else:
                    words = split_words(part.column(1))
                    rows = joined(word_rows(words, size), dense_features(part, words), model, size)
                    result = sigmoid(model.slope * raw_scores(model, rows) + model.offset)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(result)], names=["kept", "score"])

    shape = StructType([kept.schema["kept"], StructField("score", DoubleType())])
    return map_arrow(kept, run, shape).select(*(F.col("kept.row").getField(c).alias(c) for c in keep), "score")


def accept(
    docs: DataFrame, model: Model | None, least: float, *, text_col: str = "text", metadata: tuple[str, ...] = (), size: int = 1 << 16
) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, whose score is ``least`` or more."""
    whole = docs.select(F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`").alias(f"figure{i}") for i, c in enumerate(metadata)), whole_row(docs).alias("row"))
    scored = score(whole, model, metadata=tuple(f"figure{i}" for i in range(len(metadata))), keep=("row",), size=size)
    return scored.filter(F.col("score") >= least).select("row.*")
