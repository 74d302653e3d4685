"""The factorisation machine and the convolutional classifier: accuracy on rows held out, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstay.llm import factor_machine, toxicity
from fieldstay.llm.training import labelled_sample, platt, remainder
from fieldstay.llm.words import split_words

DATA = "/root/testdata/sf0.01"


def held_out(spark, scores, label, folds, fold):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select(F.col("doc_id").alias("id"), F.col(label).alias("label"))
    rows = scores.join(labels, "id").filter(remainder("id", folds) == fold).select("score", "label").collect()
    return np.array([r.score for r in rows]), np.array([r.label for r in rows])


def auc(scores, labels):
    up, down = scores[labels == 1], scores[labels == 0]
    return np.mean([(u > down).mean() + 0.5 * (u == down).mean() for u in up])


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model = factor_machine.fit(docs, labels, metadata=("n_chars",))
    scored = factor_machine.score(docs, model, metadata=("n_chars",), keep=("doc_id",)).withColumnRenamed("doc_id", "id")
    scores, truth = held_out(spark, scored, "quality", 5, 0)
    assert auc(scores, truth) > 0.95
    assert ((scores >= 0.3) == (truth == 1)).mean() > 0.9


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    scores, truth = held_out(spark, scored, "toxic", 4, 2)
    # A few dozen labelled toxic rows in four languages; larger tables give more than 0.95.
    assert auc(scores, truth) > 0.75


def test_sum_of_squares_equals_all_pairs():
    random = np.random.default_rng(2)
    model = factor_machine.Model(0.3, random.normal(size=9), random.normal(size=(9, 4)), np.zeros(0), np.ones(0), 1.0, 0.0)
    index, value = np.array([0, 3, 8, 2, 3]), random.normal(size=5)
    rows = factor_machine.Rows(index, value, np.array([0, 3, 5]))
    for i, raw in enumerate(factor_machine.raw_scores(model, rows)):
        part = range(*rows.offsets[i : i + 2])
        pairs = sum(model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b] for a in part for b in part if a < b)
        assert raw == pytest.approx(model.bias + sum(model.linear[index[a]] * value[a] for a in part) + pairs)


@pytest.mark.parametrize("texts", [["a b c d", None, "", "a"], ["bad, Bad. (bad)"]])
def test_convolution_stays_inside_a_text(texts):
    import pyarrow as pa

    random = np.random.default_rng(4)
    size, dimension, filters = 64, 5, 3
    table = random.normal(size=(size + 1, dimension))
    table[size] = 0
    kernels = tuple(random.normal(size=(w, dimension, filters)) for w in toxicity.WIDTHS)
    model = toxicity.Model(table, kernels, tuple(np.zeros(filters) for _ in kernels), np.ones(3 * filters), 0.0, 1.0, 0.0, {"": 0.5})
    tokens, starts = toxicity.padded(split_words(pa.array(texts, pa.string())), size)
    got = toxicity.pooled(model, tokens, starts)
    for i in range(len(texts)):
        own = toxicity.embedded(table, tokens[starts[i] : starts[i + 1]])
        want = [max(sum(own[t + k] @ kernel[k][:, f] for k in range(len(kernel))) for t in range(len(own) - len(kernel) + 1)) for kernel in kernels for f in range(filters)]
        assert got[i] == pytest.approx(np.array(want), rel=1e-4, abs=1e-5)


def test_odd_rows_are_scored(edge_docs, edge_labels, no_docs, no_labels, edge_rows):
    for labels in (edge_labels, no_labels):
        model = factor_machine.fit(edge_docs, labels, metadata=("n_chars",))
        rows = factor_machine.score(edge_docs, model, metadata=("n_chars",), keep=("doc_id", "text", "n_words")).collect()
        assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 and r.n_words == "its n_words" for r in rows)
        net = toxicity.fit(edge_docs, labels)
        found = toxicity.score(edge_docs, net).collect()
        assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 and r.flagged is not None for r in found)
        assert factor_machine.score(no_docs, model, metadata=("n_chars",), keep=("doc_id",)).count() == 0
        assert toxicity.score(no_docs, net).count() == 0


def test_sample_is_bounded_and_leaves_out_the_fold(edge_docs, edge_labels):
    rows = labelled_sample(edge_docs, edge_labels, "quality", id_col="doc_id", text_col="text", folds=5, held_out=0, rows=4).collect()
    assert len(rows) == 4 and len({r.id for r in rows}) == 4
    import zlib

    assert all(zlib.crc32(str(r.id).encode()) % 5 for r in rows)
    everything = labelled_sample(edge_docs, edge_labels, "quality", id_col="doc_id", text_col="text", folds=5, held_out=0, rows=100).collect()
    assert {r.id: r.label for r in everything}.get(3, 1) == 1


def test_texts_beyond_the_bound_leave_the_others_in_training(rows, monkeypatch):
    """Texts longer than the bound, and of two that only fit alone the second, are left out; all short ones stay."""
    given = {}
    monkeypatch.setattr(toxicity, "train", lambda tokens, starts, labels, langs, size: given.update(sizes=np.diff(starts), labels=labels))
    pad = max(toxicity.WIDTHS)
    short = [(i, "good words " * 5, "en") for i in range(40)]
    docs = rows("doc_id long, text string, lang string", *short, *((i, "bad " * 3_000, "en") for i in (100, 101, 102)), *((i, "bad " * 1_000, "en") for i in (200, 201)))
    labels = rows("doc_id long, toxic int", *((i, i % 2) for i in range(40)), *((i, 1) for i in (100, 101, 102, 200, 201)))
    toxicity.fit(docs, labels, folds=2, held_out=2, train_words=40 * (10 + pad) + 1_000 + pad)
    assert sorted(given["sizes"]) == [10 + pad] * 40 + [1_000 + pad]
    assert given["labels"].sum() == 21
    assert toxicity.fit(docs, labels, folds=2, held_out=2, train_words=9) is None


def test_platt_and_thresholds():
    scores = np.array([-2.0, -1.0, -0.5, 0.5, 1.0, 2.0] * 10)
    labels = np.array([0, 0, 1, 0, 1, 1] * 10, float)
    slope, offset = platt(scores, labels)
    assert slope > 0 and abs(offset) < 0.5
    limits = toxicity.language_thresholds(np.array([0.1, 0.2, 0.8, 0.9] * 5), np.array([0, 0, 1, 1] * 5), np.array(["a"] * 20, object))
    assert 0.2 <= limits["a"] <= 0.8 and toxicity.language_thresholds(np.zeros(3), np.zeros(3), np.array([None] * 3)) == {"": 0.5}
