"""Cross-polytope near-duplicates, the Merkle manifest and phrase mining against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldstay.llm import collocations, cross_polytope, merkle, queries

VECTORS = "vec_id long, embedding array<float>, label int, class string, keys string, `a.b` string, n string"


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return [find(i) for i in range(n)]


def vector_truth(rows):
    """(id, links, component, kept) of each row by all pairs."""
    unit = []
    for i, v, label in rows:
        good = label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or [])
        x = np.array(v, dtype=np.float32).astype(np.float64) if good else None
        unit.append(None if x is None else x / np.linalg.norm(x))
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98
    ]
    degree = Counter(i for pair in links for i in pair)
    root = components(len(rows), links)
    least = {}
    for (i, _, _), r in zip(rows, root):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, degree[n], least.get(root[n]), i == least.get(root[n])) for n, (i, _, _) in enumerate(rows)), key=repr)


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "x", "x", "x") for i, v, label in rows], VECTORS).repartition(3)


def got_vectors(spark, rows, **options):
    found = cross_polytope.near_vectors(vector_frame(spark, rows), **options)
    assert found.columns == ["id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_vectors_against_all_pairs(spark):
    random_ = np.random.default_rng(3)
    rows, number = [], 0

    def add(v, label):
        nonlocal number
        rows.append((number, [float(x) for x in v], label))
        number += 1

    for label in (0, 1):
        for _ in range(60):
            add(random_.normal(size=24), label)
        for _ in range(6):
            base = random_.normal(size=24)
            for noise in (0.0, 0.0, 0.03, 0.04, 0.05, 0.1):
                add(base + noise * random_.normal(size=24), label)
        chain = random_.normal(size=24)
        for _ in range(12):
            add(chain, label)
            chain = chain + 0.16 * random_.normal(size=24)
    add(np.array(rows[0][1]) * 3, 0)
    add(-np.array(rows[0][1]), 0)
    assert got_vectors(spark, rows) == vector_truth(rows)


def test_a_group_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 8)
    random_ = np.random.default_rng(4)
    base = random_.normal(size=16)
    rows = [(i, [float(x) for x in base + 0.05 * random_.normal(size=16)], 5) for i in range(90)]
    assert got_vectors(spark, rows) == vector_truth(rows)


def test_vectors_of_all_kinds(spark):
    one = [1.0, 2.0, -3.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 2.0], 1),
        (8, [float("nan"), 1.0, 1.0], 1), (9, [float("inf"), 1.0, 1.0], 1), (None, one, 1), (None, [5.0, -1.0, 0.0], 2), (10, [2.0, 4.0, -6.0], 1),
        (11, one, 2), (12, [1.0], 3), (13, [2.0], 3), (14, [-2.0], 3), (15, [1.0, 0.0], 3), (None, None, None), (16, [1e-30, 2e-30, -3e-30], 1),
        (17, [1.0, 2.0, -3.0001], 1),
    ]
    assert got_vectors(spark, rows) == vector_truth(rows)
    assert cross_polytope.near_vectors(vector_frame(spark, rows).filter("false")).collect() == []


def test_threshold_has_bounds(spark):
    with pytest.raises(ValueError):
        cross_polytope.near_vectors(vector_frame(spark, [(1, [1.0], 1)]), threshold=0.1)


def test_probes_find_the_hardest_pairs():
    random_ = np.random.default_rng(5)
    x = random_.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = random_.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * z
    for hashes in (2, 3, 4):
        a, b = (cross_polytope.probes_of(v, 4, hashes, 4 * hashes) for v in (x, y))
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).all()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_truth(rows, tamper=lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0):
    """Rows are (doc_id, source, lang, n_chars, text)."""

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(row):
        return sha(*map(field, row))

    def order(v):
        return (v is not None, v if v is not None else 0)

    def climb(level):
        """All levels up to one node."""
        out = [level]
        while len(out[-1]) > 1:
            out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, members = {}, {}
    for g in langs:
        members[g] = sorted(groups[g], key=lambda r: (order(r[0]), leaf(r)))
        trees[g] = climb([leaf(r) for r in members[g]])
    crown = climb([trees[g][-1][0] for g in langs])
    root, out = crown[-1][0], []
    for n, g in enumerate(langs):
        for i, row in enumerate(members[g]):
            path = []
            for levels, at in ((trees[g], i), (crown, n)):
                for level in levels[:-1]:
                    left, right = (level[at - 1], "") if at % 2 else ("", level[at + 1] if at + 1 < len(level) else "")
                    path.append((left, right))
                    at //= 2
            stated = leaf((*row[:3], None if row[3] is None else row[3] + 1, row[4])) if tamper(row[0]) else leaf(row)
            folded = stated
            for left, right in path:
                folded = sha(left, folded, right)
            out.append((row[0], leaf(row), trees[g][-1][0], root, sha(*(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def got_manifest(docs):
    changed = [merkle.field(F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.hexed(merkle.sha(*changed)))
    found = merkle.manifest(docs, fields=FIELDS, claimed=tampered).drop("claimed")
    assert found.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("span", [2, 10])
def test_manifest_against_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(merkle, "SPAN", span)
    langs = ["en"] * 40 + ["de"] * 16 + ["é"] * 17 + ["fr"] * 8 + [None] * 5 + ["x"] * 2 + ["z"]
    rows = [(i * 3 - 20, None if i % 4 == 0 else "s", lang, None if i % 5 == 0 else i, "ünï" * (i % 7) if i % 6 else None) for i, lang in enumerate(langs)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert got_manifest(docs) == manifest_truth(rows)


def test_manifest_of_odd_rows(edge_docs, edge_rows, no_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert len(rows) == len(edge_rows)
    assert got_manifest(edge_docs) == manifest_truth(rows)
    assert merkle.manifest(no_docs).collect() == []


def test_manifest_of_one_row_and_many_equal_rows(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(7, "s", "en", 3, "abc")]
    assert got_manifest(spark.createDataFrame(one, schema)) == manifest_truth(one)
    many = [(None, None, None, None, None)] * 700 + one
    docs = spark.createDataFrame(many, schema).repartition(5)
    assert got_manifest(docs) == manifest_truth(many)


def test_manifest_names_each_changed_row(spark):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    true = {r.id: r for r in merkle.manifest(docs).collect()}
    assert all(r.verified and r.claimed == r.leaf for r in true.values())
    other = F.when(F.col("doc_id") == 31, F.sha2(F.lit("other").cast("binary"), 256))
    assert [r.id for r in merkle.manifest(docs, claimed=other).collect() if not r.verified] == [31]


def phrases_truth(rows, least, top):
    """(text, lang) rows by counting every phrase."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {}
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                cuts = [(math.floor(Fraction(1_000_000 * a * a, f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found[p] = (score, a, f[p[:k]], f[p[k:]])
        hidden = {q for p in found if len(p) == 3 for q in (p[:2], p[1:]) if 100 * f[p] >= 50 * f[q]}
        rest = sorted(((-s, -a, " ".join(p).encode(), l_, r) for p, (s, a, l_, r) in found.items() if p not in hidden))
        out += [(lang, n, p.decode(), -a, l_, r, totals[lang], -s) for n, (s, a, p, l_, r) in enumerate(rest[:top], 1)]
    return sorted(out)


def texts(seed, n):
    pick = random.Random(seed)
    words = ["the"] * 14 + ["of"] * 6 + [f"w{i}" for i in range(25)] + ["É", "Zu", "zu"]
    breaks = [" "] * 12 + [". ", ",", "\n", "\t", "; ", "!?"]
    return ["".join(pick.choice(words) + pick.choice(breaks) for _ in range(pick.randrange(60))) for _ in range(n)]


PHRASES = "text string, lang string, w1 string, f string, words string, `a.b` string"


def got_phrases(docs, **options):
    found = collocations.collocations(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("budget", [40, 1000, collocations.BUDGET])
def test_phrases_against_counting(spark, budget):
    rows = [(t, ("en", "de", None)[i % 3]) for i, t in enumerate(texts(8, 240))]
    rows += [(None, "en"), ("", "xx"), (" \t", None), ("und a b", "und"), ("stop and go. " * 40, "en"), ("stop and go. " * 40, "en")]
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PHRASES).repartition(5)
    assert got_phrases(docs, least=4, top=30, budget=budget) == phrases_truth(rows, 4, 30)


def test_phrases_of_odd_rows(edge_docs, no_docs, spark):
    rows = [tuple(r) for r in edge_docs.select("text", "lang").collect()]
    assert got_phrases(edge_docs, least=2) == phrases_truth(rows, 2, 2000)
    assert got_phrases(no_docs) == [] and got_phrases(spark.createDataFrame([(" . ", "en", "", "", "", "")], PHRASES)) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_007, 3_000_000_000_011, 9_007_199_254_740
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations._score(F.col("a"), F.col("l"), F.col("r")))
    assert row.first()[0] == 1_000_000 * a * a // (left * right)


def test_registered_queries_match_their_columns(spark):
    want = {
        "op11_cross_polytope": "vec_id n_links component_id kept",
        "op12_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
        "op13_collocations": "lang rank phrase a l r n score",
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").columns == columns.split()
