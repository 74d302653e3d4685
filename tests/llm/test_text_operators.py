"""Quality rules, decontamination, SimHash and substring operators against brute force, on small and odd rows."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldstay.llm import components, decontamination, quality_rules, simhash, substrings
from fieldstay.llm.storage import with_row_key

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(grams)
    covered = {p for i, g in enumerate(grams) if times[g] > 1 for p in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_statistics(edge_docs, edge_rows, edge_labels):
    judged, _ = quality_rules.judge(edge_docs, edge_labels)
    rows = judged.collect()
    got = Counter((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = Counter()
    for i, text in edge_rows:
        s = base_statistics(text)
        want[(i, *s, s[0] < 20 or 100 * s[4] > 30 * s[0])] += 1
    assert got == want
    assert not any(r.kept and (r.base_failed or r.rule) for r in rows)


def test_rules_learn_conjunctions(spark):
    random = np.random.default_rng(5)
    a, b = random.random(4000), random.random(4000)
    bad = ((a > 0.7) & (b <= 0.4)).astype(int)
    rows = spark.createDataFrame([(float(x), float(y), int(z), i % 3 == 0) for i, (x, y, z) in enumerate(zip(a, b, bad))], "a double, b double, bad int, prune boolean")
    rules = quality_rules.learn(rows, ["a", "b"])
    judged = rows.withColumn("rule", quality_rules.verdict(rules)).select("bad", F.col("rule").isNotNull().alias("hit")).collect()
    right = sum(bool(r.bad) == r.hit for r in judged)
    assert right > 0.97 * len(judged)
    assert {t.figure for t in rules[0].tests} == {"a", "b"}


def plain_rules(rows, names, parts, least, precision):
    """The rules by the same steps over lists: rows are (figures, bad, prune)."""

    def gain(bad, good, before):
        return bad * (np.log2((bad + 1) / (bad + good + 2)) - before)

    def meets(row, tests):
        return all((row[0][f] > t) == above for f, above, t in tests)

    left, rules = list(rows), []
    while True:
        grow = [r for r in left if not r[2]]
        prune = [r for r in left if r[2]]
        cuts = {f: quality_rules.cuts_of([r[0][f] for r in grow], parts) for f in range(len(names))}
        aside, rule = set(), None
        while rule is None:
            tests = []
            while True:
                rest = [r for r in grow if meets(r, tests)]
                bad, good, best = sum(r[1] for r in rest), sum(1 - r[1] for r in rest), None
                before = np.log2((bad + 1) / (bad + good + 2))
                for f in range(len(names)):
                    for cut in cuts[f]:
                        for above in (False, True):
                            kept = [r[1] for r in rest if (r[0][f] > cut) == above]
                            if sum(kept) < least or (not tests and (f, above) in aside):
                                continue
                            g = gain(sum(kept), len(kept) - sum(kept), before)
                            if g >= 1 and (best is None or g > best[0] + 1e-9):
                                best = (g, (f, above, cut), len(kept) - sum(kept))
                if not bad or best is None:
                    break
                tests.append(best[1])
                if best[2] == 0:
                    break
            if not tests:
                return rules
            worth = []
            for n in range(1, len(tests) + 1):
                hit = [r[1] for r in prune if meets(r, tests[:n])]
                worth.append((round((sum(hit) + 1) / (len(hit) + 2), 4), -n, sum(hit), len(hit) - sum(hit)))
            _, n, hits, errors = max(worth)
            aside |= {t[:2] for t in tests}
            if hits >= least and hits >= precision * (hits + errors):
                rule = tests[:-n]
        rules.append([(names[f], above, cut) for f, above, cut in rule])
        left = [r for r in left if not meets(r, rule)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_are_those_of_a_plain_learner(spark, seed):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(900):
        a, b, c = (round(float(x), 2) for x in random.random(3))
        # Two frequent kinds, a rare one, and labels that are wrong now and then.
        bad = (a > 0.7 and b <= 0.4) or c > 0.93 or (a < 0.03 and c < 0.8)
        rows.append(((a, b, c), int(bad) if random.random() > 0.03 else int(not bad), i % 3 == 0))
    frame = spark.createDataFrame([(*f, b, p) for f, b, p in rows], "a double, b double, c double, bad int, prune boolean").repartition(4)
    got = [[tuple(t) for t in rule.tests] for rule in quality_rules.learn(frame, ["a", "b", "c"], parts=16, least_hits=4, precision=0.8)]
    want = plain_rules(rows, ["a", "b", "c"], 16, 4, 0.8)
    assert got == want and len(got) >= 2


def test_a_rare_kind_behind_a_useless_one_is_found(spark):
    """The best beginning fails on the pruning rows; the search goes on and finds the others."""
    rows = [(i % 97, 0, 0, i % 3 == 0) for i in range(3000)]
    rows += [(500 + i, 0, 1, False) for i in range(60)]
    rows += [(i % 97, 9, 1, i % 3 == 0) for i in range(24)]
    frame = spark.createDataFrame([(float(a), float(b), c, p) for a, b, c, p in rows], "a double, b double, bad int, prune boolean")
    rules = quality_rules.learn(frame, ["a", "b"])
    assert [[(t.figure, t.above) for t in r.tests] for r in rules] == [[("b", True)]]


def test_rules_without_labels(edge_docs, no_docs, no_labels, edge_labels):
    judged, rules = quality_rules.judge(edge_docs, no_labels)
    assert rules == [] and all(r.kept != r.base_failed for r in judged.collect())
    assert quality_rules.judge(no_docs, edge_labels)[0].count() == 0


NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(text):
    return NORMAL.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(docs, items, width=13):
    grams = defaultdict(set)
    for item, text in items:
        words = normal(text)
        size = min(width, len(words))
        if item is not None and size:
            for i in range(len(words) - size + 1):
                grams[tuple(words[i : i + size])].add(str(item))
    sizes = {len(g) for g in grams}
    out = Counter()
    for i, text in docs:
        words, hit, found = normal(text), set(), set()
        for size in sizes:
            for p in range(len(words) - size + 1):
                g = tuple(words[p : p + size])
                if g in grams:
                    hit.update(range(p, p + size))
                    found |= grams[g]
        out[(i, len(words), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(words))] += 1
    return out


ITEMS = [(1, "w01 W02, w03!"), (2, None), (3, ""), (10, "école É"), (None, "one"), (7, "same id first"), (7, "same id first")]


@pytest.mark.parametrize("most", [1 << 26, 1 << 10, 64])
def test_decontamination(spark, edge_docs, edge_rows, most, monkeypatch):
    # A filter too small for the benchmark lets more through to the join; the result is the same.
    monkeypatch.setattr(decontamination, "MOST_BITS", most)
    long = next(t for i, t in edge_rows if i == 9)
    items = [*ITEMS, (20, " ".join(long.split()[100:140])), (21, " ".join(long.split()[110:130]).upper())]
    found = decontamination.contamination(edge_docs, spark.createDataFrame(items, "item_id long, text string"))
    got = Counter((r.id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())
    assert got == contaminated(edge_rows, items)


def test_decontamination_of_nothing(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(edge_docs, none).filter("n_hit > 0 or contaminated").count() == 0
    assert decontamination.contamination(no_docs, spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_clean_documents_and_spans(spark):
    docs = spark.createDataFrame([(1, "Lead. The QUICK brown-fox! Rest of it", "a"), (2, "untouched  text", "b"), (3, None, "c")], "doc_id long, text string, row_key string")
    items = spark.createDataFrame([(5, "the quick brown fox")], "item_id long, text string")
    assert {r.doc_id for r in decontamination.clean_documents(docs, items).collect()} == {2, 3}
    cut = {r.doc_id: r.text for r in decontamination.clean_spans(docs, items).collect()}
    assert cut == {1: "Lead.   -! Rest of it", 2: "untouched  text", 3: None}


@pytest.mark.parametrize("id_type", ["string", "long"])
def test_cleaning_of_rows_whose_keys_are_sampled(spark, id_type):
    """More rows than the range bounds are drawn from, so that each numbering of the rows is another one."""
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    passage = " ".join(f"q{i}" for i in range(13))
    bad = {i for i in range(3_000) if i % 3 == 0}
    rows = [(i, f"lead {passage} end{i}" if i in bad else " ".join(f"n{i}x{k}" for k in range(15))) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("more", F.col("doc_id"))
    # Ids of text, or whole numbers of which one is null.
    own = F.col("doc_id").cast("string") if id_type == "string" else F.when(F.col("doc_id") != 1, F.col("doc_id"))
    docs = docs.withColumn("doc_id", own).repartition(6)
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    spark.conf.set(name, "1")
    try:
        left = decontamination.clean_documents(docs, items).collect()
        cut = {r.more: r.text for r in decontamination.clean_spans(docs, items).collect()}
    finally:
        spark.conf.set(name, before)
    assert sorted(r.more for r in left) == [i for i in range(3_000) if i not in bad]
    assert len(cut) == 3_000 and {i for i, text in cut.items() if passage in text} == set()
    assert all(cut[i] == text for i, text in rows if i not in bad)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(edge_docs, edge_rows, no_docs):
    prints = [fingerprint(t) for _, t in edge_rows]
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            parent[root(a)] = root(b)
    least = {}
    for n, (i, _) in enumerate(edge_rows):
        if i is not None:
            least[root(n)] = min(i, least.get(root(n), i))
    want = Counter((i, prints[n], least.get(root(n))) for n, (i, _) in enumerate(edge_rows))
    got = Counter((r.id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(edge_docs).collect())
    assert got == want
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("distance", [0, 2, 4])
def test_links_connect_all_that_are_close(spark, distance):
    random = np.random.default_rng(3)
    seeds = random.integers(0, 2**63, 12)
    prints = set(map(int, seeds))
    for s in seeds:
        for _ in range(6):
            x = int(s)
            for bit in random.integers(0, 64, 3):
                x ^= 1 << int(bit)
                prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance)
    labels = {r.a: r.b for r in components.stars(found).collect()}
    parent = {x: x for x in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert {x: labels.get(x, x) for x in signed} == {x: root(x) for x in signed}


def test_components_of_a_long_chain(spark):
    chain = [(i + 1, i) for i in range(300)] + [(1001, 1000)]
    found = {r.a: r.b for r in components.stars(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, 1001: 1000}
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def removed(docs, k):
    """Brute force; documents in the order of the keys ``(key, id, text)``."""
    first, out = set(), {}
    for key, i, text in sorted(docs):
        words = (text or "").encode().split()
        gone = set()
        for p in range(len(words) - k + 1):
            gram = tuple(words[p : p + k])
            if gram in first:
                gone.update(range(p, p + k))
            first.add(gram)
        kept = b" ".join(w for p, w in enumerate(words) if p not in gone).decode()
        out[key] = (i, len(words), len(gone), kept)
    return out


@pytest.mark.parametrize("k", [20, 5])
def test_substrings(edge_docs, no_docs, k):
    keyed = with_row_key(edge_docs, "doc_id", "text").collect()
    order = {r.row_key: (r.id is not None, r.id if r.id is not None else 0) for r in keyed}
    assert [order[x] for x in sorted(order)] == sorted(order.values())
    by_key = removed({(r.row_key, r.id, r.text) for r in keyed}, k) if all(r.text is not None or True for r in keyed) else {}
    want = Counter(by_key[r.row_key] for r in keyed)
    rows = substrings.remove_repeats(edge_docs, k=k).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_text) for r in rows) == want
    assert substrings.remove_repeats(no_docs, k=k).count() == 0


def test_substring_spans_name_their_source(rows):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = rows("doc_id long, text string", (1, f"a b c {passage} d"), (2, f"x {passage} y {passage}"), (3, "short"))
    found = {r.id: r for r in substrings.remove_repeats(docs).collect()}
    assert found[1].n_removed == 0 and found[2].n_removed == 120 and found[2].kept_text == "x y"
    assert {(s.start, s.n, s.source_key) for s in found[2].spans} == {(1, 41, 1), (62, 41, 2)} or {(s.start, s.n, s.source_key) for s in found[2].spans} == {(1, 41, 1), (62, 41, 1)}
    carried = substrings.remove_repeats(docs.withColumn("n_words", F.lit("mine")).withColumn("more", F.lit(1)), carry=True)
    assert set(carried.columns) == {"doc_id", "text", "more", "n_words", "n_removed", "kept_text", "spans"}
    assert {r.doc_id: r.n_words for r in carried.collect()} == {1: 64, 2: 122, 3: 1}


