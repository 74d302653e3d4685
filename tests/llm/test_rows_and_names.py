"""Columns of any name, rows repeated often, and models that do not depend on how rows are partitioned."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldstay.llm import decontamination, factor_machine, packing, queries, sharding, substrings, token_files, toxicity
from fieldstay.llm.storage import materialise

WORDS = [f"w{i:02d}" for i in range(60)]


def sentence(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) for _ in range(n))


@pytest.mark.parametrize("unique", [True, False])
def test_stages_keep_columns_of_any_name(spark, edge_docs, edge_names, unique):
    docs = edge_docs
    if unique:
        docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    docs = materialise(docs)
    bench = spark.createDataFrame([(1, sentence(9, 25))], "item_id long, text string")
    for made in (
        decontamination.clean_documents(docs, bench),
        decontamination.clean_spans(docs, bench),
        substrings.clean_texts(docs, length_col="n_chars"),
        corpus_pipeline.simhash_duplicates(spark, docs, ""),
        factor_machine.accept(docs, None, 0.1, metadata=("n_chars",)),
    ):
        assert made.columns == docs.columns
        rows = made.collect()
        assert rows and all(r[n] == f"its {n}" for r in rows for n in edge_names)
    carried = substrings.remove_repeats(docs, carry=True)
    own = [c for c in docs.columns if c not in substrings.ADDED]
    assert carried.columns == [*own, *substrings.ADDED]
    scored = factor_machine.score(docs, None, keep=("a.b", "row", "kept"))
    assert scored.columns == ["a.b", "row", "kept", "score"] and {r["a.b"] for r in scored.collect()} == {"its a.b"}


def test_clean_texts_takes_repeats_out(spark):
    passage = sentence(40, 60)
    rows = [(1, f"one {passage} two"), (2, f"three {passage} four"), (3, "alone\n and  untouched"), (4, None)]
    docs = spark.createDataFrame([(i, t, len(t) if t else None) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in substrings.clean_texts(docs, length_col="n_chars").collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("three four", 10), 3: (rows[2][1], len(rows[2][1])), 4: (None, None)}


def repeated(spark):
    """4,000 equal rows without an id and 400 others."""
    equal = [(None, sentence(1, 30))] * 4000
    others = [(i, sentence(i, 30)) for i in range(400)]
    return spark.createDataFrame(equal + others, "doc_id long, text string").repartition(6)


def test_equal_rows_fill_shards_evenly(spark):
    placed = sharding.assign(repeated(spark), shards=16).collect()
    total = sum(r.size for r in placed)
    by_shard = Counter()
    for r in placed:
        by_shard[r.shard] += r.size
    assert len(placed) == 4400 and len(by_shard) == 16
    assert max(by_shard.values()) < 1.05 * total / 16 and min(by_shard.values()) > 0.95 * total / 16
    slots = Counter((r.shard, r.slot) for r in placed)
    assert max(slots.values()) == 1 and all(max(r.slot for r in placed if r.shard == s) + 1 == n for s, n in Counter(r.shard for r in placed).items())


def test_equal_pieces_pack_like_others(spark):
    pieces = repeated(spark).select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("length"))
    packed = packing.pack(materialise(pieces), capacity=2048).collect()
    assert len(packed) == 4400
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and sorted(ends) == list(range(len(ends)))


def test_equal_rows_are_written_by_several_tasks(spark, tmp_path):
    import public_tokenizers

    folder = f"file://{tmp_path}/files"
    manifest = token_files.write_token_files(repeated(spark), folder, public_tokenizers.path(queries.TOKENIZER))
    records = token_files.read_token_files(manifest, folder).collect()
    assert len(records) == 4400 and manifest.count() > 1 and max(r.records for r in manifest.collect()) < 3000
    spans = sorted((r.start, r.n_tokens) for r in records)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))


def labelled(spark):
    pick = random.Random(6)
    words = {0: [f"b{i}" for i in range(40)], 1: [f"g{i}" for i in range(40)]}
    rows = []
    for i in range(240):
        good = i % 2
        text = " ".join(pick.choice(words[good] if pick.random() < 0.7 else words[1 - good]) for _ in range(pick.randrange(5, 60)))
        rows += [(i, text, "en", "s", len(text))]
        if i % 12 == 0:
            rows.append((i, text + " another text of this id", "de", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(240)], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("which", ["quality", "toxicity"])
def test_scores_do_not_depend_on_partitions(spark, which):
    docs, labels = labelled(spark)
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        some = docs.repartition(parts)
        if which == "quality":
            model = factor_machine.fit(some, labels, metadata=("n_chars",), train_entries=4_000)
            scores = factor_machine.score(docs, model, metadata=("n_chars",), keep=("doc_id", "text"))
            found.append({(r.doc_id, r.text): r.score for r in scores.collect()})
        else:
            model = toxicity.fit(some, labels, train_words=9_000)
            found.append(Counter((r.id, r.score) for r in toxicity.score(docs, model).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_a_text_beyond_the_bound_is_left_out_alone(spark):
    from fieldstay.llm.training import fitting

    sizes = spark.createDataFrame([(i, 10 if i % 5 else 95) for i in range(20)], "id int, n int")
    taken = fitting(sizes, 100)
    assert len(taken) >= 1 and sum(10 if i % 5 else 95 for i in taken) <= 100
    assert fitting(sizes.filter("n = 10"), 100) and len(fitting(sizes.filter("n = 10"), 100)) == 10
    assert fitting(sizes, 5) == []


def test_decontamination_of_a_large_benchmark(spark):
    """Many more windows than bits in the smallest filter, few of them in the documents."""
    bench = spark.createDataFrame([(i, sentence(1000 + i, 80)) for i in range(300)], "item_id long, text string")
    hit = sentence(1007, 80).split()
    rows = [(1, sentence(1, 50) + " " + " ".join(hit[10:40])), (2, sentence(2, 80)), (3, " ".join(hit[:12]))]
    found = decontamination.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    got = {r.id: (r.n_hit, r["items"]) for r in found.collect()}
    assert got == {1: (30, ["7"]), 2: (0, []), 3: (0, [])}
