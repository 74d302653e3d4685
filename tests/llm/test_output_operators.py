"""Packing, token files, sharding, preferences and the pipeline against brute force and round trips."""

import zlib
from collections import Counter, defaultdict
from math import isclose

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fieldstay.llm import cutting_stock, packing, preferences, queries, sharding, token_files, tokens
from fieldstay.llm.storage import materialise

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


ODD = ["İstanbul İx é K<|endoftext|>a <|ENDOFTEXT|>", "don't I'll can't.. 12.5% “quotes”.", "", " \n", None, "ΑΣ ΟΔΥΣΣΕΥΣ. ΑΣ", "x\x85y z ʼn ǆ Ⅷ ａｂ é ä."]


def test_encoder_equals_the_library():
    for texts in (ODD, ODD[1:], ODD[:0]):
        ids, offsets = tokens.Encoder(PATH, 1, True).encode(pa.array(texts, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(t).tolist() for t in texts]
    plain = tokens.Encoder(PATH, None, False)
    ids, offsets = plain.encode(pa.array(["a b", None, "c"]))
    assert np.diff(offsets).tolist() == [2, 0, 1]


def test_words_met_again_are_remembered(monkeypatch):
    coder, asked = tokens.Encoder(PATH, 1, True, 12), Counter()
    library = coder._library
    monkeypatch.setattr(coder, "_library", lambda words: asked.update(words) or library(words))
    for n in range(6):
        text = f"often again new{n}a new{n}b."
        ids, _ = coder.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text).tolist()
    assert asked["often"] == asked["again"] == 1 and len(coder.memory) + len(coder.earlier) <= 18


def test_token_files_round_trip(spark, edge_docs, edge_rows, no_docs, tmp_path):
    folder = str(tmp_path / "files")
    manifest = token_files.write_token_files(edge_docs, folder, PATH)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    assert [r.id for r in rows] == sorted((i for i, _ in edge_rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        start += r.n_tokens
    assert Counter((r.id, bytes(r.ids)) for r in rows) == Counter((i, ids_of(t).tobytes()) for i, t in edge_rows)
    one = manifest.orderBy("file_no").first()
    assert token_files.read_record(folder, one.file, one.records - 1)[1].tolist()[-1] == 1
    nothing = str(tmp_path / "none")
    assert token_files.read_token_files(token_files.write_token_files(no_docs, nothing, PATH), nothing).count() == 0


def test_damaged_records_are_found():
    record = token_files.pack_record(5, np.arange(4), 2)
    assert token_files.unpack_record(token_files.unframe(record)[0])[0] == 5
    for at in (0, 9, 20, len(record) - 1):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.unframe(bytes(broken))
    with pytest.raises(ValueError):
        token_files.unframe(record[:-3])


def test_column_generation_is_near_the_bound():
    random = np.random.default_rng(1)
    demand = np.zeros(64, np.int64)
    lengths = random.integers(1, 65, 4000)
    np.add.at(demand, lengths - 1, 1)
    patterns = cutting_stock.rounded(demand, cutting_stock.column_generation(demand))
    assert (sum(p * n for p, n in patterns) == demand).all()
    assert all((p * np.arange(1, 65)).sum() <= 64 for p, _ in patterns)
    assert sum(n for _, n in patterns) <= -(-lengths.sum() // 64) * 1.02
    assert cutting_stock.column_generation(np.zeros(8, np.int64)) == []
    assert cutting_stock.best_pattern(np.array([0.1, 0.5, 0.6]), 3)[0] == pytest.approx(0.6)


def check_packing(rows, docs):
    """Pieces against ``docs``, (id, text) pairs; returns the share of padding."""
    whole = Counter((i, ids_of(t).tobytes()) for i, t in docs)
    sequences, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        parts[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for (doc_id, n), pieces in parts.items():
        same = [np.frombuffer(b, "<u4") for (i, b), _ in whole.items() if i == doc_id and len(b) == 4 * n]
        times = sum(c for (i, b), c in whole.items() if i == doc_id and len(b) == 4 * n)
        assert sum(p[1] for p in pieces) == n * times
        assert all(any(zlib.crc32(x[s : s + k].tobytes()) == crc for x in same) for s, k, crc in pieces)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(sequences) == list(range(len(sequences)))
    filled = sum(r.length for r in rows)
    assert filled == sum(len(b) // 4 * n for (_, b), n in whole.items())
    return 1 - filled / max(1, 2048 * len(sequences))


def test_packing(edge_docs, edge_rows, no_docs):
    check_packing(queries.packed_documents(edge_docs).collect(), edge_rows)
    assert queries.packed_documents(no_docs).count() == 0


def test_sequences_hold_their_pieces(spark, edge_docs, edge_rows):
    pieces = materialise(tokens.token_pieces(edge_docs, PATH, longest=2048))
    packed = materialise(packing.pack(pieces))
    rows = packing.sequences(packed, pad_id=0).collect()
    assert Counter(x for r in rows for x in np.frombuffer(r.ids, "<u4")[: r.n_tokens].tolist()) == Counter(x for _, t in edge_rows for x in ids_of(t).tolist())
    assert all(len(r.ids) == 4 * r.length and (r.length == 2048 or r.length == r.n_tokens) for r in rows)


def test_sharding(spark, edge_docs, edge_rows, no_docs):
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("crc")
    rows = sharding.assign(edge_docs, shards=4, carry=(crc,)).collect()
    assert Counter((r.id, r.size, r.crc) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in edge_rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.assign(no_docs, shards=4).count() == 0


def test_shards_have_nearly_equal_bytes(spark, tmp_path):
    # A third of the rows are copies of one text.
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 20)).otherwise(F.repeat(F.col("id").cast("string"), (F.col("id") % 40).cast("int"))).alias("text"))
    rows = sharding.assign(docs, shards=8, tolerance=0.002)
    sizes = [r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()]
    mean = sum(sizes) / 8
    assert len(sizes) == 8 and all(isclose(s, mean, rel_tol=0.01) for s in sizes)
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=8, tolerance=0.002)
    again = spark.read.parquet(str(tmp_path / "shards"))
    assert again.join(rows.select(F.col("id").alias("doc_id"), F.col("shard").alias("own")), "doc_id").filter("shard = own").count() == 6000


def test_preferences(rows):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "good"), (1, 3, "user", None), (1, 4, "assistant", "end"), (2, 0, "user", "x"), (None, 0, "user", "lost"), (3, None, "user", "lost"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    other = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"), (4, 0, "user", "same")]
    schema = "pair_id long, turn long, role string, text string"
    out = preferences.format_preferences(rows(schema, *turns), rows(schema, *other), part_turns=4)
    got = {(r.pair_id, r.segment, r.part): r for r in out.collect()}
    assert set(got) == {(1, "prompt", 0), (1, "chosen", 0), (1, "chosen", 1), (1, "rejected", 0), (2, "chosen", 0), (4, "prompt", 0)}
    assert got[1, "prompt", 0].text == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n" and got[1, "prompt", 0].mask == []
    chosen = got[1, "chosen", 0]
    assert [chosen.text[m.start : m.start + m.length] for m in chosen.mask] == ["good<|end|>\n"]
    assert [got[1, "rejected", 0].text[m.start : m.start + m.length] for m in got[1, "rejected", 0].mask] == ["bad<|end|>\n"]
    assert got[4, "prompt", 0].n_turns == 1
    empty = rows(schema, *turns).filter("false")
    assert preferences.format_preferences(empty, empty).count() == 0


def test_pipeline_stages(spark, edge_docs, edge_labels, tmp_path, monkeypatch):
    items = spark.createDataFrame([(1, "w00 w01 w02")], "item_id long, text string")
    monkeypatch.setattr(queries, "table", lambda s, d, name: {"labels": edge_labels, "benchmark": items}[name])
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialise(stage(spark, docs, ""), "stage")
        assert after.columns == docs.columns and after.count() <= docs.count(), name
        docs = after
    texts = {(r.doc_id, r.text) for r in before}
    kept = docs.collect()
    assert {r.doc_id for r in kept} <= {i for i, _ in texts}
    pieces = corpus_pipeline.pack_sequences(spark, docs, "").collect()
    check_packing(pieces, [(r.doc_id, r.text) for r in kept])


def test_one_document_of_each_group_stays(spark, edge_docs):
    kept = corpus_pipeline.simhash_duplicates(spark, edge_docs.select("doc_id", "text"), "").collect()
    ids = [r.doc_id for r in kept]
    # Copies 1 and 2, the near copy 3, and the empty texts 4, 5, 6 and that without an id.
    assert 1 in ids and 2 not in ids and ids.count(15) == 1
    assert sum(not (r.text or "").split() for r in kept) == 1
