"""Remove repeated passages: k-mers of words as De Bruijn edges, compacted to paths that name their source.

An edge is a window of ``k`` words, joining the nodes of its first and last ``k - 1`` words. Only edges that occur
more than once matter. Which those can be is found first from minimizers: of the short grams inside a window the
one with the least hash. Equal windows have equal minimizers, so a window whose minimizer is met in one place only is
unique; neighbouring windows mostly share their minimizer, so about one row for seven words is exchanged here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from fieldstay.llm.storage import map_arrow, materialise, release, with_row_key
from fieldstay.llm.words import Words, batches_of, split_words, word_hashes

GRAM = 8
STEP_BYTES = 1 << 22


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, k: int, base: int) -> np.ndarray:
    """The polynomial hash of every k consecutive numbers, by doubling."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = lambda e: np.uint64(pow(base, e, 1 << 64))
    out, done = np.zeros(len(hashes), np.uint64), 0
    block, size = hashes, 1
    while True:
        if k >> (size.bit_length() - 1) & 1:
            # Append a block behind the ``done`` words already covered.
            m = len(hashes) - done - size + 1
            out = out[:m] * power(size) + block[done : done + m]
            done += size
        if done == k:
            return mixed(out[:n])
        block = block[: len(block) - size] * power(size) + block[size:]
        size *= 2


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first minimum of every ``width`` consecutive values is."""
    n = max(0, len(values) - width + 1)
    best, size = np.arange(len(values)), 1

    def lower(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] < values[left], right, left)

    while size * 2 <= width:
        best = lower(best[: len(best) - size], best[size:])
        size *= 2
    return lower(best[:n], best[width - size : width - size + n])


def inside(words: Words, k: int) -> np.ndarray:
    """For every position of the batch that starts ``k`` words: do they lie in one text?"""
    sizes = np.diff(words.offsets)
    n = max(0, len(words.codes) - k + 1)
    left = np.repeat(words.offsets[1:], sizes)[:n] - np.arange(n)
    return left >= k


def owners(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.offsets) - 1), np.diff(words.offsets))


def _minimizer_runs(rows: DataFrame, k: int) -> DataFrame:
    """``(value, row_key, start, n)``: ``n`` windows from word ``start`` on share the minimizer ``value``."""
    gram = min(GRAM, k)

    def run(batches):
        for whole in batches:
            for batch in batches_of(whole, "text", STEP_BYTES):
                words = split_words(batch.column(1))
                hashes = word_hashes(words.values, 1)[words.codes]
                grams = gram_hashes(hashes, gram, 0x9E3779B97F4A7C15)
                at = np.flatnonzero(inside(words, k))
                place, owner = least_of(grams, k - gram + 1)[at], owners(words)[at]
                value = grams[place]
                # Windows share a run by the minimizer's place: equal windows of one text are in runs of their own.
                first = np.ones(len(at), bool)
                first[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(first)
                length = np.diff(np.append(begin, len(at)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[begin].view(np.int64)),
                        batch.column(0).take(pa.array(owner[begin])),
                        pa.array((at[begin] - words.offsets[owner[begin]]).astype(np.int64)),
                        pa.array(length.astype(np.int64)),
                    ],
                    names=["value", "row_key", "start", "n"],
                )

    return map_arrow(rows.select("row_key", "text"), run, "value long, row_key long, start long, n long")


def _edges(rows: DataFrame, k: int) -> DataFrame:
    """``(k1, k2, row_key, pos, first_pos)`` of the windows in ``runs`` of each text: two independent 64-bit hashes of
    the window's words. A window met before in its own text has that place in ``first_pos``, others have null."""

    def run(batches):
        for whole in batches:
            for batch in batches_of(whole, "text", STEP_BYTES):
                words = split_words(batch.column(1))
                wide = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.values.cast(pa.binary()).to_pylist())), "<u8")
                k1 = gram_hashes(wide[0::2][words.codes], k, 0xD6E8FEB86659FD93)
                k2 = gram_hashes(wide[1::2][words.codes], k, 0xA0761D6478BD642F)
                lists = batch.column(2)
                runs = lists.flatten()
                counts = np.diff(lists.offsets.to_numpy())
                text_of = np.repeat(np.arange(batch.num_rows), counts)
                begin = runs.field("start").to_numpy() + words.offsets[text_of]
                size = runs.field("n").to_numpy()
                at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
                at = np.sort(at)
                owner = owners(words)[at]
                pos = at - words.offsets[owner]
                # The first of equal windows within a text, by a stable sort.
                h1, h2 = k1[at], k2[at]
                order = np.lexsort((h2, h1, owner))
                same = np.zeros(len(at), bool)
                a, b = order[1:], order[:-1]
                same[1:] = (owner[a] == owner[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
                heads = np.flatnonzero(~same)
                leader = order[heads[np.cumsum(~same) - 1]] if len(at) else order
                first = np.empty(len(at), np.int64)
                first[order] = pos[leader]
                repeated = first != pos
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.where(repeated, 0, h1.view(np.int64))),
                        pa.array(np.where(repeated, 0, h2.view(np.int64))),
                        batch.column(0).take(pa.array(owner)),
                        pa.array(pos.astype(np.int64)),
                        pa.array(first, mask=~repeated),
                    ],
                    names=["k1", "k2", "row_key", "pos", "first_pos"],
                )

    return map_arrow(rows.select("row_key", "text", "runs"), run, "k1 long, k2 long, row_key long, pos long, first_pos long")


def exact_copies(rows: DataFrame) -> DataFrame:
    """``(row_key, source_key)`` of the texts that equal one with a smaller key, by two independent hashes."""
    text = F.coalesce("text", F.lit(""))
    digests = rows.select("row_key", F.xxhash64(text).alias("d1"), F.xxhash64(F.lit(1), text).alias("d2"))
    groups = digests.groupBy("d1", "d2").agg(F.min("row_key").alias("source_key"), F.max("row_key").alias("last"))
    several = materialise(groups.filter("source_key < last").drop("last"), "several")
    return digests.join(several, ["d1", "d2"]).filter("row_key > source_key").select("row_key", "source_key").distinct()


def repeated_spans(rows: DataFrame, k: int = 20) -> DataFrame:
    """``(row_key, start, n, source_key, source_start)`` over keyed texts: the ``n`` windows of ``k`` words from word
    ``start`` on also start, one after the other, from word ``source_start`` of an earlier text (or earlier in the
    same text), their first occurrence in the order of the keys.

    1. Minimizers met in two places or more select the windows that may repeat.
    2. Equal windows (edges) are grouped by two independent 64-bit hashes; the first key, with the first place in
       it, is the edge's source. Inside a text this is done before the exchange, so a text counts once an edge.
    3. Every later occurrence joins its edge's source, and runs are compacted: a path goes on while the next edge
       here is also the next edge at the source, and ends where the two branch. The source's coordinates, checked
       edge by edge through the second hash, verify each path.

    Counts are combined before the exchange and joins may be split by key, so a passage in a third of all texts
    does not meet in one task.
    """
    runs = materialise(_minimizer_runs(rows, k), "minimizers")
    # Stored, so that the join's sides are plain exchanges and a value in a third of all texts can be divided.
    shared = materialise(runs.groupBy("value").count().filter("count > 1").select("value"), "shared")
    # The lists are small beside the texts and all of a list is one text's.
    lists = runs.join(shared, "value", "left_semi").groupBy("row_key").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    wanted = materialise(lists, "wanted")
    release(runs, shared)
    edges = materialise(_edges(rows.join(wanted, "row_key"), k), "edges")
    release(wanted)
    across = edges.filter("first_pos is null").select("k1", "k2", "row_key", "pos")
    firsts = across.groupBy("k1", "k2").agg(
        F.min("row_key").alias("source_key"), F.max("row_key").alias("last"), F.min_by("pos", "row_key").alias("source_pos")
    )
    sources = materialise(firsts.filter("source_key < last").drop("last"), "sources")
    later = across.join(sources, ["k1", "k2"]).filter("row_key > source_key").drop("k1", "k2")
    own = edges.filter("first_pos is not null").select(
        "row_key", "pos", F.col("row_key").alias("source_key"), F.col("first_pos").alias("source_pos")
    )
    by_text = Window.partitionBy("row_key").orderBy("pos")
    follows = (
        (F.lag("pos").over(by_text) + 1 == F.col("pos"))
        & (F.lag("source_key").over(by_text) == F.col("source_key"))
        & (F.lag("source_pos").over(by_text) + 1 == F.col("source_pos"))
    )
    # The difference of place and rank names a path together with the branches before it.
    paths = (
        later.unionByName(own)
        .withColumn("branches", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
        .withColumn("path", F.sum("branches").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row_key", "path")
        .agg(
            F.min("pos").alias("start"),
            F.count("*").alias("n"),
            F.first("source_key").alias("source_key"),
            F.min("source_pos").alias("source_start"),
        )
        .drop("path")
    )
    spans = materialise(paths, "spans")
    release(edges, sources)
    return spans


ADDED = ("n_words", "n_removed", "kept_text", "spans")


def _removed(docs: DataFrame, id_col: str, text_col: str, k: int, carry: bool) -> DataFrame:
    """``(id, text, n_words, n_removed, kept_text, spans)`` of every row, with ``carry`` the whole row as ``row`` in place of
    ``id`` and ``text``."""
    rows = with_row_key(docs, id_col, text_col, carry=carry)
    texts = rows.select("row_key", "text")
    # A copy's every window starts earlier; without copies far fewer edges remain.
    copies = materialise(exact_copies(texts), "copies")
    spans = repeated_spans(texts.join(copies, "row_key", "left_anti"), k)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    whole = copies.select("row_key", zero.alias("start"), none.alias("n"), "source_key", zero.alias("source_start"))
    listed = spans.unionByName(whole).groupBy("row_key").agg(
        F.collect_list(F.struct("start", "n", "source_key", "source_start")).alias("spans")
    )
    own = "row" if carry else "id"
    shaped = rows.join(listed, "row_key", "left").select(
        F.struct(F.lit(1).alias("one"), F.col(own), F.col("spans")).alias("kept"),
        F.col("text"),
        F.col("spans.start").alias("begin"),
        F.col("spans.n").alias("size"),
    )

    def run(batches):
        for batch in batches:
            for part in batches_of(batch, "text", STEP_BYTES):
                texts = part.column(1).cast(pa.binary()).to_pylist()
                n_words, n_removed, kept_text = [], [], []
                for text, begin, size in zip(texts, part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    words = (text or b"").split()
                    n_words.append(len(words))
                    if size == [None]:
                        words = [] if len(words) >= k else words
                    elif begin:
                        steps = np.zeros(len(words) + 1, np.int64)
                        np.add.at(steps, np.asarray(begin), 1)
                        np.add.at(steps, np.asarray(begin) + np.asarray(size) + (k - 1), -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
                    n_removed.append(n_words[-1] - len(words))
                    kept_text.append(b" ".join(words))
                counted = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *counted, pa.array(kept_text, pa.binary()).cast(pa.string())],
                    names=["kept", "n_words", "n_removed", "kept_text"],
                )

    shape = StructType([shaped.schema["kept"], *StructType.fromDDL("n_words long, n_removed long, kept_text string").fields])
    return map_arrow(shaped, run, shape).select(f"kept.{own}", "n_words", "n_removed", "kept_text", "kept.spans")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 20, carry: bool = False) -> DataFrame:
    """``(id, n_words, n_removed, kept_text, spans)`` of every row, or with ``carry`` all columns and those four. Words
    (runs of bytes other than ASCII white space) covered by a window of ``k`` words that also starts earlier (smaller
    id; in the same document, an earlier word) are removed; windows are judged on the input. ``kept_text`` has the
    other words joined by one space; ``spans`` lists the repeated paths with their source (``n`` null: a copy of the
    whole source).

    Null and empty texts have no words (``kept_text`` empty). Rows equal in id and text are one document and get the
    same result; equal ids with different texts are ordered by a hash of the text, null ids come first. Carried columns
    may have any names, those of the four added ones are replaced; without ``carry`` other columns are not carried; no
    rows give no rows.
    """
    done = _removed(docs, id_col, text_col, k, carry)
    if not carry:
        return done
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    return done.select(*kept, *ADDED)


def clean_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None, k: int = 20) -> DataFrame:
    """``docs``, all rows and columns whatever their names, with the words of repeated passages removed from the text. A
    text that loses none stays as it is; in others the words left are joined by one space, and ``length_col``, if named,
    counts their characters."""
    done = _removed(docs, id_col, text_col, k, carry=True)
    changed = F.col("n_removed") > 0
    new = {text_col: F.col("kept_text")}
    if length_col:
        new[length_col] = F.length("kept_text").cast(docs.schema[length_col].dataType)
    old = {c: F.col("row").getField(c) for c in docs.columns}
    return done.select(*[(F.when(changed, new[c]).otherwise(old[c]) if c in new else old[c]).alias(c) for c in docs.columns])
