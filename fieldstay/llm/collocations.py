"""Phrases mined by vertical partitioning: suffixes of three words are grouped by word prefixes under a memory budget,
and each group's depth-truncated subtree is built on its own."""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldstay.llm.storage import ARROW_SETTING, map_arrow, materialise, ranked, release, slots_for, trim
from fieldstay.llm.words import batches_of, plain, split_words

# A group's subtree is built from at most twice so many suffixes.
BUDGET = 1 << 20
# The budget grows where there would be more groups than this, so the list of their bounds stays small.
MOST_GROUPS = 1 << 18
SLICE_BYTES = 1 << 22
# Packed suffixes handed to a task at a time.
PACKS = 16
BREAK = "."
CODEC = "zstd"


def _pack(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)


def _unpack(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec=CODEC, asbytes=True)


def _summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of int columns, sorted, with their summed counts."""
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(bits) < 63:
        key = np.zeros(len(counts), dtype=np.int64)
        for c, b in zip(columns, bits):
            key = (key << b) | c
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    else:
        order = np.lexsort(columns[::-1])
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
        new = np.flatnonzero(new)
    first = order[new]
    totals = np.add.reduceat(counts[order], new, dtype=np.int64) if len(new) else counts[:0].astype(np.int64)
    return [c[first] for c in columns], totals


class Suffixes:
    """Words and the distinct three-word suffixes over them: codes from 1 into ``words``, 0 where the piece has ended."""

    def __init__(self, words: list[bytes], codes: np.ndarray, counts: np.ndarray):
        self.words, self.codes, self.counts = words, codes, counts

    def packed(self) -> tuple[bytes, bytes]:
        # Codes and, in one slice of text, counts fit 32 bits.
        numbers = np.concatenate([self.codes.ravel(), self.counts]).astype("<i4")
        return _pack(b" ".join(self.words)), _pack(numbers.tobytes())

    @classmethod
    def unpacked(cls, words: bytes, numbers: bytes) -> Suffixes:
        values = np.frombuffer(_unpack(numbers), dtype="<i4").reshape(4, -1)
        return cls(_unpack(words).split(b" "), values[:3], values[3])

    def part(self, rows: np.ndarray) -> Suffixes:
        """Some of the suffixes, over the words that occur in them."""
        codes = self.codes[:, rows]
        used, again = np.unique(codes, return_inverse=True)
        if used[0]:
            used, again = np.concatenate([[0], used]), again + 1
        return Suffixes([self.words[c - 1] for c in used[1:]], again.reshape(codes.shape), self.counts[rows])


def _suffixes(texts: pa.Array, langs: pa.Array):
    """``(lang, Suffixes)`` of a slice of texts."""
    lowered = pc.ascii_lower(pc.fill_null(plain(texts), ""))
    # A break becomes a token of its own: none of these characters can be in a word.
    marked = pc.replace_substring_regex(lowered, r"[.,;:!?\x0A-\x0D]", f" {BREAK} ")
    codes, values, offsets = split_words(marked)
    names = plain(langs).dictionary_encode()
    dot = pc.index(values, BREAK).as_py()
    token = np.asarray(codes, dtype=np.int64) + 1
    if dot >= 0:
        token[token == dot + 1] = 0
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    second, third = np.zeros_like(token), np.zeros_like(token)
    second[:-1] = np.where(owner[1:] == owner[:-1], token[1:], 0)
    third[:-1] = np.where(second[:-1] > 0, second[1:], 0)
    lang = names.indices.to_numpy(zero_copy_only=False)[owner].astype(np.int64)
    real = token > 0
    (lang, first, second, third), counts = _summed([lang[real], token[real], second[real], third[real]], np.ones(real.sum(), dtype=np.int64))
    words = values.cast(pa.binary()).to_pylist()
    every = Suffixes(words, np.stack([first, second, third]), counts)
    for code in np.unique(lang):
        yield names.dictionary[int(code)].as_py(), every.part(np.flatnonzero(lang == code))


def _write_suffixes(batches):
    for batch in batches:
        for some in batches_of(batch, "text", SLICE_BYTES):
            for lang, suffixes in _suffixes(some.column("text"), some.column("lang")):
                words, numbers = suffixes.packed()
                yield pa.RecordBatch.from_pydict({"lang": [lang], "words": [words], "numbers": [numbers]})
            trim()


def _read(batch: pa.RecordBatch):
    for lang, words, numbers in zip(*(batch.column(c) for c in ("lang", "words", "numbers"))):
        yield lang.as_py(), Suffixes.unpacked(words.as_py(), numbers.as_py())


def _text(words: list[bytes], codes: np.ndarray) -> pa.Array:
    """Words by their codes; null for 0."""
    known = pa.array([None, *words], pa.binary()).cast(pa.string())
    return known.take(pa.array(codes))


def _nodes(lang: str, suffixes: Suffixes, codes: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    padded = [*codes, *[np.zeros(len(counts), dtype=np.int64)] * (3 - len(codes))]
    columns = [pa.array([lang] * len(counts), pa.string()), *[_text(suffixes.words, c) for c in padded], pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "w1", "w2", "w3", "f"])


NODE = "lang string, w1 string, w2 string, w3 string, f long"


def _prefixes(depth: int, long: set):
    """Counts of the prefixes of ``depth`` words below the ``long`` ones, or of all words."""

    def run(batches):
        for batch in batches:
            for lang, s in _read(batch):
                rows = slice(None)
                if depth > 1:
                    parents = {w[1:] for w in long if w[0] == lang}
                    rows = _below(s, parents, depth - 1) & (s.codes[depth - 1] > 0)
                if len(s.counts[rows]):
                    yield _nodes(lang, s, *_summed([c[rows] for c in s.codes[:depth]], s.counts[rows]))
            trim()

    return run


def _below(s: Suffixes, parents: set, depth: int) -> np.ndarray:
    """Which suffixes have one of the ``parents`` (tuples of ``depth`` words) as their prefix."""
    (found), _ = _summed(list(s.codes[:depth]), s.counts)
    hit = [i for i, p in enumerate(zip(*found)) if 0 not in p and tuple(s.words[c - 1] for c in p) in parents]
    if not hit:
        return np.zeros(len(s.counts), dtype=bool)
    wide = len(s.words) + 1
    pair = [sum(c.astype(np.int64) * wide**k for k, c in enumerate(cs)) for cs in (found, s.codes[:depth])]
    return np.isin(pair[1], pair[0][hit])


def _deal(bounds: list[tuple], long: set, longer: set):
    """Suffixes dealt to the groups of their prefixes; those below the ``longer`` prefixes are counted already."""

    def run(batches):
        first_long = defaultdict(set)
        for lang, word in long:
            first_long[lang].add(word)
        for batch in batches:
            for lang, s in _read(batch):
                (first,), _ = _summed([s.codes[0]], s.counts)
                group = np.zeros(len(s.words) + 1, dtype=np.int64)
                hot = [c for c in first if s.words[c - 1] in first_long[lang]]
                for c in first:
                    group[c] = bisect_right(bounds, (lang.encode(), s.words[c - 1], b"")) - 1
                where = group[s.codes[0]]
                # A prefix of one word has no phrase in it, and what follows a long word has a group of its own.
                keep = s.codes[1] > 0
                if hot:
                    among = np.flatnonzero(np.isin(s.codes[0], hot) & keep)
                    wide = len(s.words) + 1
                    pair, again = np.unique(s.codes[0][among].astype(np.int64) * wide + s.codes[1][among], return_inverse=True)
                    names = [(s.words[p // wide - 1], s.words[p % wide - 1]) for p in pair]
                    where[among] = np.array([bisect_right(bounds, (lang.encode(), *n)) - 1 for n in names], dtype=np.int64)[again]
                    done = np.array([(lang, *n) in longer for n in names], dtype=bool)[again]
                    keep[among[done]] = False
                rows = np.flatnonzero(keep)
                rows = rows[np.argsort(where[rows], kind="stable")]
                cuts = np.flatnonzero(np.diff(where[rows])) + 1
                for some in np.split(rows, cuts) if len(rows) else ():
                    words, numbers = s.part(some).packed()
                    yield pa.RecordBatch.from_pydict(
                        {"grp": pa.array([where[some[0]]], pa.int64()), "lang": [lang], "words": [words], "numbers": [numbers]}
                    )
            trim()

    return run


def _subtree(lang: str, parts: list[Suffixes], long: set, least: int):
    """The subtree of one group: leaf totals, and from them the nodes of two words, ``least`` times or more."""
    words = pa.chunked_array([pa.array(p.words, pa.binary()) for p in parts])
    coded = plain(words.dictionary_encode())
    names = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1
    ends = np.cumsum([len(p.words) for p in parts])
    none = np.zeros(1, dtype=np.int32)
    renamed = [np.concatenate([none, codes[end - len(p.words) : end]])[p.codes] for p, end in zip(parts, ends)]
    counts = np.concatenate([p.counts for p in parts])
    parts.clear()
    leaves, totals = _summed(list(np.concatenate(renamed, axis=1)), counts)
    merged = Suffixes(names, np.stack(leaves), totals)
    frequent = (totals >= least) & (leaves[2] > 0)
    yield _nodes(lang, merged, [c[frequent] for c in leaves], totals[frequent])
    inner, sums = _summed(leaves[:2], totals)
    frequent = sums >= least
    # Words after a long word were counted when its prefix was lengthened.
    whole = np.array([(lang, w) not in long for w in [b"", *names]], dtype=bool)
    frequent &= whole[inner[0]]
    yield _nodes(lang, merged, [c[frequent] for c in inner], sums[frequent])


def _build(long: set, least: int):
    def run(batches):
        at, parts = None, []
        for batch in batches:
            for group, (lang, s) in zip(batch.column("grp"), _read(batch)):
                if at is not None and at != (group.as_py(), lang):
                    yield from _subtree(at[1], parts, long, least)
                    parts = []
                    trim()
                at = (group.as_py(), lang)
                parts.append(s)
        if parts:
            yield from _subtree(at[1], parts, long, least)
        trim()

    return run


def _longest(prefixes: DataFrame, budget: int, depth: int) -> set:
    """Prefixes with more suffixes than the budget: at most as many as the budget goes into the corpus."""
    rows = prefixes.filter(F.col("f") > budget).select("lang", *[f"w{k + 1}" for k in range(depth)]).collect()
    return {(r[0], *(w.encode() for w in r[1:])) for r in rows}


def _bounds(prefixes: DataFrame, budget: int) -> list[tuple]:
    """The first prefix of every group: prefixes in order, a new group where the sum before passes the budget."""
    placed = materialise(
        prefixes.repartitionByRange(slots_for(prefixes.sparkSession), "lang", "w1", "w2").sortWithinPartitions("lang", "w1", "w2")
        .withColumn("place", F.monotonically_increasing_id()).withColumn("slot", F.shiftright("place", 33)),
        "prefixes",
    )
    # One row for each partition of the exchange above.
    sums = placed.groupBy("slot").agg(F.sum("f").alias("total"))
    before = materialise(sums.select("slot", (F.sum("total").over(Window.orderBy("slot")) - F.col("total")).alias("before")), "slots")
    inside = F.sum("f").over(Window.partitionBy("slot").orderBy("place")) - F.col("f")
    group = F.floor((F.col("before") + inside) / budget)
    first = placed.join(before, "slot").withColumn("group", group).groupBy("group").agg(F.min(F.struct("lang", "w1", "w2")).alias("p"))
    rows = first.select("p.*").collect()
    release(placed, before)
    return sorted((r[0].encode(), r[1].encode(), r[2].encode()) for r in rows)


def phrase_counts(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 10, budget: int = BUDGET
) -> tuple[DataFrame, DataFrame]:
    """``(lang, w1, w2, w3, f)`` of every phrase of one to three words (null beyond its last) that occurs at least
    ``least`` times in a language, and ``(lang, n)`` with each language's number of words.

    Words are counted first. A prefix with more suffixes than the budget is lengthened by a word, as often as needed;
    the others are packed, in their order, into groups of at most twice the budget. Suffixes are dealt to their
    prefix's group, and a task builds one group's subtree at a time. Batches send equal suffixes once with a count, so a
    frequent word or phrase is spread over groups of its own, and a third of all words being one costs no task more.

    The driver holds the first prefix of every group and the lengthened prefixes: fewer than ``2 * MOST_GROUPS``, as
    the budget grows where a corpus would have more groups.
    """
    usual = docs.sparkSession.conf.get(ARROW_SETTING)
    given = docs.select(F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    stored = materialise(map_arrow(given, _write_suffixes, "lang string, words binary, numbers binary"), "suffixes")

    def counted(depth: int, long: set) -> DataFrame:
        found = map_arrow(stored, _prefixes(depth, long), NODE, PACKS).groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f"))
        return materialise(found.select("lang", "w1", "w2", "w3", "f"), f"prefixes-{depth}")

    words = counted(1, set())
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    every = totals.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, every // MOST_GROUPS + 1)
    long = _longest(words, budget, 1)
    grouped = words.filter(F.col("f") <= budget).withColumn("w2", F.lit(""))
    known = [words]
    longer: set = set()
    if long:
        pairs = counted(2, long)
        known.append(pairs)
        longer = _longest(pairs, budget, 2)
        grouped = grouped.unionByName(pairs.filter(F.col("f") <= budget))
        if longer:
            known.append(counted(3, longer))
    bounds = _bounds(grouped, budget)
    dealt = map_arrow(stored, _deal(bounds, long, longer), "grp long, lang string, words binary, numbers binary", PACKS)
    arranged = dealt.repartition("grp").sortWithinPartitions("grp", "lang")
    nodes = map_arrow(arranged, _build(long, least), NODE, PACKS)
    for table in known:
        nodes = nodes.unionByName(table.filter(F.col("f") >= least))
    out = materialise(nodes, "phrases")
    release(stored)
    docs.sparkSession.conf.set(ARROW_SETTING, usual)
    return out, totals


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (l * r))`` in 38 digits; at most 1000000, as no part is rarer than the phrase."""
    wide = [c.cast("decimal(16,0)") for c in (a, left, right)]
    top, below = (F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0]).cast("decimal(31,0)")).cast("decimal(38,0)"), wide[1] * wide[2]
    return F.call_function("div", top, below).cast("long")


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000, covered: int = 50,
    budget: int = BUDGET,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best ``top`` phrases of two and three words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` the language's words. Phrases inside a
    longer one that occurs at least ``covered`` percent as often are left out. Ranks go by score, then count (both
    descending), then the phrase's bytes. A-Z are lower-cased; words do not cross ``.,;:!?`` or line ends.

    Null and empty texts have no words; a null language is ``und`` and joins a language of that name. Ids are not read, so
    repeated rows count each time; other columns, whatever their names, are not read. No words give no rows.
    """
    nodes, totals = phrase_counts(docs, text_col=text_col, lang_col=lang_col, least=least, budget=budget)
    ones = nodes.filter(F.col("w2").isNull()).select("lang", F.col("w1").alias("w"), "f")
    twos = nodes.filter(F.col("w2").isNotNull() & F.col("w3").isNull()).select("lang", "w1", "w2", F.col("f").alias("a"))
    threes = nodes.filter(F.col("w3").isNotNull()).select("lang", "w1", "w2", "w3", F.col("f").alias("a"))

    def one(at: str, name: str) -> DataFrame:
        return ones.select("lang", F.col("w").alias(at), F.col("f").alias(name))

    def two(first: str, second: str, name: str) -> DataFrame:
        return twos.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))

    pairs = materialise(twos.join(one("w1", "l"), ["lang", "w1"]), "pairs").join(one("w2", "r"), ["lang", "w2"])
    hidden = threes.select("lang", "w1", "w2", "a").unionByName(threes.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    most = hidden.groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
    pairs = pairs.join(most, ["lang", "w1", "w2"], "left").filter(F.coalesce(100 * F.col("most") < covered * F.col("a"), F.lit(True)))
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r").withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))

    cut = threes.join(two("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(two("w2", "w3", "r1"), ["lang", "w2", "w3"])
    cut = materialise(cut, "triples").join(one("w1", "l1"), ["lang", "w1"])
    cut = materialise(cut, "triples").join(one("w3", "r2"), ["lang", "w3"])
    cut = cut.withColumns({f"s{k}": _score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2)})
    first = F.col("s1") <= F.col("s2")
    triples = cut.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    scored = materialise(pairs.unionByName(triples).withColumns({"_s": -F.col("score"), "_a": -F.col("a")}), "scored")
    placed = materialise(ranked(scored, ["lang", "_s", "_a", "phrase"], "ranked"), "placed")
    first = placed.groupBy("lang").agg(F.min("pos").alias("first"))
    rank = (F.col("pos") - F.col("first") + 1).alias("rank")
    best = placed.join(first.join(totals, "lang"), "lang").select("lang", rank, "phrase", "a", "l", "r", "n", "score")
    return best.filter(F.col("rank") <= top)
