"""Find and remove benchmark passages: a hash set of normalised test n-grams scans all training windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.expressions import NOT_NORMAL, ascii_lower, pieces, window_starts
from fieldstay.llm.storage import materialise, with_row_key

# The hash set is a bit filter: bits a window, bits a window sets, and the most bits (8 MB) it may take.
BITS_PER_WINDOW, PROBES, MOST_BITS = 32, 3, 1 << 26


def normal_words(text):
    return pieces(ascii_lower(F.coalesce(text, F.lit(""))), NOT_NORMAL)


def windows_of(words: Column, starts: Column, width: int | Column) -> Column:
    return F.transform(starts, lambda i: F.slice(words, i, width))


def benchmark_windows(benchmark: DataFrame, width: int, *, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(gram, width, h, items)``: the distinct windows of all items, a hash of their words, and the ids, as strings, of
    the items that have them. An item of fewer words than ``width``, but not none, is one window. Items without an id
    or words have none."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), normal_words(F.col(f"`{text_col}`")).alias("words"))
    items = items.filter(F.col("item").isNotNull() & (F.size("words") > 0)).withColumn("size", F.least(F.size("words"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    windows = items.select("item", F.col("size").alias("width"), F.explode(windows_of(F.col("words"), starts, F.col("size"))).alias("window"))
    grams = windows.groupBy(F.array_join("window", " ").alias("gram"), "width", F.xxhash64("window").alias("h"))
    return grams.agg(F.array_sort(F.collect_set("item")).alias("items"))


def _places(h: Column, bits: int) -> list[Column]:
    """The bits a hash sets: numbers below ``bits`` (a power of two) from different parts of it."""
    return [F.shiftrightunsigned(h, 18 * i).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def bit_filter(grams: DataFrame) -> tuple[DataFrame, int]:
    """One row with the filter's words in order, as ``bitmap``, and its number of bits: ``BITS_PER_WINDOW`` a window, but
    at most ``MOST_BITS``, so what each task holds is bounded. Beyond that it lets more windows through to the join."""
    rows = grams.count()
    bits = min(MOST_BITS, 1 << max(10, (BITS_PER_WINDOW * rows - 1).bit_length()))
    spread = grams.select(F.explode(F.array(*_places(F.col("h"), bits))).alias("place"))
    mask = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = spread.groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(mask).alias("bitmap"))
    every = grams.sparkSession.range(bits // 64).join(words, "id", "left").select(F.struct("id", F.coalesce("bitmap", F.lit(0).cast("long")).alias("bitmap")).alias("w"))
    return every.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["bitmap"]).alias("bitmap")), bits


def scan(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """``(row_key, id, n_words, first, start, width, gram)`` of keyed texts: a row for each window that may be a benchmark
    window: the first one of a text, marked ``first`` (``start`` null if it has none), and those the bit filter knows.

    Windows are only unrolled inside the task: those the filter does not know are dropped before anything is written,
    and the words of the others are joined then.
    """
    filters, bits = bit_filter(grams)
    # At most ``width`` rows: shorter items have windows of their own length.
    widths = sorted(r[0] for r in grams.select("width").distinct().collect())
    worded = rows.select("row_key", "id", normal_words(F.col("text")).alias("words"))
    words = F.col("words")

    def hashes_of(w: int) -> Column:
        return F.transform(window_starts(words, w), lambda i: F.xxhash64(F.slice(words, i, w)))

    hashes = [hashes_of(w) for w in widths]
    hashed = worded.withColumn("hashes", F.concat(*hashes) if hashes else F.array().cast("array<bigint>"))
    unrolled = hashed.select("row_key", "id", "words", F.posexplode_outer("hashes").alias("place", "h"))
    bitmap = materialise(filters, "bit-filter").scalar()
    known = F.lit(True)
    for p in _places(F.col("h"), bits):
        known = known & (F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    first = F.col("place").isNull() | (F.col("place") == 0)
    kept = unrolled.filter(first | F.coalesce(known, F.lit(False)))
    # Places count through the windows of each width in turn.
    ahead, start, width = F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int")
    for w in widths:
        here = F.greatest(F.size("words") - (w - 1), F.lit(0))
        inside = (F.col("place") >= ahead) & (F.col("place") < ahead + here)
        start = F.when(inside, F.col("place") - ahead + 1).otherwise(start)
        width = F.when(inside, F.lit(w)).otherwise(width)
        ahead = ahead + here
    found = kept.select("row_key", "id", "words", first.alias("first"), start.alias("start"), width.alias("width"))
    gram = F.when(F.col("start").isNotNull(), F.array_join(F.slice("words", F.coalesce("start", F.lit(1)), F.coalesce("width", F.lit(0))), " "))
    return found.select("row_key", "id", F.size("words").cast("long").alias("n_words"), "first", "start", "width", gram.alias("gram"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = 13, share: float = 0.05,
) -> DataFrame:
    """``(row_key, id, n_words, n_hit, items, hit_spans, contaminated)`` of every row. Words are runs of digits, a-z
    after lower-casing A-Z, and characters beyond ASCII. A word inside an occurrence of a benchmark window is hit; a
    document is contaminated if ``n_hit`` is positive and at least ``share`` of its words. ``items`` are the sorted ids
    of items with occurring windows, ``hit_spans`` start (from 1) and width of the occurrences.

    Every task holds a filter of the benchmark's window hashes, of at most ``MOST_BITS`` bits; what it lets through is
    verified by joining on the window's words. Only that is exchanged, so a passage in a third of all documents costs
    a row for each, and a benchmark of any size takes the same way.
    Null and empty texts have no words; null ids are kept; rows equal in id and text get the same result; an empty
    benchmark hits nothing; other columns are not carried.
    """
    return contamination_of(
        with_row_key(docs, id_col, text_col), benchmark, item_col=item_col, item_text_col=item_text_col, width=width, share=share
    )


def contamination_of(
    rows: DataFrame, benchmark: DataFrame, *, item_col: str = "item_id", item_text_col: str = "text", width: int = 13, share: float = 0.05
) -> DataFrame:
    """``contamination`` of ``(row_key, id, text)``, by the keys the rows have. Another call of ``with_row_key`` may give
    other keys, so what meets the result again must come from the same keyed rows."""
    grams = materialise(benchmark_windows(benchmark, width, id_col=item_col, text_col=item_text_col), "grams")
    scanned = materialise(scan(rows, grams), "scanned")
    candidates = scanned.filter("start is not null").select("row_key", "start", "width", "gram")
    hits = candidates.join(grams.drop("h"), ["gram", "width"])
    spans = F.collect_set(F.struct("start", "width"))
    by_text = hits.groupBy("row_key").agg(
        F.array_sort(spans).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("hit_spans", lambda s: F.sequence(s["start"], s["start"] + s["width"] - 1))))
    texts = scanned.filter("first").select("row_key", "id", "n_words")
    out = texts.join(by_text, "row_key", "left")
    n_hit = F.coalesce(F.size(covered), F.lit(0)).cast("long")
    return out.select(
        "row_key",
        "id",
        "n_words",
        F.when(F.col("hit_spans").isNull(), F.lit(0).cast("long")).otherwise(n_hit).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hit_spans", F.array().cast("array<struct<start:int,width:int>>")).alias("hit_spans"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") >= F.col("n_words") * F.lit(share).cast("decimal(9,6)")))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(row_key, id, text, row)`` of ``docs`` with the whole row in ``row``, and without it."""
    keyed = with_row_key(docs, id_col, text_col, carry=True)
    return keyed, keyed.select("row_key", "id", "text")


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns whatever their names, whose document is not contaminated."""
    keyed, rows = _keyed(docs, id_col, text_col)
    found = contamination_of(rows, benchmark, **options)
    bad = materialise(found.filter("contaminated").select("row_key").distinct(), "contaminated")
    return keyed.join(bad, "row_key", "left_anti").select("row.*")


def clean_spans(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all rows and columns whatever their names, with hit words cut out of the text; what lies between words
    stays."""
    keyed, rows = _keyed(docs, id_col, text_col)
    found = contamination_of(rows, benchmark, **options)
    spans = materialise(found.filter("n_hit > 0").select("row_key", F.col("hit_spans").alias("spans")).dropDuplicates(["row_key"]), "spans")
    word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
    marked = keyed.join(spans, "row_key", "left")
    gone = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["width"] - 1))))
    # Gap, word, gap, word, ..., gap; a set of word numbers to leave out, as places in the list of words.
    words = F.regexp_extract_all("text", F.lit(word), F.lit(0))
    gaps = F.split("text", word)
    holes = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_position("gone", i) > 0)
    shaped = marked.withColumn("gone", gone).withColumn("holes", holes)
    cut = F.concat(
        F.element_at(gaps, 1),
        F.array_join(F.zip_with(F.arrays_zip(words.alias("w"), F.col("holes").alias("h")), F.slice(gaps, 2, F.size(words)), lambda x, g: F.concat(F.when(x["h"], F.lit("")).otherwise(x["w"]), g)), ""),
    )
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut)
    return shaped.select(*[(text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
