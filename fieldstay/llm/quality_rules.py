"""Quality rules: ordered threshold conjunctions learned from labelled statistics by sequential covering."""

from __future__ import annotations

from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.expressions import BLANKS, pieces, window_starts
from fieldstay.llm.storage import materialise, release

WINDOW = 8


def word_statistics(text: Column, words: Column) -> dict[str, Column]:
    """The base statistics of a text, given its words; null texts have zeros."""
    text = F.coalesce(text, F.lit(""))
    # Lines with a word: anything left once blanks are gone.
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def repeated_words(frame: DataFrame, words: str, out: str, width: int = WINDOW) -> DataFrame:
    """Add ``out``: how many words lie in windows of ``width`` words found twice or more in the list ``words``.

    Windows are compared by a 64-bit hash. Only a list in which a hash occurs twice is sorted; its repeated places, in
    order, each cover the words up to the next one or the window's end.
    """
    hashes = F.transform(window_starts(F.col(words), width), lambda i: F.xxhash64(F.slice(words, i, width)))
    frame = frame.withColumn("_hashes", hashes)
    ranked = F.array_sort(F.zip_with("_hashes", F.sequence(F.lit(1), F.size("_hashes")), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    frame = frame.withColumn("_ranked", F.when(some, ranked))
    at = lambda i: F.get("_ranked", i)["h"]
    twin = lambda x, i: F.coalesce(at(i - 1) == x["h"], F.lit(False)) | F.coalesce(at(i + 1) == x["h"], F.lit(False))
    places = F.array_sort(F.transform(F.filter("_ranked", twin), lambda x: x["i"]))
    frame = frame.withColumn("_places", places)
    step = lambda x, i: F.least(F.coalesce(F.get("_places", i + 1) - x, F.lit(width)), F.lit(width))
    covered = F.aggregate(F.transform("_places", step), F.lit(0), lambda a, x: a + x)
    return frame.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_hashes", "_ranked", "_places")


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` and further counts of every whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", pieces(F.col("text"), BLANKS))
    more = {
        "n_distinct": F.size(F.array_distinct("words")),
        "n_lines": F.size(F.split("text", "\n")),
        "n_upper": F.length(F.regexp_replace("text", "[^A-Z]+", "")),
        "n_digits": F.length(F.regexp_replace("text", "[^0-9]+", "")),
        "n_marks": F.length(F.regexp_replace("text", "[^!?]+", "")),
        "n_ends": F.length(F.regexp_replace("text", "[^.]+", "")),
    }
    rows = rows.withColumns(word_statistics(F.col("text"), F.col("words")) | {k: c.cast("long") for k, c in more.items()})
    return repeated_words(rows, "words", "n_repeat_words").drop("text", "words")


def ratios() -> dict[str, Column]:
    """What the rules may test: a bounded set of figures, zero for a text without words."""
    over = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": over("word_chars", "n_words"),
        "symbol_share": over("n_symbols", "word_chars"),
        "dup_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"),
        "distinct_share": over("n_distinct", "n_words"),
        "upper_share": over("n_upper", "word_chars"),
        "digit_share": over("n_digits", "word_chars"),
        "mark_share": over("n_marks", "word_chars"),
        "end_share": over("n_ends", "n_words"),
    }


class Test(NamedTuple):
    figure: str
    above: bool
    threshold: float

    def column(self) -> Column:
        figure = F.col(self.figure)
        return figure > F.lit(self.threshold) if self.above else figure <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.figure} {'>' if self.above else '<='} {self.threshold:.6g}"


class Rule(NamedTuple):
    tests: tuple[Test, ...]
    hits: int
    errors: int

    def column(self) -> Column:
        out = F.lit(True)
        for test in self.tests:
            out = out & test.column()
        return out

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.tests))} ({self.hits} right, {self.errors} wrong)"


def _histograms(cells: DataFrame, rows: Column, figures: list[str]) -> dict[str, list[tuple[int, int, int]]]:
    """(bin, bad, good) of each figure over the chosen rows: one job, at most bins times figures rows."""
    stacked = ", ".join(f"'{f}', bin_{f}" for f in figures)
    counted = (
        cells.filter(rows)
        .selectExpr(f"stack({len(figures)}, {stacked}) as (figure, bin)", "bad", "good")
        .groupBy("figure", "bin")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    out: dict[str, list[tuple[int, int, int]]] = {f: [] for f in figures}
    for r in counted.collect():
        out[r["figure"]].append((r["bin"], r["bad"], r["good"]))
    return {f: sorted(v) for f, v in out.items()}


# Shares of the rows at which a figure may be cut, closer together at the ends, where a rare kind of junk lies.
ENDS = (1 / 2048, 1 / 1024, 1 / 512, 1 / 256, 1 / 128)


def cuts_of(values: list[float], parts: int) -> list[float]:
    """Where a figure with these values may be cut: behind every value if there are few, else behind the values at even
    shares of the rows and at finer ones towards the ends; each midway to the next value, so that a rule keeps its
    distance from the rows on either side."""
    values, distinct = sorted(values), sorted(set(values))
    if len(distinct) <= parts:
        behind = distinct[:-1]
    else:
        shares = {*ENDS, *(1 - e for e in ENDS), *(i / parts for i in range(1, parts))}
        behind = sorted({values[int(share * len(values))] for share in shares} - {distinct[-1]})
    following = dict(zip(distinct, distinct[1:]))
    return sorted({(v + following[v]) / 2 for v in behind})


def _cuts(rows: DataFrame, names: list[str], parts: int, sample_rows: int) -> dict[str, list[float]]:
    """The cuts of each figure, from at most ``sample_rows`` of the rows, chosen by a hash of their figures."""
    sample = rows.select(*names).orderBy(F.xxhash64(*names), *names).limit(sample_rows).collect()
    return {n: cuts_of([r[n] for r in sample], parts) for n in names}


def _best_test(
    histograms: dict, cuts: dict[str, list[float]], bad: int, good: int, least: int, aside: set[tuple[str, bool]]
) -> tuple[float, Test, int, int] | None:
    """The test with the largest gain, of a bit at least: rejected rows that stay, times the rise in the log of their
    share."""
    before, best = log2((bad + 1) / (bad + good + 2)), None
    for figure, rows in histograms.items():
        low_bad = low_good = 0
        for b, n_bad, n_good in rows:
            low_bad, low_good = low_bad + n_bad, low_good + n_good
            if b >= len(cuts[figure]):
                continue
            for above, kept_bad, kept_good in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                if kept_bad < least or (figure, above) in aside:
                    continue
                gain = kept_bad * (log2((kept_bad + 1) / (kept_bad + kept_good + 2)) - before)
                if gain >= 1 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, Test(figure, above, cuts[figure][b]), kept_bad, kept_good)
    return best


def _grow(cells: DataFrame, first: dict, cuts: dict[str, list[float]], holds, least: int, aside: set) -> list[Test]:
    """Tests added one by one, each with the largest gain on what the others leave, until only rejected rows are left or
    nothing gains. ``first`` are the histograms without a test."""
    tests: list[Test] = []
    chosen, histograms = ~F.col("prune"), first
    while True:
        any_figure = next((v for v in histograms.values() if v), [])
        bad, good = sum(r[1] for r in any_figure), sum(r[2] for r in any_figure)
        best = _best_test(histograms, cuts, bad, good, least, set() if tests else aside) if bad else None
        if best is None:
            return tests
        tests.append(best[1])
        if best[3] == 0:
            return tests
        chosen = chosen & holds(best[1])
        histograms = _histograms(cells, chosen, list(cuts))


def learn(
    figures: DataFrame, names: list[str], *, parts: int = 64, sample_rows: int = 20_000, least_hits: int = 5, precision: float = 0.9,
) -> list[Rule]:
    """A decision list over rows ``(figure columns, bad, prune)``: ``bad`` 1 for a rejected row, 0 for an accepted one,
    ``prune`` true for the third on which rules are pruned.

    A rule grows by the test with the largest information gain until it is pure or gains nothing; it is then cut back
    to the beginning that is most precise on the pruning rows. A rule below ``precision`` or with fewer than
    ``least_hits`` rejected rows there is dropped, the figures and directions it tests are set aside as beginnings, and
    the next best is grown. The rows a kept rule covers are taken out, figures are cut anew on what is left, and the search
    goes on until no beginning gains.

    Cuts come from at most ``sample_rows`` of the remaining rows; all counts are over all of them, by the cells that the
    cuts make, so a growing step is one grouped count over few rows.
    """
    rows, rules = figures, []
    while True:
        cuts = _cuts(rows.filter(~F.col("prune")), names, parts, sample_rows)

        def bin_of(name: str, cuts: dict = cuts) -> Column:
            # How many cuts lie below the figure: a test "<= cut b" holds for bins up to b.
            limits = F.array(*(F.lit(float(e)) for e in cuts[name])) if cuts[name] else F.array().cast("array<double>")
            return F.size(F.filter(limits, lambda e: e < F.col(name)))

        def holds(test: Test, cuts: dict = cuts) -> Column:
            at = cuts[test.figure].index(test.threshold)
            return F.col(f"bin_{test.figure}") > at if test.above else F.col(f"bin_{test.figure}") <= at

        binned = rows.select(*(bin_of(n).alias(f"bin_{n}") for n in names), F.col("bad").cast("long").alias("bad"), (1 - F.col("bad")).cast("long").alias("good"), "prune")
        cells = materialise(binned.groupBy(*(f"bin_{n}" for n in names), "prune").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "cells")
        first, aside, rule = _histograms(cells, ~F.col("prune"), names), set(), None
        while rule is None:
            tests = _grow(cells, first, cuts, holds, least_hits, aside)
            if not tests:
                release(cells)
                return rules
            rule = _pruned(cells.filter("prune"), tests, holds, least_hits, precision)
            aside |= {(t.figure, t.above) for t in tests}
        release(cells)
        rules.append(rule)
        rows = materialise(rows.filter(~F.coalesce(rule.column(), F.lit(False))), "uncovered")


def _pruned(cells: DataFrame, tests: list[Test], holds, least_hits: int, precision: float) -> Rule | None:
    """The beginning of a rule that is most precise on the pruning rows, in one job; none if that is not good enough."""
    condition, counts = F.lit(True), []
    for i, test in enumerate(tests):
        condition = condition & holds(test)
        counts += [F.sum(F.when(condition, F.col(k)).otherwise(0)).alias(f"{k}{i}") for k in ("bad", "good")]
    seen = cells.agg(*counts).first()
    scored = [((seen[f"bad{i}"] or 0), (seen[f"good{i}"] or 0)) for i in range(len(tests))]
    worth = [(b + 1) / (b + g + 2) for b, g in scored]
    cut = max(range(len(tests)), key=lambda i: (round(worth[i], 4), -i))
    hits, errors = scored[cut]
    if hits < least_hits or hits < precision * (hits + errors):
        return None
    return Rule(tuple(tests[: cut + 1]), hits, errors)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: the number of the first rule that holds, null for none."""
    out = None
    for i, rule in enumerate(rules):
        out = F.when(rule.column(), F.lit(i + 1)) if out is None else out.when(rule.column(), F.lit(i + 1))
    return F.lit(None).cast("int") if out is None else out


def judge(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", **options
) -> tuple[DataFrame, list[Rule]]:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rule, kept)`` of every row, and
    the rules. ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated 8-word windows. ``rule`` is
    the first learned rule that holds; ``kept`` is false where the base failed or a rule holds.

    Rules learn from all labelled rows that pass the base, by their counts. Without labels there are no rules. Null
    and empty texts have no words and fail the base; null ids are kept; repeated rows are all returned; an id labelled
    twice counts once, with its larger label; other columns are not carried.
    """
    counted = materialise(statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    figured = counted.withColumn("base_failed", base_failed).withColumns(ratios())
    names = list(ratios())
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    trained = figured.filter(~F.col("base_failed")).join(known, F.col("id") == F.col("_id"))
    rows = trained.select(*names, (1 - F.col("_label")).alias("bad"), (F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(3)) == 0).alias("prune"))
    rules = learn(materialise(rows, "labelled"), names, **options)
    out = figured.withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    return out.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept"), rules
