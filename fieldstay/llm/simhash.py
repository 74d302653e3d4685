"""Near-duplicates by SimHash fingerprints that meet in the middle of a Hamming ball."""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldstay.llm.components import stars
from fieldstay.llm.storage import map_arrow, materialise
from fieldstay.llm.words import plain

BLOCK = 1 << 16


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each of the 64 bits, lowest first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Eight counters of one byte in each 64-bit lane; 255 rows cannot overflow them.
    lanes = np.add.reduceat(bits.view("<u8"), np.arange(0, len(hashes), 255), axis=0)
    return lanes.view(np.uint8).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """The SimHash of a lower-cased text: a bit is 1 if over half the shingles' XXH64 values set it."""
    words = text.split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    hashes = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(shingle)))), repeat(seed))
    counts, n = np.zeros(64, np.int64), 0
    while len(block := np.fromiter(islice(hashes, BLOCK), np.uint64)):
        counts += _bit_counts(block)
        n += len(block)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)`` of every whole text: words are runs of bytes other than ASCII white space, A-Z lower-cased,
    ``fp`` the fingerprint's bits as a signed long. Null and empty texts have fingerprint 0; a null id is kept."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = pc.ascii_lower(pc.fill_null(plain(batch.column(1)), "")).cast(pa.binary())
            values = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["id", "fp"])

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {id_type}, fp long")


def ball(half: int) -> list[int]:
    """Signed 64-bit masks with at most ``half`` bits set."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(distinct_prints: DataFrame, distance: int) -> DataFrame:
    """Edges ``(a, b)``, ``a > b``, between distinct fingerprints ``fp`` at most ``distance`` bits apart (an even
    number), enough to connect what such links connect.

    Every fingerprint is dealt to all variants within half the distance, so two that are close enough meet in a
    variant between them. Those that meet lie in one ball: at most as many as the ball has points, and any two are
    within ``distance``. Each is linked to the smallest there, so no pairs are multiplied; each link is verified.
    """
    if distance % 2 or not 0 <= distance <= 4:
        raise ValueError("the distance must be 0, 2 or 4")
    variants = distinct_prints.select("fp", F.explode(F.lit(ball(distance // 2))).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    met = variants.withColumn("hub", F.min("fp").over(Window.partitionBy("variant"))).filter("fp > hub")
    pairs = met.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2, seed: int = 42
) -> DataFrame:
    """``(id, fp, component_id)`` of every row: documents whose fingerprints differ in at most ``distance`` bits are
    linked; ``component_id`` is the smallest id reachable over links, itself included.

    Equal fingerprints meet once, with their smallest id, before anything is dealt out. Null and empty texts have
    fingerprint 0 and link like any other; repeated rows are all returned; null ids are kept and never the smallest,
    unless a component has no other; other columns are not carried; no rows give no rows.
    """
    prints = materialise(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed), "prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-prints")
    roots = stars(links(distinct.select("fp"), distance)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("id", "fp", "component_id")
