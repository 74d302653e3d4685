"""Shards of nearly equal bytes by histogram sort: probes between keys are counted and refined, rows move once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.llm.storage import materialise, numbered, slots_for

KEY_DIGITS = 48
# Hexadecimal digits a round adds to an open probe: 4,096 cells.
STEP = 3
# Sorts behind every digit, so ``cell + AFTER`` is the boundary behind a cell.
AFTER = "g"


class Open(NamedTuple):
    """A splitter still sought: its target in bytes, the cell it lies in and the bytes below that cell."""

    number: int
    target: float
    cell: str
    below: int


def sort_key(text: Column, row_id: Column) -> Column:
    """48 hexadecimal digits: a hash of the text, so that equal texts lie together, then one of the id and the text, then
    one of the row's number, so that a large group of equal texts, or of equal rows, can be divided."""
    digits = lambda h: F.lpad(F.hex(h), 16, "0")
    number = F.xxhash64(F.monotonically_increasing_id())
    return F.concat(digits(F.xxhash64(text)), digits(F.xxhash64(row_id.cast("string"), text, F.lit(1))), digits(number))


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Boundaries between shards over ``(key, size)``: a row belongs to the shard numbered by how many are <= its key.

    Each round counts the exact bytes in the cells of every open probe: partial sums at each partition, at most
    (shards - 1) * 4,096 rows to the driver. A splitter is settled at a cell's edge within ``tolerance`` of a shard's
    mean, at the nearer edge of a cell of one row, or at the last digit; otherwise the cell is opened.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    opened = [Open(j, j * total / shards, "", 0) for j in range(1, shards)] if total else []
    found: dict[int, str] = {}
    digits = 0
    while opened:
        cells = sorted({o.cell for o in opened})
        inside = keyed if not digits else keyed.filter(F.substring("key", 1, digits).isin(cells))
        digits = min(KEY_DIGITS, digits + STEP)
        counted = inside.groupBy(F.substring("key", 1, digits).alias("cell")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        histogram = sorted((r["cell"], r["bytes"], r["rows"]) for r in counted.collect())
        still = []
        for probe in opened:
            low = probe.below
            for cell, size, rows in histogram:
                if not cell.startswith(probe.cell):
                    continue
                high = low + size
                if probe.target <= high:
                    before, behind = probe.target - low, high - probe.target
                    if min(before, behind) <= allowed or rows == 1 or digits == KEY_DIGITS:
                        found[probe.number] = cell if before <= behind else cell + AFTER
                    else:
                        still.append(Open(probe.number, probe.target, cell, low))
                    break
                low = high
            else:
                # Rounding left the target a hair above the last cell.
                found[probe.number] = histogram[-1][0] + AFTER
        opened = still
    return [found.get(j, AFTER) for j in range(1, shards)]


def shard_of(key: Column, bounds: list[str]) -> Column:
    number = F.lit(0)
    for bound in bounds:
        number = number + (key >= F.lit(bound)).cast("int")
    return number


def assign(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, tolerance: float = 0.001,
    carry: tuple[Column, ...] = (),
) -> DataFrame:
    """``(id, size, *carry, shard, slot)`` of every row; ``slot`` counts from 0 without gaps in each shard.

    Rows are ordered by a hash of the text, then one of the id, then one of the row's number, and cut where the bytes
    below come nearest to equal parts. The numeric columns are written once for the counting rounds; then rows are exchanged once, by shard
    and a hash that divides a shard into as many parts as there are shuffle partitions, and numbered part by part.
    Null texts have size 1; null ids are kept; rows equal in id and text lie together where they fit into a shard; no
    rows give no rows. Columns
    beyond ``carry`` are not carried.
    """
    text, row_id = F.col(text_col), F.col(id_col)
    keyed = materialise(
        docs.select(row_id.alias("id"), byte_size(text).alias("size"), *carry, sort_key(text, row_id).alias("key")), "keys"
    )
    bounds = splitters(keyed, shards, tolerance)
    parts = slots_for(docs.sparkSession)
    placed = keyed.withColumn("shard", shard_of(F.col("key"), bounds)).withColumn(
        "part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    )
    return numbered(placed, "shard", ["key"], "part").withColumnRenamed("rank", "slot").drop("part", "key")


def write_shards(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, tolerance: float = 0.001) -> None:
    """Write the rows of ``docs``, all columns, as Parquet in one folder a shard (``shard=N``); a column named
    ``shard`` is replaced. The texts are read for their keys, and again to be exchanged once into place; rows equal in
    id and text may get other numbers then, which changes their shards and not the bytes of a shard by much."""
    key = sort_key(F.col(text_col), F.col(id_col))
    keyed = materialise(docs.select(byte_size(F.col(text_col)).alias("size"), key.alias("key")), "keys")
    bounds = splitters(keyed, shards, tolerance)
    parts = max(1, slots_for(docs.sparkSession) // shards)
    placed = docs.withColumn("shard", shard_of(key, bounds))
    dealt = placed.repartition(shards * parts, "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))
    dealt.write.partitionBy("shard").parquet(path)
