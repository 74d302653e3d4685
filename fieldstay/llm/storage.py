"""Intermediate tables in the shared folder, and stable keys of rows."""

from __future__ import annotations

import ctypes
from collections.abc import Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from fieldstay.session import scratch_path, tune

ARROW_ROWS = 2_000
ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
_malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Shuffle files of the statements run inside go as soon as each has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialise(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there: its lineage ends here, a lost executor
    costs a re-read, and the shuffle files that made it are freed.
    """
    spark = tune(df.sparkSession)
    path = scratch_path(spark, name)
    with freeing_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path:
            spark = table.sparkSession
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def map_arrow(df: DataFrame, run, schema: str | StructType, rows: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` with batches of few rows, so that a worker's memory stays small where texts are long."""
    df.sparkSession.conf.set(ARROW_SETTING, rows)
    return df.mapInArrow(run, schema)


def trim() -> None:
    """Hand memory that a worker no longer uses back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if _malloc_trim is not None:
        _malloc_trim(0)


def slots_for(spark: SparkSession) -> int:
    """How many ways to deal out rows by a hash: the shuffle partitions the session is set to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name of theirs can meet one that an operator adds; ``row.*`` of it
    are the columns again."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def with_row_key(docs: DataFrame, id_col: str, text_col: str, *, carry: bool = False) -> DataFrame:
    """``(row_key, id, text)``, or with ``carry`` also ``row``, the whole row as a struct. ``row_key`` is a long that is
    never null, differs between rows that differ in id or text, and is ordered as the ids are (nulls first; equal ids
    by the hash of the text).

    Ids that are unique longs are their own keys, which one pass over the id column finds out. Otherwise the
    distinct (id, text hash) pairs are sorted by range and numbered, whatever the type of the id.
    Rows equal in both share a key and are one document.
    """
    spark = docs.sparkSession
    own = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")]
    rows = docs.select(*own, *([whole_row(docs).alias("row")] if carry else []))
    if docs.schema[id_col].dataType.simpleString() in ("bigint", "int"):
        odd = rows.groupBy("id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col("id").isNull())
        if not odd.take(1):
            return rows.withColumn("row_key", F.col("id").cast("long"))
    tagged = rows.withColumn("tag", F.xxhash64("text"))
    pairs = tagged.select(F.col("id").alias("key_id"), F.col("tag").alias("key_tag")).distinct()
    keys = materialise(
        pairs.repartitionByRange(slots_for(spark), "key_id", "key_tag").sortWithinPartitions("key_id", "key_tag")
        .withColumn("row_key", F.monotonically_increasing_id()),
        "row-keys",
    )
    same = F.col("id").eqNullSafe(F.col("key_id")) & (F.col("tag") == F.col("key_tag"))
    return tagged.join(keys, same).select(*rows.columns, "row_key")


def ranked(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows`` with ``pos``, gapless from 0 in the given order, sorted by range, so that no group meets in one task.
    Equal rows are dealt out by a number of their own, so many repeats do not either."""
    spread = rows.withColumn("_any", F.monotonically_increasing_id())
    placed = materialise(
        spread.repartitionByRange(slots_for(rows.sparkSession), *order, "_any").sortWithinPartitions(*order, "_any")
        .drop("_any").withColumn("_place", F.monotonically_increasing_id()),
        name,
    )
    slot = F.shiftright("_place", 33)
    # One row for each partition of the exchange above.
    sizes = placed.groupBy(slot.alias("_slot")).agg(F.count("*").alias("_n"))
    before = sizes.select("_slot", (F.sum("_n").over(Window.orderBy("_slot")) - F.col("_n")).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_slot", slot).join(materialise(before, "slots"), "_slot")
        .withColumn("pos", F.col("_before") + inside).select(*rows.columns, "pos")
    )


def numbered(rows: DataFrame, group: str, order: list[str], slot: str) -> DataFrame:
    """``rows`` with ``rank``, gapless from 0 within ``group``, without gathering a group in one task.

    ``slot`` is a column that deals a group's rows out; rows of one (group, slot) are numbered together and
    shifted by the sizes of the slots before. ``rows`` is read twice: pass a materialised table.
    """
    sizes = rows.groupBy(group, slot).agg(F.count("*").alias("_rows"))
    before = sizes.select(
        group,
        slot,
        (F.sum("_rows").over(Window.partitionBy(group).orderBy(slot)) - F.col("_rows")).alias("_before"),
    )
    local = F.row_number().over(Window.partitionBy(group, slot).orderBy(*order)) - 1
    return (
        rows.withColumn("_local", local)
        .join(before, [group, slot])
        .withColumn("rank", (F.col("_before") + F.col("_local")).cast("long"))
        .drop("_before", "_local")
    )
