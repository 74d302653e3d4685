"""Partitioned folders, CSV extracts, and the store of table snapshots."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstay.sources.store import ConflictError, Snapshot, SnapshotStore, Transaction

__all__ = [
    "ConflictError", "Snapshot", "SnapshotStore", "Transaction", "csv_extract", "drop_partitions", "load_all_regions",
    "replace_partitions", "touched_values", "write_by_month",
]


def touched_values(df: DataFrame, column: str) -> list[str]:
    """Partition values that occur in ``df``: at most as many as the table has partitions."""
    names = df.select(F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))).distinct()
    return [r[0] for r in names.collect()]


def write_by_month(df: DataFrame, path: str, column: str = "created_at", month: str = "created_month") -> None:
    """Write a table partitioned by the month of a time column, newest first inside a file.

    Rebalancing brings a month together and cuts a heavy month into several files.
    """
    dated = df.withColumn(month, F.trunc(column, "month"))
    arranged = dated.hint("rebalance", F.col(month)).sortWithinPartitions(F.col(month), F.col(column).desc())
    arranged.write.partitionBy(month).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Overwrite only the partitions that ``df`` has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def drop_partitions(spark: SparkSession, path: str, column: str, drop: Callable[[str], bool]) -> None:
    """Delete the partitions of a folder whose value ``drop`` says yes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(p) if fs.exists(p) else []:
        name = f.getPath().getName()
        if name.startswith(f"{column}=") and drop(unquote(name.split("=", 1)[1])):
            fs.delete(f.getPath(), True)


def csv_extract(df: DataFrame, path: str, order: list | None = None) -> None:
    """Write CSV with a header line, in the given order."""
    rows = df.orderBy(*order) if order else df
    stamps = {
        f.name: F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        for f in df.schema
        if f.dataType.typeName() == "timestamp"
    }
    rows.withColumns(stamps).write.mode("overwrite").option("header", True).csv(path)


def load_all_regions(batch: DataFrame, store: SnapshotStore, table: str) -> DataFrame:
    """Write one batch of all regions at once and report each region's rows and failures.

    ``batch`` may carry ``error`` (NULL = fine): rows of a region with errors are held back, the other
    regions load. This replaces a loop over regions in which one failing region must not stop the rest.
    """
    health = batch.groupBy("region_code").agg(
        F.count(F.lit(1)).alias("records"), F.count("error").alias("errors"), F.max("error").alias("error_message")
    )
    bad = health.where(F.col("errors") > 0).select("region_code")
    good = batch.join(bad, "region_code", "left_anti").drop("error")
    store.write(table, good, "region_code")
    return health.withColumn("sync_status", F.when(F.col("errors") > 0, "failed").otherwise("success"))
