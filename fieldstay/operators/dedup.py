"""Duplicate reports, de-duplication and its verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstay.operators.ranking import first_per_key
from fieldstay.plans.common import count_all, side_by_side


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Copies of each key. NULL parts count as equal, so a key with NULLs is a key."""
    return df.groupBy(*keys).agg(count_all().alias("copies"))


def _totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: total rows, distinct keys, surplus rows. Copies are counted before they meet."""
    total, unique = F.coalesce(F.sum("copies"), F.lit(0)), count_all()
    return key_counts(df, keys).agg(
        total.alias("total_records"), unique.alias("unique_records"), (total - unique).alias("duplicates")
    )


def duplicate_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Total, unique and duplicate rows of several tables, one line each."""
    lines = [
        _totals(df, keys).select(F.lit(name).alias("table_name"), "total_records", "unique_records", "duplicates")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.union, lines)


def duplicates_side_by_side(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The duplicate count of each table as one column of one row."""
    return side_by_side(
        *[_totals(df, keys).select(F.col("duplicates").alias(f"{n}_duplicates")) for n, (df, keys) in tables.items()]
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the lowest in ``order``."""
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the highest in ``order``."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first_blank_as_null(
    df: DataFrame, keys: Sequence[str], blank_keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """As :func:`keep_first`, with NULL and empty text the same in ``blank_keys``."""
    masks: dict[str, Column] = {f"_k_{c}": F.coalesce(c, F.lit("")) for c in blank_keys}
    plain = [k for k in keys if k not in blank_keys]
    kept = keep_first(df.withColumns(masks), [*plain, *masks], order)
    return kept.drop(*masks)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty in a clean table."""
    return key_counts(df, keys).where(F.col("copies") > 1)


def dedup_verification(original: DataFrame, backup: DataFrame, kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of counts: the backup must equal the original and the kept rows its distinct keys."""
    before = _totals(original, keys).select(
        F.col("total_records").alias("original_rows"), F.col("unique_records").alias("distinct_keys")
    )
    counts = side_by_side(
        before, backup.agg(count_all().alias("backup_rows")), kept.agg(count_all().alias("kept_rows"))
    )
    return counts.withColumn(
        "verified",
        (F.col("backup_rows") == F.col("original_rows")) & (F.col("kept_rows") == F.col("distinct_keys")),
    )


def assert_dedup(original: DataFrame, backup: DataFrame, kept: DataFrame, keys: Sequence[str]) -> None:
    """Raise unless the verification holds."""
    row = dedup_verification(original, backup, kept, keys).first()
    if not row["verified"]:
        raise ValueError(f"deduplication check failed: {row.asDict()}")
