"""Landed response pages to typed records.

A landed page is a row (region_code, page, body): the raw text of one response. Records come out
typed, with ``page`` and ``pos`` as their arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstay.functions.parsing import lenient_timestamp
from fieldstay.functions.times import Clock


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages written as JSON lines of region_code, page and body."""
    return spark.read.schema("region_code string, page long, body string").json(path)


def _envelope(body: Column, element: T.DataType, key: str) -> Column:
    """Elements of a body that is a plain list or an object holding the list under ``key``."""
    as_list = F.from_json(body, T.ArrayType(element))
    as_object = F.from_json(body, T.StructType([T.StructField(key, T.ArrayType(element))]))[key]
    is_list = F.ltrim(body).startswith("[")
    return F.when(is_list, as_list).otherwise(as_object)


def _unreadable(key: str) -> Column:
    """Why the body cannot be read, or NULL."""
    whole = F.try_parse_json("body").isNotNull()
    is_list = F.ltrim("body").startswith("[")
    is_object = F.ltrim("body").startswith("{") & F.coalesce(F.array_contains(F.json_object_keys("body"), key), F.lit(False))
    reason = F.when(F.col("body").isNull() | ~whole, "no JSON: ").when(~(is_list | is_object), "no list: ")
    return F.concat(reason, F.coalesce(F.left("body", F.lit(40)), F.lit("no body")))


def unreadable_pages(pages: DataFrame, key: str = "results") -> DataFrame:
    """(region_code, reason) of pages whose body is missing, is no whole JSON value, or is neither a list nor an object
    with ``key``, such as an error the source answered with."""
    return pages.select("region_code", _unreadable(key).alias("reason")).where(F.col("reason").isNotNull())


def unwrap_pages(pages: DataFrame, schema: T.StructType, key: str = "results") -> DataFrame:
    """One row per record: region_code, page, pos, ``record``."""
    return pages.select(
        "region_code", "page", F.posexplode(_envelope(F.col("body"), schema, key)).alias("pos", "record")
    )


def checked_pages(pages: DataFrame, schema: T.StructType, parents: DataFrame | None = None, key: str = "results") -> DataFrame:
    """:func:`unwrap_pages` of the pages of known ``parents`` (or of all) and :func:`unreadable_pages` of all in one pass:
    region_code, page, reason, pos, ``record``. A page without records has one row, with a NULL ``pos``."""
    records = _envelope(F.col("body"), schema, key)
    if parents is not None:
        pages = pages_of_known_parents(pages, parents, "_known")
        records = F.when(F.col("_known"), records)
    return pages.select("region_code", "page", _unreadable(key).alias("reason"), F.posexplode_outer(records).alias("pos", "record"))


def unwrap_raw(pages: DataFrame, key: str = "results") -> DataFrame:
    """As :func:`unwrap_pages` with each record still as JSON text."""
    return pages.select(
        "region_code", "page", F.posexplode(_envelope(F.col("body"), T.StringType(), key)).alias("pos", "record")
    )


def unwrap_child_pages(pages: DataFrame, schema: T.StructType) -> DataFrame:
    """Sub-record pages (with ``parent_id``): list or ``data`` envelope; pages without a parent id
    are skipped."""
    named = pages.where(F.col("parent_id") != "")
    elements = _envelope(F.col("body"), schema, "data")
    return named.select("region_code", "parent_id", F.posexplode(elements).alias("pos", "record"))


def pages_of_known_parents(pages: DataFrame, parents: DataFrame, mark: str | None = None) -> DataFrame:
    """Pages whose (region_code, parent_id) is a stored parent; with ``mark`` all pages, and true in that column for those."""
    known = parents.select("region_code", F.col("property_id").alias("parent_id"))
    if mark:
        return pages.join(known.distinct().withColumn(mark, F.lit(True)), ["region_code", "parent_id"], "left")
    return pages.join(known, ["region_code", "parent_id"], "left_semi")


def recently_touched(parents: DataFrame, clock: Clock, days: int, updated: str = "updated_at") -> DataFrame:
    """Parents whose children are worth fetching: updated (or else created) in the last ``days``.

    A missing or unreadable time counts as recent; ``days`` of zero or less keeps everything.
    """
    if days <= 0:
        return parents
    text = F.col("created_at")
    if updated in parents.columns:
        text = F.coalesce(F.nullif(F.col(updated), F.lit("")), text)
    at = lenient_timestamp(text)
    return parents.where(at.isNull() | (at >= clock.hours_ago(24 * days)))


def reservation_scope(
    reservations: DataFrame, since, reservation: str | None = None, limit: int | None = None
) -> DataFrame:
    """Reservations arriving or leaving from a date on, latest arrival first; optionally one id, or
    the first ``limit`` (a top-k)."""
    if reservation is not None:
        return reservations.where(F.col("reservation_id") == reservation)
    rows = reservations.where((F.col("checkin_date") >= F.lit(since)) | (F.col("checkout_date") >= F.lit(since)))
    if limit is None:
        return rows
    return rows.orderBy(F.col("checkin_date").desc_nulls_last(), F.col("reservation_id").asc()).limit(limit)


def since_last_success(records: DataFrame, status: DataFrame, entity: str, updated: str = "updated_at") -> DataFrame:
    """Records updated after their region's last success of this entity; all of them where the
    region never succeeded."""
    last = (
        status.where(F.col("entity_type") == entity)
        .groupBy("region_code")
        .agg(F.max("last_successful_sync_at").alias("_last"))
    )
    kept = records.join(last, "region_code", "left").where(F.col("_last").isNull() | (F.col(updated) > F.col("_last")))
    return kept.drop("_last")
