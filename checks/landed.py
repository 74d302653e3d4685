"""Landed JSON pages derived from the given tables, for the transform and source checks.

Each customer (property) or order (task) becomes the body of one page, so no page gathers rows.
Even keys use a plain list, odd keys an envelope object. Every fiftieth record appears twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.binding import Domain


def _json(text: Column) -> Column:
    return F.parse_json(text)


def _items(count: Column, build) -> Column:
    """Array of ``count`` structs built from 1..count."""
    numbers = F.when(count > 0, F.sequence(F.lit(1).cast("long"), count.cast("long"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.transform(numbers, build)


def _page(key: Column, record: Column, twin: Column, envelope: str = "results") -> Column:
    single = F.concat(F.lit("["), record, F.lit("]"))
    double = F.concat(F.lit("["), record, F.lit(","), twin, F.lit("]"))
    wrapped = F.concat(F.lit(f'{{"{envelope}":'), single, F.lit("}"))
    return F.when(key % 50 == 0, double).when(key % 2 == 0, single).otherwise(wrapped)


def pick(key: Column, *choices: str) -> Column:
    """JSON text chosen by key modulo the number of choices."""
    out = F.when(F.lit(False), F.lit(""))
    for i, c in enumerate(choices):
        out = out.when(key % len(choices) == i, c)
    return out


def property_pages(d: Domain) -> DataFrame:
    k = F.col("id")

    def record(name: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("property_id").alias("id"),
                _json(pick(k, "0", '"101"', "102", '"x"')).alias("company_id"),
                name.alias("name"),
                F.when(k % 13 != 0, F.col("property_status")).alias("status"),
                F.col("property_city").alias("city"),
                _json(pick(k, '""', '"n/a"', "0", '"0"', '"12.5"', "-7.25")).alias("latitude"),
                (k % 2 == 0).alias("display"),
                (k % 5).alias("bedrooms"),
                F.when(k % 3 != 0, F.struct(
                    F.concat(F.lit("about "), F.col("property_id")).alias("about"),
                    F.col("wifi_name").alias("wifi"),
                )).alias("notes"),
                F.when(k % 10 != 9, _items(k % 4, lambda i: F.struct(
                    (k * 10 + i).alias("id"),
                    F.concat(F.lit("photo "), i.cast("string")).alias("caption"),
                    F.when(i == 1, True).alias("default"),
                    F.concat(F.lit("u/"), i.cast("string")).alias("url"),
                ))).alias("photos"),
            )
        )

    twin = F.concat("property_name", F.lit(" copy"))
    return d["properties"].select(
        "region_code", k.alias("page"), _page(k, record(F.col("property_name")), record(twin)).alias("body")
    )


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def task_record(name: Column) -> Column:
    k = F.col("id")
    return F.to_json(
        F.struct(
            k.alias("id"),
            F.col("property_pk").alias("home_id"),
            name.alias("name"),
            F.when(k % 41 == 0, "not a date").when(k % 43 != 0, _iso("created_at")).alias("created_at"),
            _iso("finished_at").alias("finished_at"),
            F.col("type_department").alias("type_department"),
            F.col("type_priority").alias("type_priority"),
            F.col("scheduled_date").cast("string").alias("scheduled_date"),
            _json(pick(k, '"50.25 USD"', '"abc"', "0", '"0.00 USD"', "null", "12.5", '""')).alias("rate_paid"),
            F.when(k % 17 != 0, F.struct(
                F.lit("c1").alias("code"), F.col("task_status_stage").alias("stage"),
            )).alias("type_task_status"),
            F.when(F.col("finished_by_id").isNotNull(), F.struct(
                F.col("finished_by_id").alias("id"), F.col("finished_by_name").alias("name"),
            )).alias("finished_by"),
            F.when(k % 3 == 1, F.struct((k - 1).alias("id"))).alias("linked_reservation"),
            _items(k % 3, lambda i: F.struct(
                F.when(i == 1, (k + i) % 20).alias("assignee_id"),
                F.concat(F.lit("W"), i.cast("string")).alias("name"),
            )).alias("assignments"),
            _items(k % 2, lambda i: F.struct((k * 10 + i).alias("id"), F.lit("u").alias("url"))).alias("photos"),
            _items(k % 3, lambda i: F.struct(
                F.when(i == 1, F.concat(F.lit("Brand#"), (k % 30).cast("string"))).otherwise("").alias("id")
            )).alias("task_tags"),
            _items(k % 2, lambda i: F.struct(
                (k * 100 + i).alias("id"), F.lit("soap").alias("name"),
                _json(pick(k, '"2.5"', "3", '"many"', "null")).alias("quantity"),
                _json(pick(k, "1", '""', "4.75")).alias("unit_cost"),
                (k % 4 == 1).alias("billable"),
            )).alias("supplies"),
            _items(k % 3, lambda i: F.struct(
                (k * 100 + i).alias("id"), _json(pick(k, "10.5", '"7"', '"bad"', "0")).alias("cost"),
                F.when(i == 1, F.struct(i.alias("id"), F.lit("labor").alias("code"))).alias("type_cost"),
            )).alias("costs"),
        )
    )


def task_pages(d: Domain) -> DataFrame:
    k = F.col("id")
    twin = F.concat("task_name", F.lit(" copy"))
    return d["tasks"].select(
        "region_code", k.alias("page"),
        _page(k, task_record(F.col("task_name")), task_record(twin)).alias("body"),
        F.col("property_pk").cast("string").alias("parent_id"),
    )


def guest_pages(d: Domain) -> DataFrame:
    """Reservations with a guest list in which some guests carry nothing."""
    k = F.col("id")
    record = F.to_json(F.struct(
        F.col("reservation_id").alias("id"),
        _items(k % 4, lambda i: F.struct(
            F.when((k + i) % 3 == 0, F.concat(F.lit("G"), i.cast("string"))).alias("name"),
            F.when((k + i) % 3 == 1, F.lit("g@example.org")).alias("email"),
            F.when(i == 1, True).alias("primary"),
        )).alias("guests"),
    ))
    return d["reservations"].select("region_code", k.alias("page"), _page(k, record, record).alias("body"))


def _child_page(key: Column, items: Column) -> Column:
    body = F.to_json(items)
    return F.when(key % 2 == 0, body).otherwise(F.concat(F.lit('{"data":'), body, F.lit("}")))


def _parent(key: Column) -> Column:
    return F.when(key % 29 == 0, "").otherwise(key.cast("string")).alias("parent_id")


def comment_pages(d: Domain) -> DataFrame:
    k = F.col("id")
    items = _items(k % 3, lambda i: F.struct(
        (k * 10 + i).alias("id"), F.concat(F.lit("note "), i.cast("string")).alias("comment"),
        F.when(i == 1, F.struct(F.lit(7).alias("id"), F.lit("Ann").alias("name"))).alias("author"),
        _iso("created_at").alias("created_at"),
    ))
    return d["tasks"].select("region_code", _parent(k), _child_page(k, items).alias("body"))


def requirement_pages(d: Domain) -> DataFrame:
    k = F.col("id")
    items = _items(k % 3, lambda i: F.struct(
        (k * 10 + i).alias("id"), F.concat(F.lit("S"), (i % 2).cast("string")).alias("section_name"),
        _json(pick(k, "[]", "{}", '{"a":1}', '"x"', "null", '["a","b"]', "0")).alias("action"),
        F.lit("ok").alias("response"), F.lit("check").alias("type"), (k % 2 == 0).alias("photo_required"),
        _json(pick(k, '["p"]', "[]", "null")).alias("photos"),
    ))
    return d["tasks"].select("region_code", _parent(k), _child_page(k, items).alias("body"))


def contact_pages(d: Domain) -> DataFrame:
    k = F.col("id")
    items = _items(k % 3, lambda i: F.struct(
        (k * 10 + i).alias("id"), F.lit("owner").alias("type"), F.concat(F.lit("C"), i.cast("string")).alias("name"),
    ))
    return d["properties"].select("region_code", k.cast("string").alias("parent_id"), _child_page(k, items).alias("body"))
