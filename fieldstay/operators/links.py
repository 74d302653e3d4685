"""Reservation-task link rows, folded requirements and blocking counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldstay.functions.parsing import amount, lenient_timestamp, non_empty
from fieldstay.operators.ranking import positions
from fieldstay.session import durable

_STATUS = "struct<code string, name string, stage string>"
LINK_SCHEMA = (
    "id string, home_id string, name string, description string, type_department string, type_priority string,"
    f" type_task_status {_STATUS}, scheduled_date string, scheduled_time string, created_at string,"
    " started_at string, finished_at string, paused boolean, rate_type string, rate_paid string,"
    " total_time string, template_id string, reference_property_id string, report_url string,"
    " assignments string, supplies string, costs string, tags string, task_tags string"
)

# Fields of a folded requirement.
FOLDED = "requirement_id section_name action response type_requirement photo_required note home_element_name".split()


LINK_KEY = ("reservation_id", "task_id", "region_code")


def link_records(tasks: DataFrame) -> DataFrame:
    """(region_code, reservation_id, task_id, record) of the objects that :func:`link_rows` makes rows of: the key is read,
    the rest of the object stays text."""
    key = F.from_json("record", "id string")["id"].alias("task_id")
    rows = tasks.select("region_code", F.col("reservation_id").cast("string").alias("reservation_id"), key, "record")
    return rows.where(F.col("task_id").isNotNull())


def link_rows(tasks: DataFrame, synced_at: Column, carried: Sequence[str] = ()) -> DataFrame:
    """Link rows from (region_code, reservation_id, ``record`` JSON text); lists default to ``[]``,
    the whole object is kept as ``raw_payload``, objects without an id are skipped. ``carried`` columns come along."""
    t = tasks.withColumn("t", F.from_json("record", LINK_SCHEMA)).where(F.col("t.id").isNotNull())

    def plain(*names: str) -> list[Column]:
        return [F.col(f"t.{n}").alias(n) for n in names]

    def listed(name: str) -> Column:
        return F.coalesce(F.col(f"t.{name}"), F.lit("[]")).alias(name)

    def moment(name: str, alias: str) -> Column:
        return lenient_timestamp(F.col(f"t.{name}")).alias(alias)

    return t.select(
        "region_code",
        F.col("reservation_id").cast("string").alias("reservation_id"),
        F.col("t.id").alias("task_id"),
        *plain("home_id"),
        F.col("t.name").alias("task_name"),
        F.col("t.description").alias("task_description"),
        *plain("type_department", "type_priority"),
        *[F.col(f"t.type_task_status.{n}").alias(f"task_status_{n}") for n in ("code", "name", "stage")],
        F.col("t.scheduled_date").try_cast("date").alias("scheduled_date"),
        non_empty(F.col("t.scheduled_time")).alias("scheduled_time"),
        moment("created_at", "task_created_at"),
        moment("started_at", "started_at"),
        moment("finished_at", "finished_at"),
        *plain("paused", "rate_type"),
        amount(F.col("t.rate_paid")).cast("decimal(15,2)").alias("rate_paid"),
        F.col("t.total_time").try_cast("int").alias("total_time"),
        *plain("template_id"),
        non_empty(F.col("t.reference_property_id")).alias("reference_property_id"),
        *plain("report_url"),
        *[listed(n) for n in ("assignments", "supplies", "costs", "tags", "task_tags")],
        F.col("record").alias("raw_payload"),
        synced_at.alias("synced_at"),
        *carried,
    )


# Entries of a task that are put in order as one list; a task with more is numbered by ranges.
LISTED = 10_000


def fold_requirements(requirements: DataFrame, part_rows: int = 10_000) -> DataFrame:
    """Requirements of a task as ordered JSON lists: (task_pk, part, requirements).

    Entries are in (section, id) order, NULLs last. A list holds at most ``part_rows`` entries; a
    larger task continues in further parts, so nothing is dropped and no list grows without bound.

    Which tasks have more than ``LISTED`` entries, or than a part, is counted first, combined before the exchange; there
    are at most one in ``LISTED`` rows. The others come together by one exchange and are cut into parts there; only the
    large tasks, if there are any, are numbered.
    """
    order = ["section_name", *[c for c in FOLDED if c != "section_name"]]
    entries = requirements.select("task_pk", *FOLDED)
    most = max(part_rows, LISTED)
    large = durable(entries.groupBy("task_pk").count().where(F.col("count") > most).select(F.col("task_pk").alias("_large")))
    if large.isEmpty():
        return _listed_parts(entries, order, part_rows)
    same = F.col("task_pk").eqNullSafe(F.col("_large"))
    numbered = positions(entries.join(large, same, "left_semi"), ["task_pk"], order, "_pos")
    parts = (
        numbered.groupBy("task_pk", F.floor(F.col("_pos") / part_rows).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("_pos", F.struct(*FOLDED).alias("r")))).alias("_l"))
        .select("task_pk", "part", F.to_json(F.transform("_l", lambda e: e["r"])).alias("requirements"))
    )
    return _listed_parts(entries.join(large, same, "left_anti"), order, part_rows).unionByName(parts)


def _listed_parts(entries: DataFrame, order: list[str], part_rows: int) -> DataFrame:
    """The parts of tasks whose entries fit in one list."""
    # Structs are ordered with NULLs first: a flag before each column brings them last.
    place = F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"_null_{name}"), F.col(name))])
    numbers = F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / part_rows).cast("int"))
    cut = F.transform(numbers, lambda n: F.struct(n.alias("part"), F.slice("_l", n * part_rows + 1, F.lit(part_rows)).alias("_p")))
    return (
        entries.groupBy("task_pk").agg(F.array_sort(F.collect_list(place)).alias("_l"))
        .select("task_pk", F.inline(cut))
        .select("task_pk", "part", F.to_json(F.transform("_p", lambda e: F.struct(*[e[c].alias(c) for c in FOLDED]))).alias("requirements"))
    )


SUB_STATUS = T.ArrayType(
    T.StructType(
        [
            T.StructField("is_blocking", T.BooleanType()),
            T.StructField(
                "tasks", T.ArrayType(T.StructType([T.StructField("is_blocking", T.BooleanType())]))
            ),
        ]
    )
)


def count_blocking(sub_statuses: Column) -> Column:
    """Blocking entries of a sub-status list plus blocking tasks inside them; zero without a list."""

    def truths(entries: Column) -> Column:
        return F.size(F.filter(entries, lambda e: F.coalesce(e["is_blocking"], F.lit(False))))

    inner = F.flatten(F.transform(sub_statuses, lambda s: F.coalesce(s["tasks"], F.array())))
    return F.coalesce(truths(sub_statuses) + truths(inner), F.lit(0))
