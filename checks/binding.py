"""Domain tables derived from the given tables (see FIXTURES.md section 2)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstay.functions.times import Clock
from fieldstay.operators.runlog import latest_status
from fieldstay.session import scratch_path, tune
from fieldstay.sources.snapshot import write_by_month

CLOCK = Clock(datetime(2001, 7, 15, 12, 0, 0))
EVENT_CLOCK = Clock(datetime(2024, 1, 31, 0, 0, 0))


def int_div(c: str, n: int) -> Column:
    return F.floor(F.col(c) / n)


class Domain(Mapping):
    """Lazy mapping of domain table name to DataFrame over one directory of test tables.

    The domain's tables are stored tables. Most of those that take a join or an aggregate to derive are
    written once per application into the shared folder, tasks by month of creation, and read from
    there by every query that follows. The two with a row per line item are derived where they are read,
    so that only the columns a query reads are shuffled.
    """

    NAMES = (
        "regions properties tasks reservations task_assignments task_requirements tags task_tags"
        " people change_events runs property_photos sync_status"
    ).split()
    STORED = "properties tasks reservations tags task_tags change_events runs sync_status".split()
    # Results of an aggregate, which its exchange has dealt out already.
    GROUPED = "tags task_tags runs sync_status".split()
    _written: dict[tuple[str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def raw(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoned}) if zoned else df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return self.stored(name) if name in self.STORED else getattr(self, name)

    def stored(self, name: str) -> DataFrame:
        """The table as written by the first query of this application that needed it."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in self._written:
            df, path = getattr(self, name), scratch_path(self.spark, name)
            if name == "tasks":
                write_by_month(df, path)
            else:
                (df if name in self.GROUPED else self._spread(df)).write.parquet(path)
            self._written[key] = self.spark.read.parquet(path)
        return self._written[key]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _spread(self, df: DataFrame) -> DataFrame:
        """Inputs may come as one file with one row group: deal them out over the shuffle partitions."""
        return df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    @cached_property
    def regions(self) -> DataFrame:
        return self.raw("region").select(
            F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("region_code"),
            F.col("r_name").alias("region_name"),
            F.lit(True).alias("is_active"),
            (F.col("r_regionkey") + 100).cast("bigint").alias("company_id"),
        )

    @cached_property
    def properties(self) -> DataFrame:
        nations = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        latitude = F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal") / 200)
        return (
            self.raw("customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id"),
                F.col("c_custkey").cast("string").alias("property_id"),
                F.col("c_name").alias("property_name"),
                F.col("n_name").alias("property_city"),
                F.lower(F.replace("r_name", F.lit(" "), F.lit("_"))).alias("region_code"),
                F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("property_status"),
                latitude.alias("latitude_numeric"),
                (-latitude).alias("longitude_numeric"),
                F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("wifi_name"),
            )
        )

    @cached_property
    def tasks(self) -> DataFrame:
        k, cust = F.col("o_orderkey"), F.col("property_pk")
        micros = F.unix_micros("o_orderdate") + (k % 1440) * 60_000_000
        begun = micros + (k % 97) * 3_600_000_000
        done = F.col("o_orderstatus") == "F"
        worker = int_div("o_orderkey", 9) % 20
        # The orders' own columns are joined; what is derived from them is not shuffled.
        orders = self.raw("orders").select(
            "o_orderkey", F.col("o_custkey").alias("property_pk"), "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice"
        )
        placed = orders.join(self["properties"].select(F.col("id").alias("property_pk"), "region_code"), "property_pk")
        return placed.select(
            "property_pk",
            k.alias("id"),
            k.cast("string").alias("task_id"),
            F.concat(F.lit("Task "), k.cast("string")).alias("task_name"),
            F.timestamp_micros(micros).alias("created_at"),
            F.when(done, "finished").when(F.col("o_orderstatus") == "O", "new")
            .otherwise("in_progress").alias("task_status_stage"),
            F.when(F.col("o_orderpriority").startswith("1"), "urgent")
            .when(F.col("o_orderpriority").startswith("2"), "high")
            .when(F.col("o_orderpriority").startswith("3"), "normal")
            .when(F.col("o_orderpriority").startswith("4"), "watch")
            .otherwise("low").alias("type_priority"),
            F.when(int_div("o_orderkey", 3) % 3 == 0, "housekeeping")
            .when(int_div("o_orderkey", 3) % 3 == 1, "inspection")
            .otherwise("maintenance").alias("type_department"),
            F.when(F.col("o_orderstatus").isin("F", "P") & (k % 7 != 0), F.timestamp_micros(begun)).alias("started_at"),
            F.when(done, F.timestamp_micros(begun + (F.lit(20) + cust % 240) * 60_000_000)).alias("finished_at"),
            F.when(done, worker.cast("string")).alias("finished_by_id"),
            F.when(done, F.concat(F.lit("Worker "), worker.cast("string"))).alias("finished_by_name"),
            F.date_add(F.timestamp_micros(micros).cast("date"), (k % 5).cast("int")).alias("scheduled_date"),
            F.col("o_orderdate").cast("date").alias("checkin_date"),
            F.date_add(F.col("o_orderdate").cast("date"), (1 + k % 6).cast("int")).alias("checkout_date"),
            F.when(k % 3 == 0, k).when(k % 3 == 1, k - 1).alias("reservation_pk"),
            # A thousandth of the price, cut to cents on whole numbers: no rounding tie can differ.
            F.when(k % 4 != 0, (F.floor(F.round(F.col("o_totalprice") * 100) / 1000).cast("decimal(15,2)") / 100)
                   .cast("decimal(15,2)")).alias("rate_paid"),
            "region_code",
        )

    @cached_property
    def reservations(self) -> DataFrame:
        k = F.col("o_orderkey")
        orders = self.raw("orders").where(k % 3 == 0).select(
            k.alias("id"),
            k.cast("string").alias("reservation_id"),
            F.col("o_custkey").alias("property_pk"),
            F.col("o_orderdate").cast("date").alias("checkin_date"),
            F.date_add(F.col("o_orderdate").cast("date"), (1 + k % 6).cast("int")).alias("checkout_date"),
            F.lit("15:00").alias("checkin_time"),
            F.when(k % 10 != 0, "11:00").alias("checkout_time"),
            F.when(k % 11 == 0, "cancelled").otherwise("active").alias("reservation_status"),
            F.when(k % 4 == 0, 1).otherwise(0).alias("pets"),
            F.when(k % 9 == 0, F.col("o_custkey").cast("string")).alias("access_code"),
            F.lit(None).cast("string").alias("guide_url"),
        )
        return orders.join(
            self["properties"].select(F.col("id").alias("property_pk"), "region_code"), "property_pk"
        )

    @cached_property
    def task_assignments(self) -> DataFrame:
        k = F.col("o_orderkey")
        worker = (int_div("o_orderkey", 9) % 20).cast("string")
        return self.raw("orders").where(k % 2 == 0).select(
            k.alias("id"),
            k.alias("task_pk"),
            worker.alias("assignee_id"),
            F.when(k % 10 != 0, F.concat(F.lit("Worker "), worker)).alias("assignee_name"),
        )

    @cached_property
    def task_requirements(self) -> DataFrame:
        """One row per line item; duplicates of (task, requirement) are natural."""
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("section_name"))
        return self.raw("lineitem").join(parts, "l_partkey", "left").select(
            F.col("l_orderkey").alias("task_pk"),
            F.col("l_linenumber").cast("string").alias("requirement_id"),
            "section_name",
            F.when(F.col("l_returnflag") == "A", "ok").when(F.col("l_returnflag") == "N", "").alias("response"),
            (F.col("l_linestatus") == "F").alias("photo_required"),
            F.when(F.col("l_quantity") < 10, "[]").when(F.col("l_quantity") <= 45, '["p"]').alias("photos"),
            F.struct(*LINE_ORDER).alias("arrival"),
        )

    @cached_property
    def tags(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_brand").alias("id"), F.col("p_brand").alias("tag_name"), F.lit("all").alias("region_code")
        ).distinct()

    @cached_property
    def task_tags(self) -> DataFrame:
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag_pk"))
        return (
            self.raw("lineitem").join(parts, "l_partkey")
            .select(F.col("l_orderkey").alias("task_pk"), "tag_pk").distinct()
        )

    @cached_property
    def people(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").cast("string").alias("person_id"),
            F.col("s_name").alias("person_name"),
            (F.col("s_acctbal") >= 0).alias("active"),
            F.when(F.col("s_suppkey") % 3 == 0, "09:00-17:00").alias("availability_monday"),
            F.when(F.col("s_suppkey") % 4 == 0, "09:00-17:00").alias("availability_tuesday"),
        )

    @cached_property
    def property_photos(self) -> DataFrame:
        """Line items stand for photos: (part, property of the order)."""
        orders = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("property_pk"))
        return self.raw("lineitem").join(orders, "l_orderkey").select(
            "property_pk",
            (F.col("l_partkey") % 50).cast("string").alias("photo_id"),
            F.struct("l_orderkey", *LINE_ORDER).alias("arrival"),
        )

    @cached_property
    def change_events(self) -> DataFrame:
        """Task events as the receiver sees them: a JSON payload and a receive time."""
        kind, k = F.col("event_type"), F.col("event_id")
        company = F.when(k % 4 != 0, F.col("user_id") % 5 + 100)
        status = (
            F.when(kind == "signup", "created").when(kind == "view", "seen")
            .when(kind == "click", "").when(kind == "purchase", "completed")
        )
        action = (
            F.when(kind == "signup", "task-created").when(kind == "purchase", "task-completed")
            .when(kind == "error", "task-deleted").otherwise("task-updated")
        )
        stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        task = F.struct(
            (F.col("user_id") * 100).alias("id"),
            company.alias("company_id"),
            status.alias("status"),
            F.when(kind == "click", stamp).alias("started_at"),
            F.when(kind == "purchase", stamp).alias("finished_at"),
        )
        return self.raw("events").select(
            "event_id",
            F.col("ts").alias("received_at"),
            F.to_json(F.struct(action.alias("event_type"), task.alias("task"))).alias("payload"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Run history: one row per user and day of events (region = user mod 8, entity = user mod 10)."""
        day = F.date_trunc("day", "ts")
        start, end = F.min("ts"), F.max("ts")
        failed = F.count_if(F.col("event_type") == "error") > 0
        return (
            self.raw("events").groupBy("user_id", day.alias("day"))
            .agg(
                start.alias("sync_started_at"), end.alias("sync_completed_at"),
                F.count(F.lit(1)).alias("records_processed"),
                F.count_if(F.col("event_type") == "signup").alias("records_new"),
                F.count_if(F.col("event_type") == "view").alias("api_calls_made"),
                failed.alias("_failed"),
            )
            .select(
                F.concat(F.lit("r"), (F.col("user_id") % 8).cast("string")).alias("region_code"),
                F.concat(F.lit("entity_"), (F.col("user_id") % 10).cast("string")).alias("entity_type"),
                F.when(F.col("_failed"), "failed").when(F.col("records_processed") == 1, "running")
                .otherwise("success").alias("sync_status"),
                "sync_started_at", "sync_completed_at",
                F.when(~F.col("_failed"), F.col("sync_completed_at")).alias("last_successful_sync_at"),
                "records_processed", "records_new", "api_calls_made",
                F.when(F.col("_failed"), "error event").alias("error_message"),
            )
        )

    @cached_property
    def sync_status(self) -> DataFrame:
        """The newest run of each region and entity."""
        return latest_status(self["runs"])


# The order that makes line items total: no two are equal in all of these.
LINE_ORDER = (
    "l_linenumber l_partkey l_suppkey l_shipdate l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus"
).split()
