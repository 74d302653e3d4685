"""Named checks: a Spark query and, where SQL can say the same, a DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.binding import Domain
from checks.domain_sql import with_domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: longs, doubles, text dates and times, arrays as JSON text."""
    out = []
    for f in df.schema:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType | T.FloatType):
            c = c.cast("double")
        elif isinstance(t, T.IntegerType | T.ShortType | T.ByteType):
            c = c.cast("long")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.ArrayType | T.StructType | T.MapType):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def check(name: str, query: Callable[[Domain], DataFrame], tables: str = "", sql: str | None = None):
    """Register ``query`` over the domain tables; ``sql`` sees the domain ``tables`` it names."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(Domain(spark, sf_dir)))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = with_domain(tables, sql)


# Contents as figures --------------------------------------------------------------------------


def contents(name: str, df: DataFrame) -> DataFrame:
    """One row a column of a portable frame: its rows, values that are not NULL, and the sum of 28 bits of a hash of
    each value, doubles to six digits."""
    made = portable(df)

    def printed(f: T.StructField):
        c = F.col(f"`{f.name}`")
        return c.cast("decimal(28,6)").cast("string") if isinstance(f.dataType, T.DoubleType) else c.cast("string")

    def figures(f: T.StructField):
        bits = F.conv(F.substring(F.md5(printed(f).cast("binary")), 1, 7), 16, 10).cast("long")
        return F.struct(F.lit(f.name).alias("column_name"), F.count(printed(f)).alias("filled"), F.coalesce(F.sum(bits), F.lit(0)).alias("content"))

    row = made.agg(F.count(F.lit(1)).alias("view_rows"), F.array(*[figures(f) for f in made.schema]).alias("columns"))
    # A view without rows has no values to list.
    return row.where("view_rows > 0").select(F.lit(name).alias("view_name"), "view_rows", F.inline("columns"))


def contents_sql(name: str, sql: str) -> str:
    """The same of a statement's result."""
    printed = "CASE WHEN typeof(COLUMNS(*)) = 'DOUBLE' THEN CAST(TRY_CAST(COLUMNS(*) AS DECIMAL(28, 6)) AS VARCHAR) ELSE CAST(COLUMNS(*) AS VARCHAR) END"
    known = "v <> 'no value'"
    return f"""SELECT '{name}' AS view_name, count(*) AS view_rows, column_name, {cnt(known)} AS filled,
 CAST(coalesce(sum(CAST('0x' || left(md5(v), 7) AS BIGINT)) FILTER (WHERE {known}), 0) AS BIGINT) AS content
FROM (UNPIVOT (SELECT coalesce({printed}, 'no value') FROM ({sql})) ON COLUMNS(*) INTO NAME column_name VALUE v) GROUP BY column_name"""


# SQL fragments ---------------------------------------------------------------------------------


def rnd(x: str, digits: int = 1) -> str:
    """Half away from zero on a decimal, as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 8)), {digits}) AS DOUBLE)"


def div(num: str, den: str, digits: int = 1, scale: str = "1") -> str:
    return rnd(f"(CAST({num} AS DOUBLE) * {scale} / nullif(CAST({den} AS DOUBLE), 0))", digits)


def pct(num: str, den: str) -> str:
    return div(num, den, 1, "100")


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"
