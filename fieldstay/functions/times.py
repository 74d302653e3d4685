"""Time expressions. Every "now" is an explicit :class:`Clock`."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000


@dataclass(frozen=True)
class Clock:
    """The moment a query is evaluated at (UTC)."""

    now: datetime

    @property
    def today(self) -> date:
        return self.now.date()

    def timestamp(self) -> Column:
        return F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def date(self) -> Column:
        return F.lit(self.today)

    def days_ago(self, n: int) -> Column:
        """Midnight ``n`` days before today, as a timestamp literal that reaches the scan."""
        return F.lit(str(self.today - timedelta(days=n))).cast("timestamp")

    def date_ago(self, n: int) -> Column:
        return F.lit(self.today - timedelta(days=n))

    def hours_ago(self, n: int) -> Column:
        moment = self.now - timedelta(hours=n)
        return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def months_ago(self, n: int) -> Column:
        """Today's date ``n`` calendar months back, at midnight."""
        return F.add_months(self.date(), -n).cast("timestamp")

    def week_start(self) -> date:
        return self.today - timedelta(days=self.today.weekday())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact microseconds from start to end as a long."""
    return F.unix_micros(col(end)) - F.unix_micros(col(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end).cast("double") / MICROS_PER_HOUR


def minutes_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end).cast("double") / MICROS_PER_MINUTE


def avg_micros(micros: Column, unit: int) -> Column:
    """Mean of whole microseconds, scaled afterwards.

    Whole numbers add without rounding in a double up to 2**53, so at ordinary sizes the result
    does not depend on the order in which partitions are merged.
    """
    return F.avg(micros.cast("double")) / unit


def on_day(d: Column | str, hhmm: Column | str) -> Column:
    """Timestamp of a date plus an ``HH:mm`` text."""
    return F.to_timestamp(F.concat_ws(" ", col(d).cast("string"), col(hhmm)), "yyyy-MM-dd HH:mm")


def hour_field(start: Column, end: Column) -> Column:
    """The hour field of the interval between two times; whole days are dropped."""
    seconds = F.floor(micros_between(start, end) / 1_000_000)
    return F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("long")
