"""Lenient text parsing: a value that cannot be read becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _numeric_zero(value: Column) -> Column:
    """True for a JSON number equal to zero; a quoted zero is text and counts as a value."""
    return (F.schema_of_variant(value) != "STRING") & (F.try_variant_get(value, "$", "double") == 0)


def coordinate(value: Column) -> Column:
    """JSON value to double; empty or unreadable text and the number zero are NULL."""
    return F.when(_numeric_zero(value), None).otherwise(_text(value).try_cast("double"))


def whole_id(value: Column) -> Column:
    """JSON value to long, with the same rule for zero; fractions are cut from numbers only."""
    whole = F.when(F.schema_of_variant(value) == "STRING", _text(value).try_cast("bigint")).otherwise(
        F.try_variant_get(value, "$", "double").try_cast("bigint")
    )
    return F.nullif(whole, F.when(_numeric_zero(value), F.lit(0)))


def whole_number(text: Column, kind: str) -> Column:
    """``"4"``, ``4`` and ``2.0`` to a whole number of type ``kind``; fractions and other text are NULL."""
    exact = F.trim(text).try_cast("decimal(38, 9)")
    return F.when(exact == F.floor(exact), exact).try_cast(kind)


def amount(text: Column) -> Column:
    """Amount in front of a currency suffix: ``"120.00 USD"`` -> 120.0. Zero is an amount."""
    return F.try_element_at(F.split(F.trim(text), r"\s+"), F.lit(1)).try_cast("double")


def currency(value: Column) -> Column:
    """JSON value to an amount: text as in :func:`amount`, a number as it is, the number zero NULL."""
    return F.when(_numeric_zero(value), None).otherwise(amount(_text(value)))


def lenient_timestamp(text: Column) -> Column:
    """ISO-8601 text, ``Z`` or offset or neither; NULL if unreadable."""
    return text.try_cast("timestamp")


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def id_text(value: Column) -> Column:
    """An id as text; a missing or null id is the empty string."""
    return F.coalesce(value.cast("string"), F.lit(""))
