"""Column expressions over texts, for the operators that stay in DataFrame functions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blanks between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "[\\x20\\x09-\\x0D]+"
# Anything in ASCII that is not a lower-case letter or a digit.
NOT_NORMAL = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def pieces(text: Column, separators: str) -> Column:
    """The non-empty pieces of a text between separators; null: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` does that wherever no other letter has a lower case."""
    other = text.rlike("[\\p{IsUppercase}\\p{Lt}&&[^A-Z]]")
    return F.when(other, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


def window_starts(words: Column, width: int) -> Column:
    """1-based starts of all windows of ``width`` words."""
    last = F.size(words) - width + 1
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
