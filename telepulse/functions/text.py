"""Text of messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"
# What a message shows for a required field that is not there.
ABSENT = "undefined"


def or_not_available(value: Column, missing: str = NOT_AVAILABLE) -> Column:
    """``missing`` for NULL and for empty text."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(missing))


def or_absent(value: Column) -> Column:
    return F.coalesce(value, F.lit(ABSENT))


def joined(items: Column, line: Callable[[Column], Column], separator: str, missing: str) -> Column:
    """One line per array element, joined; ``missing`` for none."""
    return or_not_available(F.array_join(F.transform(items, line), separator), missing)


def escape_html(value: Column) -> Column:
    value = F.replace(value, F.lit("&"), F.lit("&amp;"))
    value = F.replace(value, F.lit("<"), F.lit("&lt;"))
    return F.replace(value, F.lit(">"), F.lit("&gt;"))


def dimension_key(dimensions: Column) -> Column:
    """A map of dimensions as sorted ``name=value`` text, usable as a key."""
    pairs = F.transform(
        F.array_sort(F.map_entries(dimensions)),
        lambda pair: F.concat(pair["key"], F.lit("="), pair["value"]),
    )
    return F.array_join(pairs, ",")
