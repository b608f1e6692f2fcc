"""Rounding, division and averages that depend on no order of rows.

Readings are added up as decimals, so an average is the same however rows were
dealt to tasks, and partial sums of a rollup add up to the sum of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(27,6)"
AVERAGE = "decimal(22,1)"  # of averages with one place


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half away from zero on the decimal digits it is shown with, so 1.005 gives 1.01."""
    return F.round(value.cast("double"), digits)


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole in percent, NULL for an empty whole."""
    return round_half_up(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), digits)


def exact(value: Column | str) -> Column:
    """A reading as a decimal with six places; NULL where it is none (NaN, or 10^21 and more)."""
    return (F.col(value) if isinstance(value, str) else value).try_cast(EXACT)


def exact_sum(value: Column | str) -> Column:
    return F.sum(exact(value))


def exact_count(value: Column | str) -> Column:
    """How many readings ``exact_sum`` adds up."""
    return F.count(exact(value))


def mean(total: Column, count: Column) -> Column:
    """Average of a sum and a count, not rounded; NULL where nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """Average of an exact sum and a count, rounded half away from zero without an error on the way.

    In whole numbers: twice the sum in units of the last digit, plus the count, over twice the count. Whole units may
    pass 64 bits, so the remainder is taken off before the division.
    """
    scale = F.lit(2 * 10**digits).cast("decimal(4,0)")
    half = F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    whole, parts = F.abs(total) * scale + half, half * F.lit(2).cast("decimal(1,0)")
    units = (whole - whole % parts) / parts
    return F.signum(total).cast("double") * units / F.lit(float(10**digits)) + F.lit(0.0)  # no negative zero


def exact_mean(value: Column | str) -> Column:
    return mean(exact_sum(value), exact_count(value))


def exact_rounded_mean(value: Column | str, digits: int) -> Column:
    return rounded_mean(exact_sum(value), exact_count(value), digits)


# The same as SQL text, for views in the catalog.
def percentage_sql(part: str, whole: str, digits: int = 2) -> str:
    return f"round({part} * 100.0D / nullif({whole}, 0), {digits})"


def exact_sql(value: str) -> str:
    return f"try_cast({value} AS {EXACT})"


def rounded_mean_sql(total: str, count: str, digits: int) -> str:
    half = f"cast(nullif({count}, 0) AS decimal(20,0))"
    whole, parts = f"(abs({total}) * cast({2 * 10**digits} AS decimal(4,0)) + {half})", f"({half} * cast(2 AS decimal(1,0)))"
    units = f"(({whole} - {whole} % {parts}) / {parts})"
    return f"(cast(signum({total}) AS double) * {units} / {10**digits}.0D + 0.0D)"


def round_half_to_plus_infinity(value: Column) -> Column:
    """Nearest integer; halves go up, also for negatives (-30.5 is -30)."""
    return F.floor(value + F.lit(0.5))
