"""Order-independent sums of kWh and money.

Readings and costs carry six decimals. Summing them as BIGINT millionths is exact, so a result
does not depend on partitioning, on which task merged first or on a retried stage, and it stays in
primitive arithmetic (a DECIMAL sum would allocate per row). A value beyond one BIGINT, which holds
9.2e12 kWh, is an error, as in ANSI mode is such a sum; NaN counts as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def to_micro(value: Column) -> Column:
    """Millionths as BIGINT, half up; NULL for NaN, an error for what BIGINT cannot hold."""
    scaled = value.cast("double") * F.lit(float(MILLION)) + F.lit(0.5)
    whole = F.floor(scaled)
    too_large = F.raise_error(F.concat(F.lit("beyond exact sums: "), value.cast("string"))).cast("bigint")
    return (
        F.when(F.isnan(scaled), F.lit(None).cast("bigint"))
        .when(F.abs(scaled) >= F.lit(9.2e18), too_large)
        .otherwise(whole)
    )


def from_micro(value: Column) -> Column:
    return value.cast("double") / F.lit(float(MILLION))


def exact_sum(value: Column) -> Column:
    return from_micro(F.sum(to_micro(value)))


def exact_avg(value: Column) -> Column:
    return exact_sum(value) / F.count(F.nanvl(value.cast("double"), F.lit(None).cast("double")))


def half_up(value: Column, digits: int) -> Column:
    """Round half up in decimal, back to double (what ROUND(x::numeric, n) returns)."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def count_where(condition: Column) -> Column:
    """Number of rows where the flag is true; zero, not NULL, when none is."""
    return F.count_if(condition)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
