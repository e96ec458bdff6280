"""Electrical identities and the expected household load."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.fixed_values import LOAD_PROFILE, READING_SECONDS


def kwh_of_power(watts: Column, seconds: int = READING_SECONDS) -> Column:
    """Energy of one reading interval, six decimals."""
    micro = watts * F.lit(seconds * 10.0) / F.lit(36.0)
    return F.floor(micro + F.lit(0.5)).cast("double") / F.lit(1e6)


def current_of_power(watts: Column, volts: Column) -> Column:
    """Amperes, three decimals; NULL without voltage."""
    amperes = watts / F.when(volts != 0, volts)
    return F.floor(amperes * 1000 + F.lit(0.5)).cast("double") / 1000


def expected_load(hora: Column, factor: Column | None = None) -> tuple[Column, Column]:
    """Expected watts and their deviation at an hour, times the household factor if given."""
    mean = F.lit(None).cast("double")
    deviation = F.lit(None).cast("double")
    for first_hour, watts, spread in LOAD_PROFILE:
        mean = F.when(hora >= first_hour, F.lit(float(watts))).otherwise(mean)
        deviation = F.when(hora >= first_hour, F.lit(float(spread))).otherwise(deviation)
    if factor is not None:
        mean, deviation = mean * factor, deviation * factor
    return mean, deviation
