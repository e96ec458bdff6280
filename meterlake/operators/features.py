"""Derived columns of a reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.fixed_values import TARIFFS, Tariff
from meterlake.functions import calendar as cal
from meterlake.operators.peaks import flag_peaks
from meterlake.operators.quality import clean_readings
from meterlake.operators.tariffs import cost_etl


def time_features(readings: DataFrame) -> DataFrame:
    """Add hour, English day name and weekend flag."""
    ts = F.col("timestamp")
    return readings.withColumns({
        "hora": F.hour(ts),
        "dia_semana": cal.dia_semana(ts),
        "es_finde": cal.es_finde(ts),
    })


def transform(
    readings: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    peak_scope: Sequence[str] | None = None,
) -> DataFrame:
    """Raw readings to clean, flagged and priced readings."""
    clean = time_features(clean_readings(readings))
    return cost_etl(flag_peaks(clean, peak_scope), books)
