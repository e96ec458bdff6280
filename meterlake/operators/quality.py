"""Cleansing rules. Each is one predicate; the chain is one conjunction in one filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.fixed_values import KWH_RANGE, STATUS_OK, VOLTAGE_RANGE
from meterlake.functions.exact import count_where
from meterlake.operators.peaks import peak_threshold, source_flag


def parse_timestamp(readings: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO text to a zone-less timestamp; text that is none becomes NULL. Typed input passes."""
    if isinstance(readings.schema[column].dataType, T.TimestampNTZType):
        return readings
    return readings.withColumn(column, F.col(column).try_cast("timestamp_ntz"))


def _has_measures() -> Column:
    return F.col("kwh_intervalo").isNotNull() & F.col("timestamp").isNotNull()


def _kwh_in_range() -> Column:
    return F.col("kwh_intervalo").between(*KWH_RANGE)


def _voltage_in_range() -> Column:
    return F.col("voltaje").between(*VOLTAGE_RANGE)


def _status_ok() -> Column:
    return F.col("estado") == STATUS_OK


def is_clean(readings: DataFrame) -> Column:
    """The whole chain as one predicate; rules on absent columns are skipped."""
    rules = [_has_measures(), _kwh_in_range()]
    if "voltaje" in readings.columns:
        rules.append(_voltage_in_range())
    if "estado" in readings.columns:
        rules.append(_status_ok())
    return reduce(lambda a, b: a & b, rules)


def drop_null_readings(readings: DataFrame) -> DataFrame:
    return readings.where(_has_measures())


def filter_kwh_range(readings: DataFrame) -> DataFrame:
    return readings.where(_kwh_in_range())


def filter_voltage_range(readings: DataFrame) -> DataFrame:
    return readings.where(_voltage_in_range()) if "voltaje" in readings.columns else readings


def filter_status_ok(readings: DataFrame) -> DataFrame:
    return readings.where(_status_ok()) if "estado" in readings.columns else readings


def clean_readings(readings: DataFrame) -> DataFrame:
    parsed = parse_timestamp(readings)
    return parsed.where(is_clean(parsed))


def batch_stats(readings: DataFrame) -> DataFrame:
    """One row: readings received, kept, removed, and peaks among the kept, in one pass.

    The peak limit is a scalar subquery over the same readings.
    """
    parsed = parse_timestamp(readings)
    clean = F.coalesce(is_clean(parsed), F.lit(False))
    limit = peak_threshold(parsed.where(is_clean(parsed)))
    peak = F.coalesce(F.col("kwh_intervalo") > limit, F.lit(False)) | source_flag(parsed)
    return parsed.select(clean.alias("limpia"), (clean & peak).alias("pico")).agg(
        F.count("*").alias("filas_raw"),
        count_where(F.col("limpia")).alias("filas_limpias"),
        count_where(~F.col("limpia")).alias("filas_eliminadas"),
        count_where(F.col("pico")).alias("picos_detectados"),
    )
