"""Adapter: the generic ``events`` table as meter readings (one home per user)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.fixed_values import FAILURE_CAUSES, METERS, STATUS_OK


def _home_number(user: Column) -> Column:
    return F.lpad(user.cast("string"), 6, "0")


def _slot(user: Column, attribute: str) -> Column:
    values = F.array(*[F.lit(getattr(m, attribute)) for m in METERS])
    return F.element_at(values, (F.pmod(user, F.lit(len(METERS))) + 1).cast("int"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def readings_from_events(events: DataFrame) -> DataFrame:
    """Reading columns plus ``event_id``; timestamps stay typed."""
    error = F.col("event_type") == "error"
    bad = error & (F.col("event_id") % 2 == 0)
    # props is always {"k": n}; the cast fails on anything else.
    k = F.substring_index(F.substring_index("props", '{"k": ', -1), "}", 1).cast("int")

    def unless_bad(value: Column) -> Column:
        return F.when(~bad, value)

    user = F.col("user_id")
    kwh = unless_bad(F.col("value") / 50.0)
    volts = unless_bad(F.lit(95.0) + k * 0.5)
    causes = F.array(*[F.lit(c) for c in FAILURE_CAUSES])
    cause = F.element_at(causes, (F.col("event_id") % len(FAILURE_CAUSES) + 1).cast("int"))
    return events.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("MED-"), _home_number(user)).alias("id_medidor"),
        F.concat(F.lit("HOG-"), _home_number(user)).alias("id_hogar"),
        _slot(user, "ciudad").alias("ciudad"),
        _slot(user, "tarifa").alias("tarifa"),
        kwh.alias("kwh_intervalo"),
        (kwh * 1000.0).alias("potencia_w"),
        volts.alias("voltaje"),
        (kwh * 1000.0 / volts).alias("corriente"),
        unless_bad(F.lit(0.85) + (k % 15) * 0.01).alias("factor_potencia"),
        F.when(k % 33 == 0, 1).otherwise(0).alias("es_pico"),
        F.when(error, cause).otherwise(F.lit(STATUS_OK)).alias("estado"),
    )


def registry_from_events(events: DataFrame) -> DataFrame:
    """One meter per user that occurs."""
    user = F.col("user_id")
    return events.select("user_id").distinct().select(
        F.concat(F.lit("MED-"), _home_number(user)).alias("id_medidor"),
        F.concat(F.lit("HOG-"), _home_number(user)).alias("id_hogar"),
        _slot(user, "ciudad").alias("ciudad"),
        _slot(user, "tarifa").alias("tarifa"),
        _slot(user, "factor").alias("factor"),
    ).select(*schemas.REGISTRY.names)
