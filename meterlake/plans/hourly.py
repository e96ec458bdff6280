"""Queries of hour grain or coarser that need no single home, answered from the hourly rollup.

At most 24 rows per date and region, whatever the number of readings. Its sums are exact, so these queries
return the values of their namesakes over all facts; unlike the daily rollup it also serves hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.calendar import date_text, dia_semana
from meterlake.functions.exact import exact_sum, half_up
from meterlake.functions.periods import period_filter
from meterlake.operators.star import Star, join_region
from meterlake.plans.marts import dense_hours


def _mean() -> Column:
    return exact_sum(F.col("kwh_total")) / F.sum("num_lecturas")


def consumo_por_region(star: Star) -> DataFrame:
    """The view v_consumo_por_region."""
    totals = star.resumen_horario.groupBy("region_key", "fecha").agg(
        exact_sum(F.col("kwh_total")).alias("kwh_total"), exact_sum(F.col("costo_total")).alias("costo_total"),
        F.sum("num_picos").alias("num_picos"), _mean().alias("kwh_promedio"), F.sum("num_lecturas").alias("num_lecturas"),
    )
    return join_region(star, totals).select(
        "region", date_text(F.col("fecha")).alias("fecha"), "kwh_total", "costo_total", "num_picos", "kwh_promedio", "num_lecturas",
    )


def perfil_horario(star: Star) -> DataFrame:
    """The view v_perfil_horario."""
    return star.resumen_horario.groupBy("hora").agg(
        _mean().alias("kwh_promedio"), F.max("kwh_max").alias("kwh_max"), F.sum("num_picos").alias("num_picos")
    ).orderBy("hora")


def picos_por_hora(star: Star) -> DataFrame:
    """Peaks for each of the 24 hours, zero where there are none."""
    return dense_hours(star.resumen_horario.select("hora", "num_picos"), "num_picos")


def heatmap(star: Star) -> DataFrame:
    """Mean kWh per weekday and hour, cells without readings left out."""
    return star.resumen_horario.groupBy(dia_semana(F.col("fecha")).alias("dia_semana"), "hora").agg(_mean().alias("kwh"))


def _of_period(star: Star, kind: str, value: str, on_invalid: str) -> DataFrame:
    return star.resumen_horario.where(period_filter(kind, value, on_invalid))


def report_region(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    totals = join_region(star, _of_period(star, kind, value, on_invalid))
    return totals.groupBy("region").agg(
        half_up(exact_sum(F.col("kwh_total")), 6).alias("kwh"), half_up(exact_sum(F.col("costo_total")), 4).alias("costo"),
        F.sum("num_picos").alias("picos"), F.sum("num_lecturas").alias("lecturas"),
    ).orderBy(F.desc("kwh"), "region")


def report_profile(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    return _of_period(star, kind, value, on_invalid).groupBy("hora").agg(
        half_up(_mean(), 6).alias("kwh_prom"), half_up(F.max("kwh_max"), 6).alias("kwh_max")
    ).orderBy("hora")
