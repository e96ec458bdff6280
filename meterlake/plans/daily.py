"""Queries of day grain or coarser, answered from the daily rollup and the kept biggest peaks.

The rollup has one row per date, home and region instead of one per reading. Its sums are exact, so
these queries return the same values as their namesakes over all facts and read a small fraction of
the data. Hours, single peaks and facts without a stored rollup still need the facts.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.fixed_values import TOP_HOMES, TOP_PEAKS
from meterlake.functions.calendar import date_text
from meterlake.functions.exact import exact_sum, half_up, zero_if_null
from meterlake.functions.periods import period_filter
from meterlake.operators.star import Star, count_homes, join_home, join_region
from meterlake.plans import marts, report


def _totals() -> list[Column]:
    return [
        exact_sum(F.col("kwh_total")).alias("kwh_total"),
        exact_sum(F.col("costo_total")).alias("costo_total"),
        F.sum("num_picos").alias("num_picos"),
        F.sum("num_lecturas").alias("num_lecturas"),
    ]


def _mean() -> Column:
    return (F.col("kwh_total") / F.col("num_lecturas")).alias("kwh_promedio")


def consumo_por_region(star: Star) -> DataFrame:
    """The view v_consumo_por_region."""
    totals = star.resumen_diario.groupBy("region_key", "fecha").agg(*_totals())
    return join_region(star, totals).select(
        "region", date_text(F.col("fecha")).alias("fecha"), "kwh_total", "costo_total",
        "num_picos", _mean(), "num_lecturas",
    )


def consumo_por_hogar(star: Star) -> DataFrame:
    """The view v_consumo_por_hogar."""
    totals = star.resumen_diario.groupBy("hogar_key", "region_key").agg(*_totals())
    return join_home(star, join_region(star, totals)).select(
        "id_hogar", "ciudad", "region", "kwh_total", "costo_total", "num_picos"
    )


def resumen_general(star: Star) -> DataFrame:
    """The view v_resumen_general: totals from the rows of dates and hours, homes from the bitmaps."""
    return star.resumen_horario.agg(*_totals()).select(
        zero_if_null(F.col("num_lecturas")).alias("total_lecturas"), "kwh_total", _mean(),
        "costo_total", zero_if_null(F.col("num_picos")).alias("total_picos"),
        count_homes(star.hogares_activos).scalar().alias("hogares_activos"),
    )


def resumen(star: Star) -> DataFrame:
    """Totals with zeros for an empty warehouse, and their texts."""
    return marts.general_texts(resumen_general(star))


def hogares_por_periodo(star: Star, kind: str) -> DataFrame:
    """Different homes with readings in each day, week or month (its first date); none is counted twice in one."""
    unit = {"dia": "day", "semana": "week", "mes": "month"}[kind]
    first = F.date_trunc(unit, "fecha").cast("date").alias("desde")
    united = star.hogares_activos.groupBy(first, "cubeta").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return united.groupBy("desde").agg(F.sum(F.bitmap_count("mapa")).alias("hogares")).orderBy("desde")


def _of_period(star: Star, kind: str, value: str, on_invalid: str) -> DataFrame:
    if kind == "hora":
        raise ValueError("the daily rollup has no hours")
    return star.resumen_diario.where(period_filter(kind, value, on_invalid))


def _report() -> list[Column]:
    return [
        half_up(exact_sum(F.col("kwh_total")), 6).alias("kwh"),
        half_up(exact_sum(F.col("costo_total")), 4).alias("costo"),
        F.sum("num_picos").alias("picos"),
        F.sum("num_lecturas").alias("lecturas"),
    ]


def preview_resumen(
    star: Star, kind: str, value: str, on_invalid: str = "all", keep_empty: bool = False
) -> DataFrame:
    """The summary of a day, week or month: a row per hour and region and a bit per home are read of each date."""
    if kind == "hora":
        raise ValueError("homes are kept by date, not by hour")
    period = period_filter(kind, value, on_invalid)
    row = star.resumen_horario.where(period).agg(*_report()).select(
        zero_if_null(F.col("lecturas")).alias("lecturas"), zero_if_null(F.col("kwh")).alias("kwh"),
        zero_if_null(F.col("costo")).alias("costo"), zero_if_null(F.col("picos")).alias("picos"),
        count_homes(star.hogares_activos.where(period)).scalar().alias("hogares"),
    )
    return report.labelled(row if keep_empty else row.where("lecturas > 0"), kind, value)


def report_region(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    totals = join_region(star, _of_period(star, kind, value, on_invalid))
    return totals.groupBy("region").agg(*_report()).orderBy(F.desc("kwh"), "region")


def report_homes(
    star: Star, kind: str, value: str, on_invalid: str = "all", limit: int = TOP_HOMES
) -> DataFrame:
    totals = (
        _of_period(star, kind, value, on_invalid).where("hogar_key IS NOT NULL")
        .groupBy("hogar_key", "region_key").agg(*_report())
    )
    best = join_region(star, totals).orderBy(F.desc("kwh"), "hogar_key").limit(limit)
    return join_home(star, best).orderBy(F.desc("kwh"), "hogar_key").select(
        "id_hogar", "ciudad", "region", "kwh", "costo", "picos"
    )


def _few_peaks(star: Star, limit: int) -> DataFrame:
    if limit > TOP_PEAKS:
        raise ValueError(f"{TOP_PEAKS} peaks are kept of a date; ask the facts for more")
    return star.picos_mayores


def top_picos(star: Star, limit: int = TOP_PEAKS) -> DataFrame:
    """The biggest peaks with city and region, from the kept ones of each date."""
    return marts.top_picos(replace(star, fact=_few_peaks(star, limit).withColumn("es_pico", F.lit(True))), limit)


def report_peaks(
    star: Star, kind: str, value: str, on_invalid: str = "all", limit: int = TOP_PEAKS
) -> DataFrame:
    """The biggest peaks of a day, week or month, from the kept ones of each date."""
    if kind == "hora":
        raise ValueError("peaks are kept by date, not by hour")
    kept = _few_peaks(star, limit).where(period_filter(kind, value, on_invalid))
    return report.top_peaks(star, kept.withColumn("es_pico", F.lit(True)), limit)
