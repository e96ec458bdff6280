"""Views and dashboard queries over the star.

"Region" is the tariff code. Region and time dimensions are small tables that the planner broadcasts
by their file size. The home dimension grows with the customers, so facts are aggregated by key
before they meet it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.fixed_values import DAYS_EN, DAYS_SHORT_ES, SCATTER_PEAKS, TOP_PEAKS
from meterlake.functions.calendar import date_text, day_index, timestamp_text
from meterlake.functions.exact import count_where, exact_avg, exact_sum, half_up, zero_if_null
from meterlake.functions.text import fmt_kwh, fmt_mxn
from meterlake.operators.star import Star, consumption, join_home, join_region, join_time, with_date

# --- views ------------------------------------------------------------------------------------


def v_consumo_por_region(star: Star) -> DataFrame:
    return (
        join_region(star, with_date(star))
        .groupBy("region", "fecha")
        .agg(
            *consumption(),
            exact_avg(F.col("kwh_intervalo")).alias("kwh_promedio"),
            F.count("*").alias("num_lecturas"),
        )
        .withColumn("fecha", date_text(F.col("fecha")))
    )


def v_consumo_por_hogar(star: Star) -> DataFrame:
    totals = star.fact.groupBy("hogar_key", "region_key").agg(*consumption())
    return join_home(star, join_region(star, totals)).select(
        "id_hogar", "ciudad", "region", "kwh_total", "costo_total", "num_picos"
    )


def v_perfil_horario(star: Star) -> DataFrame:
    return (
        join_time(star)
        .groupBy("hora")
        .agg(
            exact_avg(F.col("kwh_intervalo")).alias("kwh_promedio"),
            F.max("kwh_intervalo").alias("kwh_max"),
            count_where(F.col("es_pico")).alias("num_picos"),
        )
        .orderBy("hora")
    )


def only_peaks(fact: DataFrame) -> DataFrame:
    return fact.where("es_pico")


def v_picos(star: Star) -> DataFrame:
    peaks = join_home(star, join_region(star, join_time(star, only_peaks(star.fact))))
    return peaks.orderBy(
        F.desc("kwh_intervalo"), F.asc("timestamp_real"), F.asc("id_hogar")
    ).select(
        F.col("timestamp_real").cast("string").alias("timestamp_real"),
        "hora", "id_hogar", "ciudad", "region", "kwh_intervalo", "costo_mxn",
    )


def v_resumen_general(star: Star) -> DataFrame:
    """One row over all facts, those without home or region included."""
    return star.fact.agg(
        F.count("*").alias("total_lecturas"),
        exact_sum(F.col("kwh_intervalo")).alias("kwh_total"),
        exact_avg(F.col("kwh_intervalo")).alias("kwh_promedio"),
        exact_sum(F.col("costo_mxn")).alias("costo_total"),
        count_where(F.col("es_pico")).alias("total_picos"),
        F.count_distinct("hogar_key").alias("hogares_activos"),
    )


# --- dashboard queries ------------------------------------------------------------------------


def resumen(star: Star) -> DataFrame:
    """Totals with zeros for an empty warehouse, and their texts."""
    return general_texts(v_resumen_general(star))


def general_texts(row: DataFrame) -> DataFrame:
    """The row of ``v_resumen_general`` with zeros for nothing, and texts."""
    kwh, cost = zero_if_null(F.col("kwh_total")), zero_if_null(F.col("costo_total"))
    return row.select(
        "total_lecturas",
        kwh.alias("kwh_total"),
        fmt_kwh(F.col("kwh_total")).alias("kwh_total_fmt"),
        cost.alias("costo_total"),
        fmt_mxn(F.col("costo_total")).alias("costo_total_fmt"),
        zero_if_null(F.col("total_picos")).alias("total_picos"),
        zero_if_null(F.col("hogares_activos")).alias("hogares_activos"),
    )


def consumo_region(star: Star) -> DataFrame:
    """Totals per region, biggest first: the view's sums added up."""
    return (
        v_consumo_por_region(star)
        .groupBy("region")
        .agg(
            exact_sum(F.col("kwh_total")).alias("kwh"),
            exact_sum(F.col("costo_total")).alias("costo"),
        )
        .orderBy(F.desc("kwh"), "region")
    )


def ranking_hogares(star: Star) -> DataFrame:
    """All homes, smallest consumption first."""
    return v_consumo_por_hogar(star).select(
        "id_hogar", "ciudad", F.col("kwh_total").alias("kwh")
    ).orderBy("kwh", "id_hogar")


def serie_diaria(star: Star) -> DataFrame:
    """Daily kWh per region; the view already has this grain."""
    return v_consumo_por_region(star).select(
        "fecha", "region", half_up(F.col("kwh_total"), 3).alias("kwh")
    ).orderBy("fecha", "region")


def perfil_horario(star: Star) -> DataFrame:
    return v_perfil_horario(star).select(
        "hora",
        half_up(F.col("kwh_promedio"), 5).alias("prom"),
        half_up(F.col("kwh_max"), 4).alias("maximo"),
    )


def heatmap(star: Star) -> DataFrame:
    """Mean kWh per weekday and hour, cells without readings left out."""
    return join_time(star).groupBy("dia_semana", "hora").agg(
        exact_avg(F.col("kwh_intervalo")).alias("kwh")
    )


def picos(star: Star, limit: int = SCATTER_PEAKS) -> DataFrame:
    """The newest peaks for the scatter plot."""
    return (
        join_region(star, only_peaks(star.fact))
        .orderBy(F.desc("timestamp_real"), "hogar_key", F.desc("kwh_intervalo"))
        .limit(limit)
        .select(
            F.col("timestamp_real").cast("string").alias("timestamp"), "region", "kwh_intervalo"
        )
    )


def picos_por_hora(star: Star) -> DataFrame:
    """Peaks for each of the 24 hours, zero where there are none."""
    return dense_hours(v_perfil_horario(star).select("hora", "num_picos"), "num_picos")


def top_picos(star: Star, limit: int = TOP_PEAKS) -> DataFrame:
    """The biggest peaks with city and region.

    The limit is taken on the facts: every key set at load exists in its dimension, so the joins
    only drop NULL keys, which are excluded first. Ten rows then meet the home table.
    """
    top = (
        only_peaks(star.fact)
        .where("hogar_key IS NOT NULL AND region_key IS NOT NULL")
        .orderBy(F.desc("kwh_intervalo"), "timestamp_real", "hogar_key")
        .limit(limit)
    )
    return (
        join_region(star, join_home(star, top))
        .orderBy(F.desc("kwh_intervalo"), "timestamp_real", "hogar_key")
        .select(
            timestamp_text(F.col("timestamp_real")).alias("timestamp"), "ciudad", "region",
            half_up(F.col("kwh_intervalo"), 4).alias("kwh"),
            half_up(F.col("costo_mxn"), 4).alias("costo"),
        )
    )


def warehouse_totals(star: Star) -> DataFrame:
    return star.fact.agg(
        F.count("*").alias("total"),
        half_up(exact_sum(F.col("kwh_intervalo")), 4).alias("kwh"),
    )


# --- shapes the charts need -------------------------------------------------------------------


def dense_hours(by_hour: DataFrame, value: str) -> DataFrame:
    """One row per hour of the day with the sum of its values, zero where there is none."""
    hours = by_hour.sparkSession.range(0, 24, 1, 1).select(F.col("id").cast("int").alias("hora"))
    sums = by_hour.groupBy("hora").agg(F.sum(value).alias(value))
    return hours.join(sums, "hora", "left").select(
        "hora", zero_if_null(F.col(value)).alias(value)
    ).orderBy("hora")


def dense_heatmap(cells: DataFrame) -> DataFrame:
    """All 168 cells, zero where there were no readings; the input has one row per cell at most.

    Day names may be English or Spanish.
    """
    number = F.col("id").cast("int")
    grid = cells.sparkSession.range(0, 7 * 24, 1, 1).select(
        F.floor(number / 24).cast("int").alias("dia"), (number % 24).alias("hora")
    )
    known = cells.select(day_index(F.col("dia_semana")).alias("dia"), "hora", "kwh")
    names = F.array(*[F.lit(d) for d in DAYS_EN])
    short = F.array(*[F.lit(d) for d in DAYS_SHORT_ES])
    return grid.join(known, ["dia", "hora"], "left").select(
        "dia",
        F.element_at(names, F.col("dia") + 1).alias("dia_semana"),
        F.element_at(short, F.col("dia") + 1).alias("dia_corto"),
        "hora",
        F.coalesce("kwh", F.lit(0.0)).alias("kwh"),
    )


def heatmap_matrix(cells: DataFrame) -> DataFrame:
    """Seven rows, Monday first, one column per hour."""
    hours = list(range(24))
    wide = dense_heatmap(cells).groupBy("dia", "dia_corto").pivot("hora", hours).agg(F.max("kwh"))
    return wide.select(
        "dia", "dia_corto", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours]
    ).orderBy("dia")


def series_by_region(df: DataFrame, x: str, y: str) -> DataFrame:
    """One chart series per region, in long form: region, x, y in drawing order."""
    return df.select("region", F.col(x).alias("x"), F.col(y).alias("y")).orderBy("region", "x", "y")
