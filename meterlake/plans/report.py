"""The report of one calendar period: summary, regions, homes, peaks, hourly profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.fixed_values import TOP_HOMES, TOP_PEAKS
from meterlake.functions.calendar import timestamp_text
from meterlake.functions.exact import count_where, exact_avg, exact_sum, half_up, zero_if_null
from meterlake.functions.periods import period_filter, period_label
from meterlake.functions.text import fmt_kwh, fmt_mxn
from meterlake.operators.star import Star, join_home, join_region, join_time, with_date


def facts_of_period(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    """Facts with time attributes, cut to the period; prunes the fact table's date partitions."""
    return join_time(star).where(period_filter(kind, value, on_invalid))


def _dated(star: Star, kind: str, value: str, on_invalid: str) -> DataFrame:
    """The facts of a period without time attributes; only hours need the time dimension."""
    if kind == "hora":
        return facts_of_period(star, kind, value, on_invalid)
    return with_date(star).where(period_filter(kind, value, on_invalid))


def _kwh() -> Column:
    return half_up(exact_sum(F.col("kwh_intervalo")), 6).alias("kwh")


def _cost() -> Column:
    return half_up(exact_sum(F.col("costo_mxn")), 4).alias("costo")


def _peaks() -> Column:
    return count_where(F.col("es_pico")).alias("picos")


def _summary(facts: DataFrame, keep_empty: bool = False) -> DataFrame:
    row = facts.agg(
        F.count("*").alias("lecturas"), zero_if_null(_kwh()).alias("kwh"), zero_if_null(_cost()).alias("costo"),
        _peaks(), F.count_distinct("hogar_key").alias("hogares"),
    )
    return row if keep_empty else row.where("lecturas > 0")


def _regions(star: Star, facts: DataFrame) -> DataFrame:
    return (
        join_region(star, facts).groupBy("region")
        .agg(_kwh(), _cost(), _peaks(), F.count("*").alias("lecturas"))
        .orderBy(F.desc("kwh"), "region")
    )


def _top_homes(star: Star, facts: DataFrame, limit: int) -> DataFrame:
    """Ranked by key first; only the rows of the ranking meet the home table."""
    totals = (
        facts.where("hogar_key IS NOT NULL")
        .groupBy("hogar_key", "region_key").agg(_kwh(), _cost(), _peaks())
    )
    best = join_region(star, totals).orderBy(F.desc("kwh"), "hogar_key").limit(limit)
    # The window sees the rows of the ranking only.
    ranked = best.withColumn(
        "posicion", F.row_number().over(Window.orderBy(F.desc("kwh"), "hogar_key"))
    )
    return join_home(star, ranked).orderBy("posicion").select(
        "posicion", "id_hogar", "ciudad", "region", "kwh", "costo", "picos"
    )


def top_peaks(star: Star, facts: DataFrame, limit: int) -> DataFrame:
    order = [F.desc("kwh_intervalo"), F.asc("timestamp_real"), F.asc("hogar_key")]
    top = facts.where("es_pico AND hogar_key IS NOT NULL").orderBy(*order).limit(limit)
    return join_home(star, top).orderBy(*order).select(
        timestamp_text(F.col("timestamp_real")).alias("timestamp_real"), "id_hogar", "ciudad",
        half_up(F.col("kwh_intervalo"), 6).alias("kwh"),
        half_up(F.col("costo_mxn"), 4).alias("costo"),
    )


def _profile(facts: DataFrame) -> DataFrame:
    return facts.groupBy("hora").agg(
        half_up(exact_avg(F.col("kwh_intervalo")), 6).alias("kwh_prom"),
        half_up(F.max("kwh_intervalo"), 6).alias("kwh_max"),
    ).orderBy("hora")


def preview_resumen(
    star: Star, kind: str, value: str, on_invalid: str = "all", keep_empty: bool = False
) -> DataFrame:
    """One row with label and texts. When the period has no data: no row, or with ``keep_empty`` a row of
    zeros, so that its label is there to be shown."""
    return labelled(_summary(_dated(star, kind, value, on_invalid), keep_empty), kind, value)


def labelled(summary: DataFrame, kind: str, value: str) -> DataFrame:
    """The label of the period and texts beside the numbers of its summary."""
    return summary.select(
        period_label(kind, F.lit(value)).alias("label"),
        "lecturas", "kwh", fmt_kwh(F.col("kwh")).alias("kwh_fmt"),
        "costo", fmt_mxn(F.col("costo")).alias("costo_fmt"), "picos", "hogares",
    )


def report_region(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    return _regions(star, _dated(star, kind, value, on_invalid))


def ranked_homes(
    star: Star, kind: str, value: str, on_invalid: str = "all", limit: int = TOP_HOMES
) -> DataFrame:
    """The homes that used most, with their rank."""
    return _top_homes(star, _dated(star, kind, value, on_invalid), limit)


def report_homes(
    star: Star, kind: str, value: str, on_invalid: str = "all", limit: int = TOP_HOMES
) -> DataFrame:
    return ranked_homes(star, kind, value, on_invalid, limit).drop("posicion")


def report_peaks(
    star: Star, kind: str, value: str, on_invalid: str = "all", limit: int = TOP_PEAKS
) -> DataFrame:
    return top_peaks(star, _dated(star, kind, value, on_invalid), limit)


def report_profile(star: Star, kind: str, value: str, on_invalid: str = "all") -> DataFrame:
    return _profile(facts_of_period(star, kind, value, on_invalid))


def period_report(
    star: Star, kind: str, value: str, on_invalid: str = "all"
) -> dict[str, DataFrame]:
    """The five parts of a report. Each reads only the partitions and columns it needs.

    The hourly profile is left empty when it would have a single row; its window sees at most 24.
    """
    profile = report_profile(star, kind, value, on_invalid)
    rows = F.count("*").over(Window.partitionBy())
    return {
        "resumen": preview_resumen(star, kind, value, on_invalid),
        "por_region": report_region(star, kind, value, on_invalid),
        "por_hogar": ranked_homes(star, kind, value, on_invalid),
        "picos": report_peaks(star, kind, value, on_invalid),
        "perfil": profile.withColumn("_n", rows).where("_n > 1").drop("_n").orderBy("hora"),
    }


def write_report(parts: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Export the parts, one folder each, as parquet, csv or json."""
    for name, df in parts.items():
        writer = df.coalesce(1).write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{path}/{name}")
