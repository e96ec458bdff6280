"""The periods that have data, newest first, as value and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.fixed_values import LATEST_DAYS, LATEST_HOURS
from meterlake.functions.calendar import date_text
from meterlake.functions.calendar import iso_year as iso_year_of


def _two_digits(number: str | Column) -> Column:
    column = F.col(number) if isinstance(number, str) else number
    return F.lpad(column.cast("string"), 2, "0")


def period_list_hour(dim_tiempo: DataFrame, limit: int | None = LATEST_HOURS) -> DataFrame:
    """The latest hours with readings, newest first; all of them without ``limit``."""
    hours = dim_tiempo.select("fecha", "hora").distinct()
    latest = hours.orderBy(F.desc("fecha"), F.desc("hora"))
    latest = latest if limit is None else latest.limit(limit)
    day = date_text(F.col("fecha"))
    return latest.select(
        F.concat_ws(" ", day, F.col("hora").cast("string")).alias("value"),
        F.concat(_two_digits("hora"), F.lit(":00 h — "), day).alias("label"),
    )


def period_list_day(dim_tiempo: DataFrame, limit: int | None = LATEST_DAYS) -> DataFrame:
    """The latest days with readings, newest first; all of them without ``limit``."""
    latest = dim_tiempo.select("fecha").where("fecha IS NOT NULL").distinct()
    latest = latest.orderBy(F.desc("fecha"))
    latest = latest if limit is None else latest.limit(limit)
    return _value_is_label(latest, date_text(F.col("fecha")))


def period_list_week(dim_tiempo: DataFrame, iso_year: bool = False) -> DataFrame:
    """ISO week numbers with the calendar year, or with the ISO year if asked."""
    year = iso_year_of(F.col("fecha")) if iso_year else F.col("year")
    weeks = dim_tiempo.where("fecha IS NOT NULL").select(
        F.concat(year.cast("string"), F.lit("-W"), _two_digits(F.weekofyear("fecha"))).alias("v")
    )
    return _value_is_label(weeks.distinct().orderBy(F.desc("v")), F.col("v"))


def period_list_month(dim_tiempo: DataFrame) -> DataFrame:
    months = dim_tiempo.where("fecha IS NOT NULL").select(
        F.concat(F.col("year").cast("string"), F.lit("-"), _two_digits("month")).alias("v")
    )
    return _value_is_label(months.distinct().orderBy(F.desc("v")), F.col("v"))


def period_list(dim_tiempo: DataFrame, kind: str = "dia", complete: bool = False) -> DataFrame:
    """The list of one kind; any kind that is none of the others lists months.

    Hours and days are the latest, or all if ``complete``.
    """
    if kind == "hora":
        return period_list_hour(dim_tiempo, None if complete else LATEST_HOURS)
    if kind == "dia":
        return period_list_day(dim_tiempo, None if complete else LATEST_DAYS)
    if kind == "semana":
        return period_list_week(dim_tiempo)
    return period_list_month(dim_tiempo)


def _value_is_label(df: DataFrame, text: Column) -> DataFrame:
    return df.select(text.alias("value"), text.alias("label"))
