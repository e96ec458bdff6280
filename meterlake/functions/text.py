"""Number texts for reports and dashboards. Values are rounded half up in decimal first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(value: Column) -> Column:
    clean = F.when(F.isnan(value.cast("double")), None).otherwise(value)
    return F.coalesce(clean.cast("decimal(28,10)"), F.lit(0).cast("decimal(28,10)"))


def _fixed(value: Column, digits: int) -> Column:
    return F.format_number(F.round(value, digits), digits)


def fmt_kwh(value: Column) -> Column:
    v = _number(value)
    return (
        F.when(v >= 1000, _fixed(v, 1))
        .when(v >= 1, F.replace(_fixed(v, 3), F.lit(","), F.lit("")))
        .when(v >= F.lit("0.001").cast("decimal(4,3)"), _fixed(v, 4))
        .otherwise(_fixed(v, 6))
    )


def fmt_mxn(value: Column) -> Column:
    v = _number(value)
    text = (
        F.when(v >= 100, _fixed(v, 2))
        .when(v >= 1, _fixed(v, 3))
        .when(v >= F.lit("0.001").cast("decimal(4,3)"), _fixed(v, 4))
        .otherwise(_fixed(v, 6))
    )
    return F.concat(F.lit("$"), text)


def fmt_dashboard_kwh(value: Column) -> Column:
    """Thousands: grouped, one to three decimals. From one on: three decimals. Below: four."""
    v = _number(value)
    grouped = F.regexp_replace(_fixed(v, 3), r"(\.\d+?)0+$", "$1")
    small = F.replace(_fixed(v, 3), F.lit(","), F.lit(""))
    return F.when(v >= 1000, grouped).when(v >= 1, small).otherwise(_fixed(v, 4))


def fmt_dashboard_mxn(value: Column) -> Column:
    """From one hundred on: grouped, two to three decimals. Below: three decimals."""
    v = _number(value)
    grouped = F.regexp_replace(_fixed(v, 3), r"(\.\d\d)0$", "$1")
    return F.concat(F.lit("$"), F.when(v >= 100, grouped).otherwise(_fixed(v, 3)))
