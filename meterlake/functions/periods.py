"""Calendar periods: a (kind, value) pair as a predicate, and its label.

Kinds and value texts: ``hora`` "2024-01-05 9", ``dia`` "2024-01-05", ``semana`` "2024-W02",
``mes`` "2024-01". Values become typed literals; no SQL text is assembled. Day, week and month
predicates touch ``fecha`` only, the partition column of the fact table, so they prune partitions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.functions.calendar import iso_year as iso_year_of
from meterlake.functions.calendar import mes_nombre

KINDS = ("hora", "dia", "semana", "mes")


class _Malformed(ValueError):
    """The value has not the shape of its kind."""


def period_hour(value: str, fecha: str = "fecha", hora: str = "hora") -> Column:
    day, blank, hour = value.strip().rpartition(" ")
    if not blank:
        raise _Malformed(value)
    return _on_day(day.strip(), fecha) & (F.col(hora) == F.lit(_integer(hour)))


def period_day(value: str, fecha: str = "fecha") -> Column:
    token = value.strip().split(" ")[0]
    if len(token) < 10:
        raise _Malformed(value)
    return _on_day(token, fecha)


def period_week(value: str, fecha: str = "fecha", iso_year: bool = False) -> Column:
    """ISO week number within a calendar year, or within its ISO year if asked."""
    year, mark, week = value.strip().partition("-W")
    if not mark or "-W" in week:
        raise _Malformed(value)
    number = _integer(week)
    if not year.strip().isdigit():
        return F.lit(False)
    year_of = iso_year_of(F.col(fecha)) if iso_year else F.year(fecha)
    return (year_of == F.lit(int(year))) & (F.weekofyear(fecha) == F.lit(number))


def period_month(value: str, fecha: str = "fecha") -> Column:
    parts = value.strip().split("-")
    if "-W" in value or len(parts) != 2:
        raise _Malformed(value)
    number = _integer(parts[1])
    if not parts[0].strip().isdigit():
        return F.lit(False)
    return (F.year(fecha) == F.lit(int(parts[0]))) & (F.month(fecha) == F.lit(number))


def period_filter(
    kind: str,
    value: str,
    on_invalid: str = "all",
    fecha: str = "fecha",
    hora: str = "hora",
    iso_year: bool = False,
) -> Column:
    """Predicate of a period.

    A value without the shape of its kind, or an unknown kind, selects everything
    (``on_invalid="all"``) or raises (``"error"``). A value of the right shape that is no calendar
    date selects nothing.
    """
    if on_invalid not in ("all", "error"):
        raise ValueError("on_invalid is 'all' or 'error'")
    text = str(value)
    try:
        if kind == "hora":
            return period_hour(text, fecha, hora)
        if kind == "dia":
            return period_day(text, fecha)
        if kind == "semana":
            return period_week(text, fecha, iso_year)
        if kind == "mes":
            return period_month(text, fecha)
        raise _Malformed(f"unknown period kind {kind!r}")
    except _Malformed as problem:
        if on_invalid == "error":
            raise ValueError(f"not a period: {kind!r} {value!r}") from problem
        return F.lit(True)


def period_label(kind: Column | str, value: Column) -> Column:
    """Readable label of a period; a value that does not parse is returned as it is."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.coalesce(
        F.when(kind == "hora", _hour_label(value))
        .when(kind == "dia", _day_label(value))
        .when(kind == "semana", _week_label(value))
        .when(kind == "mes", _month_label(value)),
        value,
    )


def _integer(text: str) -> int:
    try:
        return int(text)
    except ValueError as problem:
        raise _Malformed(text) from problem


def _on_day(text: str, fecha: str) -> Column:
    parts = text.split("-")
    if len(parts) != 3 or not all(part.isdigit() for part in parts):
        return F.lit(False)
    try:
        return F.col(fecha) == F.lit(date(*map(int, parts)))
    except ValueError:
        return F.lit(False)


def _whole(text: Column) -> Column:
    return F.when(F.trim(text).rlike(r"^\d{1,6}$"), F.trim(text)).try_cast("int")


def _hour_label(value: Column) -> Column:
    hour = _whole(F.substring_index(value, " ", -1))
    day = F.regexp_extract(value, r"^(.*) [^ ]*$", 1)
    padded = F.lpad(hour.cast("string"), 2, "0")
    return F.when(
        value.contains(" ") & hour.isNotNull(),
        F.concat(day, F.lit("  "), padded, F.lit(":00 – "), padded, F.lit(":59 h")),
    )


def _day_label(value: Column) -> Column:
    token = F.substring_index(value, " ", 1)
    day = F.when(token.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), token).try_cast("date")
    return F.concat(
        F.day(day).cast("string"), F.lit(" de "), mes_nombre(F.month(day)),
        F.lit(" de "), F.year(day).cast("string"),
    )


def _monday_of_week(year: Column, week: Column) -> Column:
    january_4 = F.try_make_timestamp_ntz(
        year, F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")
    return F.date_add(january_4, (week - 1) * 7 - F.weekday(january_4))


def _week_label(value: Column) -> Column:
    well_formed = value.rlike(r"^\d{4}-W\d{1,2}$")
    year = F.when(well_formed, F.substring(value, 1, 4)).try_cast("int")
    text = F.when(well_formed, F.substring_index(value, "-W", -1))
    week = text.try_cast("int")
    this_year = _monday_of_week(year, week)
    # January days of a week 52 or 53 that the ISO calendar counts to the year before.
    monday = F.when(F.weekofyear(this_year) == week, this_year).otherwise(
        _monday_of_week(year - 1, week)
    )
    sunday = F.date_add(monday, 6)
    return F.when(
        week.between(1, 53) & (F.weekofyear(monday) == week),
        F.concat(
            F.lit("Semana "), text, F.lit(" · "), _day_month(monday), F.lit(" – "),
            _day_month(sunday), F.lit("/"), F.year(sunday).cast("string"),
        ),
    )


def _day_month(day: Column) -> Column:
    return F.concat(
        F.lpad(F.day(day).cast("string"), 2, "0"), F.lit("/"),
        F.lpad(F.month(day).cast("string"), 2, "0"),
    )


def _month_label(value: Column) -> Column:
    well_formed = value.rlike(r"^[^-]+-\d{1,2}$")
    month = F.when(well_formed, F.substring_index(value, "-", -1)).try_cast("int")
    return F.when(
        month.between(1, 12),
        F.concat(mes_nombre(month), F.lit(" "), F.substring_index(value, "-", 1)),
    )
