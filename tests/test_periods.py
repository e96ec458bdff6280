from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.functions import calendar as cal
from meterlake.functions.periods import period_filter, period_label
from meterlake.operators.star import dim_tiempo
from meterlake.plans import listings
from meterlake.session import constant_frame


@pytest.fixture
def days(spark):
    schema = T.StructType([
        T.StructField("fecha", T.DateType()), T.StructField("hora", T.IntegerType()),
    ])
    rows = [(date(*d), h) for d, h in (
        ((2024, 1, 5), 9), ((2024, 1, 5), 23), ((2024, 12, 30), 0), ((2026, 1, 5), 9),
        ((2027, 1, 1), 9),
    )]
    return constant_frame(spark, rows, schema)


def chosen(df, kind, value, **options):
    rows = df.where(period_filter(kind, value, **options)).collect()
    return sorted((str(r.fecha), r.hora) for r in rows)


def test_kinds(days):
    assert chosen(days, "hora", "2024-01-05 9") == [("2024-01-05", 9)]
    assert chosen(days, "hora", " 2024-01-05 09 ") == [("2024-01-05", 9)]
    assert chosen(days, "dia", "2024-01-05 rest") == [("2024-01-05", 9), ("2024-01-05", 23)]
    assert chosen(days, "hora", "2024-1-5 23") == [("2024-01-05", 23)]
    assert chosen(days, "mes", "2024-12") == [("2024-12-30", 0)]
    assert chosen(days, "mes", "2024-1") == [("2024-01-05", 9), ("2024-01-05", 23)]


def test_week_takes_the_calendar_year_or_the_iso_year(days):
    assert chosen(days, "semana", "2024-W01") == [("2024-01-05", 9), ("2024-01-05", 23),
                                                  ("2024-12-30", 0)]
    assert chosen(days, "semana", "2027-W53") == [("2027-01-01", 9)]
    assert chosen(days, "semana", "2025-W01", iso_year=True) == [("2024-12-30", 0)]
    assert chosen(days, "semana", "2026-W53", iso_year=True) == [("2027-01-01", 9)]


@pytest.mark.parametrize("kind, value", [
    ("dia", ""), ("dia", "2024"), ("semana", "2024-W"), ("semana", "2024"), ("hora", "x y"),
    ("hora", "2024-01-05"), ("mes", "2024"), ("mes", "2024-01-05"), ("mes", "2024-W01"),
    ("mes", "2024-x"), ("siglo", "21"),
])
def test_malformed_selects_everything_or_raises(days, kind, value):
    assert len(chosen(days, kind, value)) == 5
    with pytest.raises(ValueError):
        period_filter(kind, value, on_invalid="error")


@pytest.mark.parametrize("kind, value", [
    ("dia", "2024-13-45"), ("dia", "2024-W01-5"), ("dia", "2024-01-05'; --"), ("hora", "2024-02-30 1"),
    ("semana", "abcd-W01"), ("mes", "2024 OR 1=1-1"),
])
def test_what_is_no_date_selects_nothing(days, kind, value):
    assert chosen(days, kind, value) == []


LABELS = [
    ("hora", "2024-01-05 9", "2024-01-05  09:00 – 09:59 h"),
    ("dia", "2024-01-05", "5 de Enero de 2024"),
    ("dia", "2024-12-31 x", "31 de Diciembre de 2024"),
    ("semana", "2026-W02", "Semana 02 · 05/01 – 11/01/2026"),
    ("semana", "2024-W01", "Semana 01 · 01/01 – 07/01/2024"),
    ("semana", "2027-W53", "Semana 53 · 28/12 – 03/01/2027"),
    ("semana", "2020-W53", "Semana 53 · 28/12 – 03/01/2021"),
    ("mes", "2024-09", "Septiembre 2024"),
    ("dia", "2024-13-01", "2024-13-01"), ("dia", "", ""), ("hora", "x y", "x y"),
    ("semana", "2024-W60", "2024-W60"), ("semana", "2024-W", "2024-W"),
    ("mes", "2024-13", "2024-13"), ("mes", "2024-01-05", "2024-01-05"), ("siglo", "21", "21"),
]


def test_labels(spark):
    df = spark.createDataFrame(LABELS, "kind string, value string, label string")
    wrong = df.select(
        "value", "label", period_label(F.col("kind"), F.col("value")).alias("got")
    ).where("NOT got <=> label")
    assert wrong.collect() == []


def test_labels_of_literals(spark):
    """The same through constant folding, as a single report uses it."""
    labels = [period_label(kind, F.lit(value)) for kind, value, _ in LABELS]
    assert list(spark.range(1).select(*labels).first()) == [label for *_, label in LABELS]


@pytest.fixture
def tiempo(make_readings):
    stamps = [datetime(2024, 1, 5, 9, 14), datetime(2024, 1, 5, 23, 59, 59),
              datetime(2024, 12, 30, 0, 0), datetime(2027, 1, 1, 9, 15),
              datetime(2024, 1, 5, 9, 1)]
    return dim_tiempo(make_readings(*[{"timestamp": t} for t in stamps]))


def test_hours_are_listed_in_time_order(tiempo):
    got = [(r.value, r.label) for r in listings.period_list_hour(tiempo).collect()]
    assert got == [
        ("2027-01-01 9", "09:00 h — 2027-01-01"), ("2024-12-30 0", "00:00 h — 2024-12-30"),
        ("2024-01-05 23", "23:00 h — 2024-01-05"), ("2024-01-05 9", "09:00 h — 2024-01-05"),
    ]
    assert listings.period_list_hour(tiempo, 1).count() == 1


def test_other_lists(tiempo):
    def values(df):
        return [r.value for r in df.collect()]

    assert values(listings.period_list_day(tiempo)) == ["2027-01-01", "2024-12-30", "2024-01-05"]
    assert values(listings.period_list_week(tiempo)) == ["2027-W53", "2024-W01"]
    assert values(listings.period_list_week(tiempo, iso_year=True)) == [
        "2026-W53", "2025-W01", "2024-W01",
    ]
    assert values(listings.period_list_month(tiempo)) == ["2027-01", "2024-12", "2024-01"]
    assert values(listings.period_list(tiempo, "siglo")) == ["2027-01", "2024-12", "2024-01"]


def test_every_listed_period_selects_its_rows(tiempo):
    for kind in ("hora", "dia", "semana", "mes"):
        periods = [r.value for r in listings.period_list(tiempo, kind).collect()]
        counts = [tiempo.where(period_filter(kind, p, "error")).count() for p in periods]
        assert all(counts) and sum(counts) == tiempo.count()


def test_dim_tiempo_rows(tiempo):
    row = tiempo.where("tiempo_key = 202401052345").first()
    assert row.asDict() == {
        "tiempo_key": 202401052345, "timestamp": "2024-01-05T23:45:00",
        "fecha": date(2024, 1, 5), "year": 2024, "month": 1, "day": 5, "hora": 23,
        "dia_semana": "Friday", "es_finde": False, "trimestre": 1, "mes_nombre": "Enero",
    }
    assert tiempo.count() == 4


def test_calendar_ignores_the_session_zone(spark, make_readings):
    """02:30 does not exist on that day in New York, and midnight not in Sao Paulo."""
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = [{"timestamp": datetime(2024, 3, 10, 2, 30)}, {"timestamp": datetime(2018, 11, 4, 0, 5)}]
    try:
        for zone in ("America/New_York", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = sorted((r.tiempo_key, r.timestamp, r.hora, r.dia_semana)
                         for r in dim_tiempo(make_readings(*rows)).collect())
            assert got == [
                (201811040000, "2018-11-04T00:00:00", 0, "Sunday"),
                (202403100230, "2024-03-10T02:30:00", 2, "Sunday"),
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_day_index(spark):
    cases = [
        ("Monday", 0), (" lunes ", 0), ("miércoles", 2), ("miercoles", 2), ("MIÉRCOLES", 2),
        ("sabado", 5), ("Domingo", 6), ("?", None), (None, None),
    ]
    df = spark.createDataFrame(cases, "name string, wanted int")
    assert df.where(~cal.day_index(F.col("name")).eqNullSafe(F.col("wanted"))).collect() == []
