from __future__ import annotations

import math

from pyspark.sql import functions as F

from meterlake.operators import quality
from meterlake.operators.features import transform
from meterlake.sources.readings import CORRUPT, decode_readings


def kept(df, column="kwh_intervalo"):
    return sorted(r[0] for r in quality.clean_readings(df).select(column).collect())


def test_kwh_bounds_are_inclusive(make_readings):
    df = make_readings(*[
        {"kwh_intervalo": v} for v in (0.0, 5.0, 5.000001, -0.000001, math.nan, None)
    ])
    assert kept(df) == [0.0, 5.0]


def test_voltage_bounds_are_inclusive(make_readings):
    df = make_readings(*[{"voltaje": v} for v in (99.9, 100.0, 140.0, 140.1, None)])
    assert kept(df, "voltaje") == [100.0, 140.0]


def test_nulls_and_status(make_readings):
    df = make_readings(
        {"kwh_intervalo": None}, {"timestamp": None}, {"estado": None},
        {"estado": "bateria_baja"}, {"kwh_intervalo": 2.0},
    )
    assert kept(df) == [2.0]


def test_rules_on_absent_columns_are_skipped(make_readings):
    df = make_readings({"voltaje": 10.0}, {"estado": "x"}, columns=[
        "timestamp", "kwh_intervalo", "tarifa",
    ])
    assert quality.clean_readings(df).count() == 2
    assert quality.filter_voltage_range(df).count() == 2
    assert quality.filter_status_ok(df).count() == 2


def test_raw_is_clean_plus_removed(make_readings):
    df = make_readings(*[{"kwh_intervalo": v} for v in (0.1, None, 7.0, 0.2)], {"es_pico": 1})
    row = quality.batch_stats(df).first()
    assert (row.filas_raw, row.filas_limpias, row.filas_eliminadas) == (5, 3, 2)
    assert row.picos_detectados == 1


def test_batch_stats_of_nothing(make_readings):
    row = quality.batch_stats(make_readings({}).where("false")).first()
    assert tuple(row) == (0, 0, 0, 0)


def test_bad_timestamp_text_drops_the_reading_only(spark, make_readings):
    texts = spark.createDataFrame(
        [("2024-13-45T00:00:00",), ("2024-01-05T01:02:03",), ("no",)], "timestamp string"
    ).withColumns({"kwh_intervalo": F.lit(1.0), "tarifa": F.lit("1")})
    rows = transform(texts).collect()
    assert [str(r.timestamp) for r in rows] == ["2024-01-05 01:02:03"]


def test_decoding(spark):
    lines = [
        '{"timestamp":"2024-01-05T10:00:00","id_medidor":"MED-001","kwh_intervalo":0.5,'
        '"voltaje":127.1,"estado":"ok"}',
        '{"timestamp":"2024-01-05T10:00:00","kwh_intervalo":null,"estado":"señal_debil"}',
        "not json",
        '{"kwh_intervalo":"many"}',
    ]
    rows = decode_readings(spark.createDataFrame([(v,) for v in lines], "value string")).collect()
    assert [r[CORRUPT] is None for r in rows] == [True, True, False, False]
    assert rows[0].kwh_intervalo == 0.5 and rows[0].es_pico is None and rows[0].tarifa is None
    assert rows[1].estado == "señal_debil"
    assert rows[2][CORRUPT] == "not json"


def test_missing_keys_take_the_defaults(spark):
    line = '{"timestamp":"2024-01-05T10:00:00","id_medidor":"MED-001","kwh_intervalo":0.5,' \
           '"voltaje":127.1,"estado":"ok"}'
    decoded = decode_readings(spark.createDataFrame([(line,)], "value string"))
    row = transform(decoded).first()
    assert row.es_pico is False
    assert row.costo_mxn == 0.477
    assert (row.hora, row.dia_semana, row.es_finde) == (10, "Friday", False)
