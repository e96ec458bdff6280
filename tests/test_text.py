from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterlake.functions import energy, text


REPORT = [
    (None, "0.000000", "$0.000000"),
    (0.0, "0.000000", "$0.000000"),
    (0.0005, "0.000500", "$0.000500"),
    (0.001, "0.0010", "$0.0010"),
    (0.5, "0.5000", "$0.5000"),
    (1.0, "1.000", "$1.000"),
    (99.9994, "99.999", "$99.999"),
    (100.0, "100.000", "$100.00"),
    (999.9994, "999.999", "$1,000.00"),
    (1000.0, "1,000.0", "$1,000.00"),
    (1234567.25, "1,234,567.3", "$1,234,567.25"),
    (float("nan"), "0.000000", "$0.000000"),
]
DASHBOARD = [
    (None, "0.0000", "$0.000"),
    (0.5, "0.5000", "$0.500"),
    (1.0, "1.000", "$1.000"),
    (100.0, "100.000", "$100.00"),
    (123.4567, "123.457", "$123.457"),
    (1000.0, "1,000.0", "$1,000.00"),
    (1234.25, "1,234.25", "$1,234.25"),
    (1234.5678, "1,234.568", "$1,234.568"),
]


@pytest.mark.parametrize("cases, kwh, mxn", [
    (REPORT, text.fmt_kwh, text.fmt_mxn),
    (DASHBOARD, text.fmt_dashboard_kwh, text.fmt_dashboard_mxn),
])
def test_bands(spark, cases, kwh, mxn):
    df = spark.createDataFrame(cases, "v double, kwh string, mxn string")
    got = df.select("v", kwh(F.col("v")).alias("k"), mxn(F.col("v")).alias("m")).collect()
    assert [(r.k, r.m) for r in got] == [(k, m) for _, k, m in cases]


def test_energy(spark):
    row = spark.range(1).select(
        energy.kwh_of_power(F.lit(1200.0)).alias("kwh"),
        energy.kwh_of_power(F.lit(1000.0), 3600).alias("hour"),
        energy.current_of_power(F.lit(1000.0), F.lit(127.0)).alias("a"),
        energy.current_of_power(F.lit(1000.0), F.lit(0.0)).alias("none"),
    ).first()
    assert tuple(row) == (0.001, 1.0, 7.874, None)


def test_expected_load(spark):
    mean, deviation = energy.expected_load(F.col("id"), F.lit(2.0))
    rows = spark.range(24).select("id", mean.alias("m"), deviation.alias("d")).collect()
    assert [(r.m, r.d) for r in rows if r.id in (0, 5, 6, 14, 21, 22, 23)] == [
        (160.0, 60.0), (160.0, 60.0), (1200.0, 400.0), (1400.0, 500.0), (1800.0, 700.0),
        (400.0, 120.0), (400.0, 120.0),
    ]
