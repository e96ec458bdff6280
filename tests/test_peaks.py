from __future__ import annotations

import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlake.operators.peaks import batch_moments, flag_peaks


def flags(df, scope=None):
    return [r.es_pico for r in flag_peaks(df, scope).orderBy("timestamp").collect()]


def batch(values, **extra):
    start = datetime(2024, 1, 5)
    return [
        {"kwh_intervalo": v, "timestamp": start + timedelta(seconds=i), **extra}
        for i, v in enumerate(values)
    ]


def test_eight_readings_cannot_reach_three_sigmas_but_eleven_can(make_readings):
    assert not any(flags(make_readings(*batch([0.1] * 7 + [5.0]))))
    assert flags(make_readings(*batch([0.1] * 10 + [5.0]))) == [False] * 10 + [True]


def test_one_reading(make_readings):
    row = batch_moments(make_readings(*batch([2.0]))).first()
    assert (row.lecturas, row.media, row.desviacion) == (1, 2.0, None)
    assert flags(make_readings(*batch([2.0]))) == [False]


@pytest.mark.parametrize("value", [0.1, 0.333333, 4.999999])
def test_constant_batch_has_no_deviation_and_no_peaks(make_readings, value):
    df = make_readings(*batch([value] * 37)).repartition(4)
    assert batch_moments(df).first().desviacion == 0.0
    assert not any(flags(df))


def test_source_flag_counts_and_null_means_no(make_readings):
    rows = batch([0.1, 0.1, 0.1])
    rows[0]["es_pico"], rows[1]["es_pico"] = 1, None
    df = make_readings(*rows)
    assert flags(df) == [True, False, False]
    assert flags(df.drop("es_pico")) == [False, False, False]


def test_scope_by_group(make_readings):
    rows = batch([0.1] * 10 + [1.0], tarifa="1") + batch([4.0] * 11, tarifa="1B")
    df = make_readings(*rows)
    marked = flag_peaks(df, ["tarifa"]).where("es_pico").collect()
    assert [(r.tarifa, r.kwh_intervalo) for r in marked] == [("1", 1.0)]
    assert flag_peaks(df).where("es_pico").count() == 0


def test_scope_keeps_null_groups(make_readings):
    df = make_readings(*batch([0.1] * 10 + [5.0], tarifa=None))
    assert flags(df, ["tarifa"]) == [False] * 10 + [True]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 5_000_000), min_size=2, max_size=60))
def test_moments_are_those_of_the_sample(make_readings, micros):
    values = [m / 1e6 for m in micros]
    row = batch_moments(make_readings(*batch(values)).repartition(3)).first()
    assert row.lecturas == len(values)
    assert row.media == pytest.approx(statistics.fmean(values), abs=1e-12)
    assert row.desviacion == pytest.approx(statistics.stdev(values), abs=1e-9)
