"""The monthly ledger against pricing everything at once."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from meterlake.operators.tariffs import month_to_date, price_tiered
from meterlake.sources import ledger

COLUMNS = ["id_hogar", "timestamp", "id_medidor", "kwh_intervalo", "tarifa", "nivel", "costo_mxn"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def numbers():
    """Readings over a month's end: few moments, so ties, repeated rows and shared quarter hours; some without home."""
    rng = random.Random(5)
    start = datetime(2024, 1, 31, 20)
    return [
        {"id_hogar": rng.choice(["HOG-A", "HOG-A", "HOG-B", "", None]), "id_medidor": rng.choice(["M1", "M2"]),
         "timestamp": start + timedelta(minutes=rng.randrange(0, 480, 5)), "tarifa": rng.choice(["1", "1E", "9X", None]),
         "kwh_intervalo": rng.choice([0.0, 20.0, 75.0, 120.5])}
        for _ in range(90)
    ]


def test_any_order_and_repetition_gives_the_prices_of_one_run(spark, make_readings, numbers, tmp_path):
    path = str(tmp_path / "star")
    batches = [make_readings(*numbers[i::3]) for i in range(3)]
    for lote in (0, 1, 2):
        ledger.price_batch(batches[lote], path, lote)
    wanted = rows_of(price_tiered(month_to_date(make_readings(*numbers))))
    assert rows_of(ledger.priced_readings(spark, path)) == wanted
    stored = sorted(map(repr, ledger.read_ledger(spark, path).collect()))
    for lote in (1, 2):  # the last one as after a crash, an earlier one long after
        ledger.price_batch(batches[lote], path, lote)
        assert sorted(map(repr, ledger.read_ledger(spark, path).collect())) == stored
    bills = {(r.id_hogar, r.mes): r for r in ledger.month_bills(spark, path).collect()}
    assert sum(r.lecturas for r in bills.values()) == len(numbers)
    assert sum(r.costo for r in bills.values()) == pytest.approx(sum(w[-1] for w in wanted), abs=1e-6)
    assert {m for _, m in bills} == {202401, 202402}


def test_readings_in_order_read_no_entries(spark, make_readings, tmp_path, monkeypatch):
    """Nothing is late: the ledger of earlier batches is not opened."""
    path, opened = str(tmp_path / "star"), []
    real = ledger._before
    monkeypatch.setattr(ledger, "_before", lambda s, p, table, *rest: opened.append(table) or real(s, p, table, *rest))
    for lote in range(2):
        ledger.price_batch(make_readings(*[
            {"timestamp": datetime(2024, 1, 5, 10, 20 * lote + i), "kwh_intervalo": 40.0} for i in range(3)
        ]), path, lote)
    assert opened == [ledger.SLICES] * 2
    assert [r.nivel for r in ledger.priced_readings(spark, path).orderBy("timestamp").collect()] == ["1", "1", "2", "2", "2", "2"]


def test_empty_batches(spark, make_readings, tmp_path):
    path = str(tmp_path / "star")
    ledger.price_batch(make_readings({}).where("false"), path, 0)
    ledger.price_batch(make_readings({}, {"timestamp": None}), path, 1)
    assert ledger.priced_readings(spark, path).count() == 1
