from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from meterlake.fixed_values import TARIFFS, Block, Meter, Tariff
from meterlake.operators import books, tariffs
from meterlake.operators.books import meter_registry


def brute_price(tariff: Tariff, total: Decimal, kwh: Decimal) -> Decimal:
    """The tariff rule for one reading, written out."""
    price = Decimal(str(tariff.dac_precio))
    if total < Decimal(str(tariff.dac_kwh_mes)):
        upper = Decimal(0)
        for block in tariff.bloques:
            price = Decimal(str(block.precio))
            if block.limite_kwh is None:
                break
            upper += Decimal(str(block.limite_kwh))
            if total < upper:
                break
    return (kwh * price).quantize(Decimal("0.000001"), ROUND_HALF_UP)


@pytest.mark.parametrize("total, price", [
    (0.0, 0.954), (74.999999, 0.954), (75.0, 1.013), (214.999999, 1.013), (215.0, 1.313),
    (465.0, 3.397), (499.999999, 3.397), (500.0, 6.18), (1e6, 6.18),
])
def test_block_edges(make_readings, total, price):
    df = make_readings({"kwh_intervalo": 1.0}).withColumn("kwh_acumulado_mes", F.lit(total))
    assert tariffs.price_tiered(df).first().costo_mxn == price


def test_price_never_falls_with_the_total(spark, make_readings):
    totals = spark.range(0, 2000, 5).select(F.col("id").cast("double").alias("kwh_acumulado_mes"))
    for tariff in TARIFFS:
        df = totals.withColumns({"kwh_intervalo": F.lit(1.0), "tarifa": F.lit(tariff.clave)})
        prices = [r.costo_mxn for r in
                  tariffs.price_tiered(df).orderBy("kwh_acumulado_mes").collect()]
        assert len(prices) == 400 and prices == sorted(prices)


def test_every_total_has_exactly_one_block(spark):
    for tariff in TARIFFS:
        rows = books.tier_bounds(spark).where(F.col("tarifa") == tariff.clave).orderBy("desde")
        bounds = [(r.desde, r.hasta) for r in rows.collect()]
        assert bounds[0][0] == 0 and bounds[-1] == (tariff.dac_kwh_mes, None)
        assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))


def test_a_book_without_reachable_limit_keeps_its_open_block(spark):
    book = (Tariff("X", ("A",), (Block(10, 1.0), Block(None, 2.0)), 1000, 3.0),)
    rows = books.tier_bounds(spark, book).orderBy("desde").collect()
    assert [(r.nivel, r.desde, r.hasta, r.precio) for r in rows] == [
        ("1", 0.0, 10.0, 1.0), ("2", 10.0, 1000.0, 2.0), ("DAC", 1000.0, None, 3.0),
    ]


def test_lake_and_warehouse_cost_differ_when_tariff_and_city_disagree(spark, make_readings):
    df = make_readings({"tarifa": "1E", "kwh_intervalo": 2.0})
    assert tariffs.cost_etl(df).first().costo_mxn == 1.57
    assert tariffs.cost_dwh(df, meter_registry(spark)).first().costo_dwh == 1.908


def test_defaults(spark, make_readings):
    rows = [
        {"id_hogar": None, "tarifa": None, "id_medidor": "MED-003"},
        {"id_hogar": "", "tarifa": "", "id_medidor": "MED-005"},
        {"id_hogar": None, "tarifa": None, "id_medidor": "MED-999"},
        {"id_hogar": "HOG-999", "tarifa": "1C", "id_medidor": "MED-999"},
        {"id_hogar": "HOG-007", "tarifa": None, "id_medidor": None},
    ]
    df = tariffs.resolve_home_tariff(make_readings(*rows), meter_registry(spark))
    got = sorted((r.hogar_resuelto, r.tarifa_resuelta) for r in df.collect())
    assert got == [
        ("", "1"), ("HOG-003", "1B"), ("HOG-005", "1E"), ("HOG-007", "1"), ("HOG-999", "1C"),
    ]
    bare = make_readings({}, columns=["timestamp", "kwh_intervalo"])
    row = tariffs.resolve_home_tariff(bare, meter_registry(spark)).first()
    assert (row.hogar_resuelto, row.tarifa_resuelta) == ("", "1")


def test_unknown_home_is_priced_by_its_own_tariff(spark, make_readings):
    df = make_readings({"id_hogar": "HOG-999", "tarifa": "1C"}, {"id_hogar": "HOG-999",
                                                                 "tarifa": "??"})
    costs = sorted(r.costo_dwh for r in tariffs.cost_dwh(df, meter_registry(spark)).collect())
    assert costs == [0.859, 0.954]


def test_city_served_by_two_tariffs_takes_the_first(spark, make_readings):
    second = TARIFFS[1]._replace(ciudades=("Ciudad de México", "Puebla"))
    book = (TARIFFS[0], second)
    df = make_readings({}, {"ciudad": "Puebla"}, {"ciudad": "Otra"}, {"ciudad": None})
    got = [(r.ciudad, r.tarifa_ciudad) for r in books.tariff_of_city(df, book).collect()]
    assert sorted(got, key=str) == sorted(
        [("Ciudad de México", "1"), ("Puebla", "1B"), ("Otra", "1"), (None, "1")], key=str
    )


def test_cost_rounds_half_up(make_readings):
    df = make_readings({"kwh_intervalo": 0.0005}, {"kwh_intervalo": 0.000001})
    assert sorted(r.costo_mxn for r in tariffs.cost_etl(df).collect()) == [1e-06, 0.000477]


def test_month_to_date_against_brute_force(spark, make_readings):
    """One home has most readings, several share a timestamp, two months and midnight."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        home = "HOG-001" if rng.random() < 0.7 else f"HOG-00{rng.randint(2, 4)}"
        ts = datetime(2024, 1, 31, 20) + timedelta(minutes=rng.randint(0, 480))
        rows.append({"id_hogar": home, "timestamp": ts, "kwh_intervalo": rng.randint(0, 5000) / 1000,
                     "potencia_w": float(i)})
    rows += [
        {"id_hogar": "HOG-001", "timestamp": datetime(2024, 1, 31, 23, 59, 59), "potencia_w": 900.0},
        {"id_hogar": "HOG-001", "timestamp": datetime(2024, 2, 1), "potencia_w": 901.0},
        {"id_hogar": None, "timestamp": datetime(2024, 1, 31, 23), "potencia_w": 902.0},
        {"id_hogar": None, "timestamp": datetime(2024, 1, 31, 23, 30), "potencia_w": 903.0},
    ]
    full = [{"kwh_intervalo": 1.0, **r} for r in rows]
    expected, running = {}, defaultdict(Decimal)
    for r in sorted(full, key=lambda r: (r["timestamp"], r["potencia_w"])):
        key = (r["id_hogar"], r["timestamp"].year, r["timestamp"].month)
        expected[r["potencia_w"]] = float(running[key])
        if r["id_hogar"] is not None:
            running[key] += Decimal(str(r["kwh_intervalo"]))
    df = tariffs.month_to_date(make_readings(*full), tiebreak=["potencia_w"])
    assert {r.potencia_w: r.kwh_acumulado_mes for r in df.collect()} == expected


def test_tiered_price_against_brute_force(make_readings):
    rng = random.Random(11)
    rows = [
        {"tarifa": rng.choice(TARIFFS).clave, "kwh_intervalo": rng.randint(0, 5_000_000) / 1e6,
         "potencia_w": rng.randint(0, 1200) + rng.choice([0.0, 0.999999])}
        for _ in range(300)
    ]
    by_key = {t.clave: t for t in TARIFFS}
    df = make_readings(*rows).withColumn("kwh_acumulado_mes", F.col("potencia_w"))
    for r in tariffs.price_tiered(df).collect():
        assert r.costo_mxn == float(brute_price(
            by_key[r.tarifa], Decimal(str(r.potencia_w)), Decimal(str(r.kwh_intervalo))
        ))


def test_first_meter_of_a_home_sets_its_tariff(spark):
    registry = meter_registry(spark, [
        Meter("MED-2", "HOG-A", "Monterrey", "1E", 1.0),
        Meter("MED-1", "HOG-A", "Mérida", "1F", 1.0),
    ])
    assert [tuple(r) for r in tariffs.home_tariffs(registry).collect()] == [("HOG-A", "1F")]


CLOSED = Tariff("R1", ("A",), (Block(10, 1.0), Block(10, 2.0)), 500, 9.0)
SINGLE = Tariff("R2", ("B",), (Block(5, 1.5),), 100, 9.0)
ONLY_DAC = Tariff("R3", ("C",), (), 300, 7.0)


@pytest.mark.parametrize("book, prices", [
    (CLOSED, [1.0, 1.0, 2.0, 2.0, 2.0, 9.0, None]),
    (SINGLE, [1.5, 1.5, 1.5, 1.5, 9.0, 9.0, None]),
    (ONLY_DAC, [7.0, 7.0, 7.0, 7.0, 7.0, 7.0, None]),
])
def test_every_total_has_a_price(spark, book, prices):
    totals = [-1.0, 0.0, 15.0, 25.0, 499.0, 500.0, None]
    rows = [(i, book.clave, t, 1.0) for i, t in enumerate(totals)]
    df = spark.createDataFrame(rows, "i int, tarifa string, kwh_acumulado_mes double, kwh_intervalo double")
    out = tariffs.price_tiered(df, [book], default=book.clave).orderBy("i").collect()
    assert [r.costo_mxn for r in out] == prices


def test_codes_unknown_to_the_book(spark):
    df = spark.createDataFrame([("1",), ("R1",), (None,)], "tarifa string")
    assert books.lookup_tariff(df, [CLOSED], default="R1").count() == 3
    with pytest.raises(ValueError):
        books.lookup_tariff(df, [CLOSED])


def test_month_to_date_keeps_odd_readings(spark, make_readings):
    noon = datetime(2024, 1, 5, 12)
    out = tariffs.month_to_date(make_readings(
        {"id_hogar": None, "kwh_intervalo": 600.0, "timestamp": noon},
        {"id_hogar": "", "kwh_intervalo": 1.0, "timestamp": noon},
        {"id_hogar": "H", "kwh_intervalo": 5.0, "timestamp": datetime(2024, 2, 29, 23)},
        {"id_hogar": "H", "kwh_intervalo": 2.0, "timestamp": datetime(2024, 3, 2)},
        {"id_hogar": "H", "kwh_intervalo": 1.0, "timestamp": None},
        {"id_hogar": "T", "kwh_intervalo": 1.0, "id_medidor": "MED-002", "timestamp": noon},
        {"id_hogar": "T", "kwh_intervalo": 3.0, "id_medidor": "MED-001", "timestamp": noon},
    ), slice_length="7 days")
    rows = sorted((r.id_hogar or "", r.kwh_intervalo, r.kwh_acumulado_mes) for r in out.collect())
    assert rows == [
        ("", 1.0, 0.0), ("", 600.0, 0.0), ("H", 1.0, None), ("H", 2.0, 0.0), ("H", 5.0, 0.0),
        ("T", 1.0, 3.0), ("T", 3.0, 0.0),
    ]


def test_numbers_that_are_none(spark):
    from meterlake.functions import exact

    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    row = df.agg(exact.exact_sum(F.col("x")).alias("s"), exact.exact_avg(F.col("x")).alias("a")).first()
    assert (row.s, row.a) == (1.5, 1.5)
    for bad in (float("inf"), 1e300):
        with pytest.raises(Exception, match="beyond exact sums"):
            spark.createDataFrame([(bad,)], "x double").agg(exact.exact_sum(F.col("x"))).collect()
