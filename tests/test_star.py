from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterlake.fixed_values import METERS, TARIFFS, Meter
from meterlake.operators import star as ops
from meterlake.operators.books import meter_registry
from meterlake.operators.features import transform
from meterlake.plans import daily, marts, report
from meterlake.sources import lake, warehouse

START = datetime(2024, 1, 5, 10)


def load(spark, paths, df, batch="0"):
    warehouse.load_star(transform(df), paths.star, batch)
    return warehouse.open_star(spark, paths.star)


@pytest.fixture
def odd_star(spark, installation, make_readings):
    """One ordinary reading, one of an unknown home, one with an unknown tariff."""
    return load(spark, installation, make_readings(
        {"kwh_intervalo": 1.0},
        {"kwh_intervalo": 2.0, "id_hogar": "HOG-999", "es_pico": 1},
        {"kwh_intervalo": 4.0, "tarifa": "9X", "timestamp": START + timedelta(days=1)},
    ))


def test_misses_keep_the_fact_with_a_null_key(odd_star):
    rows = {r.kwh_intervalo: r for r in odd_star.fact.collect()}
    assert len(rows) == 3
    assert rows[2.0].hogar_key is None and rows[2.0].region_key == 1
    assert rows[4.0].region_key is None and rows[4.0].hogar_key is not None
    assert rows[4.0].costo_mxn == 3.816
    assert all(r.tiempo_key for r in rows.values())


def test_inner_joins_drop_null_keys_but_totals_keep_them(odd_star):
    assert marts.v_resumen_general(odd_star).first().kwh_total == 7.0
    assert marts.warehouse_totals(odd_star).first().total == 3
    by_region = marts.consumo_region(odd_star).collect()
    assert [(r.region, r.kwh) for r in by_region] == [("1", 3.0)]
    by_home = marts.ranking_hogares(odd_star).collect()
    assert [(r.id_hogar, r.kwh) for r in by_home] == [("HOG-001", 1.0)]
    assert marts.v_picos(odd_star).count() == 0
    assert marts.top_picos(odd_star).count() == 0
    assert marts.picos(odd_star).count() == 1
    assert report.report_peaks(odd_star, "mes", "2024-01").count() == 0
    assert report.ranked_homes(odd_star, "mes", "2024-01").count() == 1
    preview = report.preview_resumen(odd_star, "mes", "2024-01").first()
    assert (preview.lecturas, preview.kwh, preview.kwh_fmt, preview.hogares) == (3, 7.0, "7.000", 1)


def test_null_keys_form_rollup_groups(odd_star):
    rows = odd_star.resumen_diario.collect()
    assert sorted((str(r.fecha), r.hogar_key is None, r.region_key is None, r.kwh_total)
                  for r in rows) == [
        ("2024-01-05", False, False, 1.0), ("2024-01-05", True, False, 2.0),
        ("2024-01-06", False, True, 4.0),
    ]


def test_rollup_is_the_aggregate_of_the_facts(odd_star):
    recomputed = ops.resumen_diario(odd_star.fact)
    stored = odd_star.resumen_diario.select(*recomputed.columns)
    assert recomputed.exceptAll(stored).isEmpty() and stored.exceptAll(recomputed).isEmpty()


def test_no_foreign_key_is_dangling(odd_star):
    assert {r.tabla: r.filas for r in ops.fk_violations(odd_star).collect()} == {
        "dim_tiempo": 0, "dim_hogar": 0, "dim_region": 0,
    }
    broken = ops.Star(odd_star.fact, odd_star.tiempo.where("false"), odd_star.region,
                      odd_star.hogar)
    assert {r.tabla: r.filas for r in ops.fk_violations(broken).collect()}["dim_tiempo"] == 3


def test_creating_twice_changes_nothing(spark, installation):
    before = warehouse.open_star(spark, installation.star).hogar.collect()
    warehouse.create_star(spark, installation.star, meter_registry(spark))
    star = warehouse.open_star(spark, installation.star)
    assert sorted(star.hogar.collect()) == sorted(before) and len(before) == 8
    assert [r.region for r in star.region.orderBy("region_key").collect()] == [
        "1", "1B", "1E", "1F", "1C",
    ]


def test_home_keys_survive_growth(spark, installation):
    before = {r.id_hogar: r.hogar_key for r in
              warehouse.open_star(spark, installation.star).hogar.collect()}
    more = [Meter(f"MED-{i:05d}", f"HOG-{i:05d}", "Mérida", "1F", 1.0) for i in range(3000)]
    warehouse.create_star(spark, installation.star, meter_registry(spark, [*METERS, *more]))
    hogar = warehouse.open_star(spark, installation.star).hogar
    after = {r.id_hogar: r.hogar_key for r in hogar.collect()}
    assert len(after) == 3008 and len(set(after.values())) == 3008
    assert all(after[k] == v for k, v in before.items())
    assert ops.pk_duplicates(hogar, "hogar_key").isEmpty()


def test_region_keys_survive_a_longer_book(spark, installation):
    book = (TARIFFS[0], TARIFFS[0]._replace(clave="1A", ciudades=()), *TARIFFS[1:],
            TARIFFS[0]._replace(clave="2", ciudades=()))
    warehouse.create_star(spark, installation.star, meter_registry(spark), book)
    region = warehouse.open_star(spark, installation.star).region
    assert [(r.region_key, r.region) for r in region.orderBy("region_key").collect()] == [
        (1, "1"), (2, "1B"), (3, "1E"), (4, "1F"), (5, "1C"), (6, "1A"), (7, "2"),
    ]


def test_profile_of_one_hour_is_left_out(odd_star):
    assert report.period_report(odd_star, "dia", "2024-01-05")["perfil"].count() == 0
    assert report.report_profile(odd_star, "dia", "2024-01-05").count() == 1


def test_first_row_of_a_key_wins(spark):
    registry = meter_registry(spark, [
        Meter("MED-2", "HOG-A", "Mérida", "1F", 1.0), Meter("MED-1", "HOG-A", "Veracruz", "1C", 1.0),
    ])
    _, hogar = ops.seed_dims(spark, registry)
    assert [(r.id_medidor, r.region_key) for r in hogar.collect()] == [("MED-1", 5)]


def test_merge_new_keys(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), ("b", 2), ("c", None)],
                                "k string, v int")
    assert sorted(tuple(r) for r in ops.merge_new_keys(old, new, "k").collect()) == [
        ("b", 2), ("c", None),
    ]


def test_same_batch_twice_is_once(spark, installation, make_readings):
    df = make_readings({}, {"timestamp": START + timedelta(days=40)})
    load(spark, installation, df, "7")
    star = load(spark, installation, df, "7")
    assert star.fact.count() == 2 and star.tiempo.count() == 2
    assert star.resumen_diario.agg(F.sum("num_lecturas")).first()[0] == 2
    star = load(spark, installation, df, "8")
    assert star.fact.count() == 4 and star.tiempo.count() == 2


def test_late_reading_changes_its_date_only(spark, installation, make_readings):
    load(spark, installation, make_readings({}, {"timestamp": START + timedelta(days=1)}), "0")
    before = warehouse.open_star(spark, installation.star).resumen_diario
    other_day = [f for f in before.inputFiles() if "fecha=2024-01-06" in f]
    star = load(spark, installation, make_readings({"kwh_intervalo": 0.5}), "1")
    rows = {str(r.fecha): r for r in star.resumen_diario.collect()}
    assert rows["2024-01-05"].kwh_total == 1.5 and rows["2024-01-05"].num_lecturas == 2
    assert rows["2024-01-05"].kwh_max == 1.0 and rows["2024-01-05"].kwh_promedio == 0.75
    assert rows["2024-01-06"].num_lecturas == 1
    files = star.resumen_diario.inputFiles()
    assert other_day and [f for f in files if "fecha=2024-01-06" in f] == other_day


def test_touched_dates_prune_by_range_and_semi_join(spark, installation, make_readings):
    rows = [{"timestamp": START + timedelta(days=i)} for i in range(6)]
    star = load(spark, installation, make_readings(*rows))
    dates = star.fact.where("day(fecha) in (6, 8)").select("fecha")
    found = warehouse.touched_dates(star.fact, dates)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2 and "LeftSemi" in plan
    assert "fecha#" in plan and ">= 2024-01-06" in plan and "<= 2024-01-08" in plan
    assert warehouse.touched_dates(star.fact, dates.where("false")).count() == 0


@pytest.mark.parametrize("days", [10, 401])
def test_any_number_of_dates_gives_the_same_stored_form(spark, installation, make_readings, days):
    rows = [{"timestamp": START + timedelta(days=i)} for i in range(days)]
    load(spark, installation, make_readings(*rows), "7")
    stored = warehouse.read_table(spark, installation.star, "fact_resumen_diario")
    assert {r.batch_id for r in stored.collect()} == {"7"} and stored.count() == days


def test_sql_over_views(spark, odd_star):
    warehouse.register_views(spark, odd_star)
    rows = warehouse.query(
        spark, "SELECT id_hogar, kwh_total FROM v_consumo_por_hogar WHERE ciudad = :c",
        c="Ciudad de México",
    ).collect()
    assert [tuple(r) for r in rows] == [("HOG-001", 1.0)]
    assert warehouse.query(spark, "SELECT count(*) AS n FROM v_picos").first().n == 0
    with pytest.raises(Exception, match="nowhere"):
        warehouse.query(spark, "SELECT * FROM nowhere")


def test_empty_warehouse_gives_zeros(spark, installation):
    star = warehouse.open_star(spark, installation.star)
    row = marts.resumen(star).first()
    assert (row.total_lecturas, row.kwh_total, row.costo_total, row.total_picos,
            row.hogares_activos) == (0, 0.0, 0.0, 0, 0)
    assert row.kwh_total_fmt == "0.000000" and row.costo_total_fmt == "$0.000000"
    assert [r.num_picos for r in marts.picos_por_hora(star).collect()] == [0] * 24
    assert marts.dense_heatmap(marts.heatmap(star)).count() == 168
    assert report.preview_resumen(star, "dia", "2024-01-05").count() == 0


def test_shapes_are_complete(odd_star):
    cells = marts.heatmap(odd_star)
    dense = marts.dense_heatmap(cells)
    assert dense.count() == 168 and dense.where("kwh > 0").count() == cells.count() == 2
    matrix = marts.heatmap_matrix(cells).collect()
    assert [r.dia_corto for r in matrix] == ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]
    assert (matrix[4].h10, matrix[5].h10, matrix[0].h10) == (1.5, 4.0, 0.0)
    spanish = cells.withColumn("dia_semana", F.lit(" SÁBADO ")).limit(1)
    assert marts.dense_heatmap(spanish).where("kwh > 0 AND dia = 5").count() == 1
    assert marts.picos_por_hora(odd_star).count() == 24
    series = marts.series_by_region(marts.serie_diaria(odd_star), "fecha", "kwh").collect()
    assert [tuple(r) for r in series] == [("1", "2024-01-05", 3.0)]


def test_days_add_up_to_the_whole(spark, installation, make_readings):
    rows = [{"timestamp": START + timedelta(hours=7 * i), "kwh_intervalo": i / 1000,
             "id_hogar": f"HOG-00{i % 8 + 1}", "tarifa": METERS[i % 8].tarifa} for i in range(60)]
    star = load(spark, installation, make_readings(*rows))
    total = marts.v_resumen_general(star).first().kwh_total
    assert marts.serie_diaria(star).agg(F.round(F.sum("kwh"), 3)).first()[0] == total
    assert total == pytest.approx(sum(range(60)) / 1000)
    parts = report.period_report(star, "mes", "2024-01")
    assert parts["resumen"].first().lecturas == 60
    assert [r.posicion for r in parts["por_hogar"].collect()] == list(range(1, 9))
    assert parts["por_region"].count() == 5
    kwh = [r.kwh for r in parts["por_hogar"].collect()]
    assert kwh == sorted(kwh, reverse=True)


def test_report_export(spark, odd_star, tmp_path):
    parts = report.period_report(odd_star, "dia", "2024-01-05")
    for fmt in ("parquet", "csv", "json"):
        report.write_report(parts, str(tmp_path / fmt), fmt)
        again = spark.read.format(fmt).option("header", True).load(str(tmp_path / fmt / "resumen"))
        assert again.count() == 1 and "lecturas" in again.columns


def test_records(spark, odd_star, tmp_path):
    rows = marts.consumo_region(odd_star)
    assert lake.to_records(rows).first()[0] == '{"region":"1","kwh":3.0,"costo":2.862}'
    lake.write_records(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().kwh == 3.0


def test_homes_are_counted_from_bitmaps(spark):
    """Keys at the edges of buckets, repeated, far apart and missing; dates and batches united in any way."""
    keys = [1, 2, 32_768, 32_769, 65_536, 65_537, 10**12, None]
    rows = [(f"2024-01-0{d}", f"b{b}", k) for d in (5, 6) for b in (0, 1) for i, k in enumerate(keys) if i % 2 == b or d == 5]
    facts = spark.createDataFrame(rows + [("2024-01-05", "b0", 1)], "fecha string, batch_id string, hogar_key long").withColumn("fecha", F.to_date("fecha"))
    parts = ops.active_homes(facts, by=("batch_id",))
    assert ops.count_homes(parts).first().hogares == 7
    assert ops.count_homes(parts.where("fecha = '2024-01-06' AND batch_id = 'b1'")).first().hogares == 3
    merged = ops.merge_active(parts)
    assert merged.groupBy("fecha", "cubeta").count().where("count > 1").isEmpty() and ops.count_homes(merged).first().hogares == 7
    assert merged.exceptAll(ops.active_homes(facts)).isEmpty()
    assert ops.count_homes(parts.where("false")).first().hogares == 0
    assert ops.active_homes(facts.where("hogar_key IS NULL")).isEmpty()
    untimed = facts.withColumn("tiempo_key", F.when(F.col("hogar_key") < 10, 1))
    assert ops.count_homes(ops.active_homes(untimed)).first().hogares == 2


def test_summaries_of_an_empty_warehouse(spark, installation):
    star = warehouse.open_star(spark, installation.star)
    assert daily.resumen(star).first() == marts.resumen(star).first()
    assert daily.resumen_general(star).first().hogares_activos == 0
    assert daily.preview_resumen(star, "mes", "2024-01").isEmpty()
    assert daily.preview_resumen(star, "mes", "2024-01", keep_empty=True).first() == report.preview_resumen(star, "mes", "2024-01", keep_empty=True).first()
    with pytest.raises(ValueError):
        daily.preview_resumen(star, "hora", "2024-01-05 9")
