"""Folding of closed days: same rows before and after, whatever is interrupted or repeated."""

from __future__ import annotations

import os
import shutil
from datetime import date, datetime, timedelta

import pytest
from conftest import GOOD, TYPED_READING

from meterlake.fixed_values import METERS
from meterlake.operators import star as ops
from meterlake.plans import marts
from meterlake.session import constant_frame
from meterlake.sources import files, warehouse
from meterlake.streaming import pipeline

START = datetime(2024, 1, 5, 10)
LATER = date(2030, 1, 1)


def batch(make_readings, n: int, days: int = 2, rows: int = 4):
    return make_readings(*[
        {"kwh_intervalo": (n * 100 + d * 10 + i) / 1000, "id_hogar": METERS[(n + i) % 4].id_hogar, "id_medidor": METERS[(n + i) % 4].id_medidor,
         "timestamp": START + timedelta(days=d, minutes=7 * i + n), "es_pico": i % 2}
        for d in range(days) for i in range(rows)
    ])


def content(spark, paths):
    star = warehouse.open_star(spark, paths.star)
    return tuple(
        sorted(map(str, df.collect()))
        for df in (star.fact, star.tiempo, star.resumen_diario, marts.v_consumo_por_hogar(star), ops.merge_active(star.hogares_activos))
    )


def parts_of(paths, table, day):
    folder = f"{paths.star}/{table}/fecha={day}"
    return {p: [f for f in os.listdir(f"{folder}/{p}") if f.endswith(".parquet")] for p in os.listdir(folder)}


@pytest.fixture(scope="module")
def loaded_site(spark, empty_site, tmp_path_factory):
    """Three batches over two days, loaded once."""
    paths = pipeline.Paths(str(tmp_path_factory.mktemp("three") / "site"))
    shutil.copytree(empty_site.root, paths.root)

    def make(*rows):
        full = [{**GOOD, **row} for row in rows]
        return constant_frame(spark, [tuple(r[n] for n in TYPED_READING.names) for r in full], TYPED_READING)

    for n in range(3):
        pipeline.process_batch(batch(make, n), n, paths, micro_batch=True)
    return paths


@pytest.fixture
def three(loaded_site, tmp_path):
    paths = pipeline.Paths(str(tmp_path / "site"))
    shutil.copytree(loaded_site.root, paths.root)
    return paths


def test_closed_days_become_one_partition_each(spark, three):
    before = content(spark, three)
    assert warehouse.fold_days(spark, three.star, date(2024, 1, 6)) == [date(2024, 1, 5)]
    assert content(spark, three) == before
    for table in warehouse.DATED:
        closed, still = parts_of(three, table, "2024-01-05"), parts_of(three, table, "2024-01-06")
        assert [len(f) for f in closed.values()] == [1]
        assert all(p.startswith("batch_id=plegado-") for p in closed) and not any("plegado" in p for p in still)
    assert warehouse.fold_days(spark, three.star, date(2024, 1, 6)) == []
    assert warehouse.fold_days(spark, three.star, LATER) == [date(2024, 1, 6)]
    assert content(spark, three) == before
    assert warehouse.fold_days(spark, three.star, LATER, since=date(2024, 1, 7)) == []


def test_late_and_repeated_batches_after_a_fold(spark, three, make_readings, tmp_path, empty_site):
    warehouse.fold_days(spark, three.star, LATER)
    pipeline.process_batch(batch(make_readings, 3, days=1), 3, three, micro_batch=True)    # late
    warehouse.fold_days(spark, three.star, LATER)
    pipeline.process_batch(batch(make_readings, 1), 1, three, micro_batch=True)            # repeated though folded
    pipeline.process_batch(batch(make_readings, 1), 1, three, micro_batch=True)
    star = warehouse.open_star(spark, three.star)
    assert star.fact.count() == 3 * 8 + 4
    wanted = ops.resumen_diario(star.fact)
    assert wanted.exceptAll(star.resumen_diario).isEmpty() and star.resumen_diario.exceptAll(wanted).isEmpty()
    homes = ops.active_homes(star.fact)
    assert homes.exceptAll(ops.merge_active(star.hogares_activos)).isEmpty() and homes.count() == 2
    assert ops.pk_duplicates(star.tiempo, "tiempo_key").isEmpty()
    after = content(spark, three)
    warehouse.fold_days(spark, three.star, LATER)
    assert content(spark, three) == after
    star = warehouse.open_star(spark, three.star)
    assert {r.batch_id for r in star.fact.select("batch_id").distinct().collect()} == {f"0-{n}" for n in range(4)}


@pytest.mark.parametrize("call", [6, 7, 8, 9, 11, 28])
def test_a_fold_interrupted_anywhere_can_be_repeated(spark, three, monkeypatch, call):
    """The call with this number, of all that write or remove something, is the one that fails."""
    before, made = content(spark, three), []

    def failing(real):
        def run(*args, **kwargs):
            made.append(real)
            if len(made) == call + 1:
                raise OSError("lost")
            return real(*args, **kwargs)
        return run

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "_write_fold", failing(warehouse._write_fold))
        patch.setattr(files, "publish", failing(files.publish))
        patch.setattr(files, "remove", failing(files.remove))
        try:
            warehouse.fold_days(spark, three.star, LATER)
        except OSError:
            pass
    assert content(spark, three) == before
    warehouse.fold_days(spark, three.star, LATER)
    assert content(spark, three) == before
    assert all(len(parts_of(three, t, "2024-01-05")) == 1 for t in warehouse.DATED)


def test_replaced_partitions_may_stay_for_running_queries(spark, three):
    before = content(spark, three)
    early = warehouse.open_star(spark, three.star).fact
    warehouse.fold_days(spark, three.star, LATER, remove=False)
    assert early.count() == 24 and content(spark, three) == before
    assert len(parts_of(three, "fact_consumo", "2024-01-05")) == 4
    warehouse.finish_folds(spark, three.star)
    warehouse.finish_folds(spark, three.star)
    assert len(parts_of(three, "fact_consumo", "2024-01-05")) == 1 and content(spark, three) == before


def test_a_batch_lists_its_own_dates_only(spark, three, make_readings):
    """A folder that Spark can't make sense of is no matter to a batch of other dates."""
    for table in warehouse.DATED:
        os.makedirs(f"{three.star}/{table}/otra=1/fecha=2024-01-05")
        with open(f"{three.star}/{table}/otra=1/fecha=2024-01-05/x.parquet", "w") as file:
            file.write("no parquet")
    pipeline.process_batch(batch(make_readings, 4), 4, three, micro_batch=True)
    assert parts_of(three, "fact_resumen_diario", "2024-01-05").keys() == {f"batch_id=0-{n}" for n in (0, 1, 2, 4)}
    with pytest.raises(Exception):
        warehouse.open_star(spark, three.star).fact.count()


def test_nothing_to_fold(spark, installation):
    assert warehouse.fold_days(spark, installation.star, LATER) == []
    warehouse.finish_folds(spark, installation.star)
    assert warehouse.open_star(spark, installation.star).fact.count() == 0
