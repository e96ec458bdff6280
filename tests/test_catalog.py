"""What is published in the catalogue: the same rows as the star, for every session, whatever a fold is doing."""

from __future__ import annotations

import shutil
from datetime import date

import pytest
from conftest import GOOD, TYPED_READING
from test_folds import LATER, batch

from meterlake.operators import star as ops
from meterlake.plans import marts
from meterlake.session import constant_frame
from meterlake.sources import catalog, files, warehouse
from meterlake.streaming import pipeline


@pytest.fixture(scope="module")
def site(spark, empty_site, tmp_path_factory):
    """Three batches over two days, under a path with a quote and a blank."""
    paths = pipeline.Paths(str(tmp_path_factory.mktemp("catalog") / "it's a site"))
    shutil.copytree(empty_site.root, paths.root)

    def make(*rows):
        full = [{**GOOD, **row} for row in rows]
        return constant_frame(spark, [tuple(r[n] for n in TYPED_READING.names) for r in full], TYPED_READING)

    for n in range(3):
        pipeline.process_batch(batch(make, n), n, paths, micro_batch=True)
    return paths


def of_star(spark, path):
    star = warehouse.open_star(spark, path)
    return {
        "fact_consumo": star.fact, "dim_tiempo": star.tiempo, "dim_region": star.region, "dim_hogar": star.hogar,
        "fact_resumen_diario": star.resumen_diario, "fact_resumen_horario": star.resumen_horario,
        "fact_hogares_activos": ops.merge_active(star.hogares_activos),
        "v_consumo_por_region": marts.v_consumo_por_region(star), "v_consumo_por_hogar": marts.v_consumo_por_hogar(star),
        "v_perfil_horario": marts.v_perfil_horario(star), "v_picos": marts.v_picos(star), "v_resumen_general": marts.v_resumen_general(star),
    }


def rows(frames):
    return {name: sorted(str(sorted(r.asDict().items())) for r in df.collect()) for name, df in frames.items()}


def test_a_second_session_finds_the_star_through_folds(spark, site, monkeypatch):
    wanted = rows(of_star(spark, site.star))
    catalog.publish_star(spark, site.star, "prueba")
    other = spark.newSession()

    def seen():
        catalog.refresh_star(other, "prueba")
        return rows({name: other.table(f"prueba.{name}") for name in wanted})

    assert seen() == wanted and len(wanted["fact_consumo"]) == 24
    with monkeypatch.context() as patch:  # written, not committed
        patch.setattr(files, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            warehouse.fold_days(spark, site.star, LATER)
    assert seen() == wanted
    assert warehouse.fold_days(spark, site.star, date(2024, 1, 6), remove=False)  # committed, not finished
    assert seen() == wanted
    warehouse.finish_folds(spark, site.star)
    assert seen() == wanted
    warehouse.fold_days(spark, site.star, LATER)
    assert seen() == wanted
    catalog.publish_star(spark, site.star, "prueba")  # again
    assert seen() == wanted and files.names(spark, f"{site.star}/fact_consumo")


def test_published_views_prune_partitions(spark, site):
    catalog.publish_star(spark, site.star, "prueba")
    df = spark.newSession().sql("SELECT SUM(kwh_intervalo) FROM prueba.fact_consumo WHERE fecha = DATE'2024-01-05'")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "= 2024-01-05" in text.split("PartitionFilters: [")[1].split("]")[0] and "voltaje" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_an_empty_star_and_another_one_by_the_same_name(spark, site, installation):
    catalog.publish_star(spark, site.star, "cambia")
    catalog.publish_star(spark, installation.star, "cambia")
    other = spark.newSession()
    assert other.table("cambia.fact_consumo").count() == 0
    assert rows({"v": other.table("cambia.v_resumen_general")}) == rows({"v": marts.v_resumen_general(warehouse.open_star(spark, installation.star))})
    assert spark.conf.get("spark.sql.hive.manageFilesourcePartitions") == "true"
