"""Physical plans: pruning, broadcasts, no Python, no nested loops."""

from __future__ import annotations

import re

import pytest

from checks import stage
from meterlake.operators import star as star_ops
from meterlake.plans import daily, hourly, marts, report
from meterlake.sources import warehouse

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return stage.star(spark, SF_DIR)


@pytest.mark.parametrize("kind, value", [
    ("hora", "2024-01-05 9"), ("dia", "2024-01-05"), ("semana", "2024-W02"), ("mes", "2024-01"),
])
def test_periods_prune_fact_partitions(star, kind, value):
    text = plan(report.report_region(star, kind, value))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    wanted = {"hora": "= 2024-01-05", "dia": "= 2024-01-05", "semana": "weekofyear",
              "mes": "month"}[kind]
    assert any(wanted in f for f in filters)


def test_scans_read_needed_columns_only(star):
    text = plan(marts.v_consumo_por_region(star))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    fact = next(s for s in schemas if "kwh_intervalo" in s)
    assert "voltaje" not in fact and "timestamp_real" not in fact


def test_small_dimensions_are_broadcast(star):
    text = plan(marts.v_consumo_por_region(star))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text and "dim_tiempo" not in text
    assert text.count("Exchange hashpartitioning") == 1
    text = plan(marts.v_picos(star))
    assert text.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in text


def test_homes_join_after_the_aggregation(star):
    text = plan(marts.v_consumo_por_hogar(star))
    assert text.index("Join [hogar_key") < text.index("HashAggregate")


def test_top_lists_do_not_sort_everything(star):
    for df in (marts.top_picos(star), marts.picos(star),
               report.report_homes(star, "mes", "2024-01"),
               report.report_peaks(star, "mes", "2024-01")):
        assert "TakeOrderedAndProject" in plan(df)


def test_rollups_answer_without_the_facts(star):
    for df in (hourly.consumo_por_region(star), hourly.perfil_horario(star), hourly.picos_por_hora(star), hourly.heatmap(star),
               hourly.report_profile(star, "hora", "2024-01-05 9"), daily.consumo_por_hogar(star),
               daily.top_picos(star), daily.report_peaks(star, "semana", "2024-W02"), daily.resumen(star),
               daily.preview_resumen(star, "mes", "2024-01"), daily.hogares_por_periodo(star, "semana")):
        tables = {t for t in warehouse.DATED if t in plan(df)}
        assert tables and not tables & {"fact_consumo", "dim_tiempo"}
    assert "fact_resumen_diario" not in plan(daily.resumen(star))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(hourly.report_region(star, "dia", "2024-01-05")))
    assert any("= 2024-01-05" in f for f in filters)


def test_both_rollups_take_one_pass(star):
    text = plan(star_ops.resumenes(star.fact))
    assert text.count("Scan parquet") == 1 and "Expand" in text and text.count("Exchange hashpartitioning") == 1


def test_a_days_homes_prune_partitions_and_meet_as_bitmaps(star):
    text = plan(daily.preview_resumen(star, "dia", "2024-01-05"))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert sum("= 2024-01-05" in f for f in filters) == 2 and "partial_bitmap_or_agg" in text and "distinct" not in text


def test_biggest_peaks_are_cut_before_the_shuffle(star):
    text = plan(star_ops.biggest_peaks(star.fact))
    assert text.count("WindowGroupLimit") == 2
    assert max(r["count"] for r in star.picos_mayores.groupBy("fecha").count().collect()) <= 10
