"""Every registered query of the library against its SQL, on the whole tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from checks.oracles import all_oracles
from checks.queries import REGISTERED

SF_DIR = "/root/testdata/sf0.01"
NOT_IN_PLANS = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
    "BroadcastNestedLoopJoin", "Scan ExistingRDD",
)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTERED) == set(all_oracles())
    assert set(REGISTERED) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, con, name):
    df = REGISTERED[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [word for word in NOT_IN_PLANS if word in plan] == []
    assert compare.difference(df, con, all_oracles()[name]) is None


@pytest.mark.parametrize("name", [
    "resolve_keys", "cost_dwh", "flag_peaks_by_home", "tier_range_join", "v_picos", "report_homes",
    "daily_consumo_por_hogar",
])
def test_without_any_automatic_broadcast(spark, con, name):
    """As when a dimension outgrows the broadcast limit; small skew limits force split joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = REGISTERED[name](spark, SF_DIR)
        assert compare.difference(df, con, all_oracles()[name]) is None
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_known_totals(spark):
    """Figures computed once, independently of both sides above."""
    stats = entry.queries()["batch_stats"](spark, SF_DIR).first()
    assert (stats.filas_raw, stats.filas_limpias, stats.picos_detectados) == (10_000, 6_380, 258)
    general = entry.queries()["v_resumen_general"](spark, SF_DIR).first()
    assert general.kwh_total == 6132.1714
    assert general.costo_total == 5285.111891
    assert general.hogares_activos == 150
    tiers = {r.nivel: (r.filas, r.costo) for r in
             entry.queries()["price_tiered_totals"](spark, SF_DIR).collect()}
    assert tiers == {
        "1": (2855, 22439.622838), "2": (2387, 22697.209082), "3": (1044, 13347.855586),
        "4": (32, 918.351774), "DAC": (62, 4274.54532),
    }
