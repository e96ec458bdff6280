"""Home tables in buckets: plans without a shuffle of the home side, pruned buckets, versions, batches."""

from __future__ import annotations

import re
import shutil

import pytest
from conftest import GOOD, TYPED_READING

from meterlake.operators import books
from meterlake.operators import star as ops
from meterlake.plans import marts
from meterlake.session import constant_frame
from meterlake.sources import files, homes, warehouse
from meterlake.streaming import pipeline

BUCKETS = 8


def readings(spark, *rows):
    full = [{**GOOD, **row} for row in rows]
    return constant_frame(spark, [tuple(r[n] for n in TYPED_READING.names) for r in full], TYPED_READING)


@pytest.fixture
def joined(spark):
    """A session that doesn't broadcast, as with tables too large for it."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture
def site(spark, empty_site, tmp_path):
    paths = pipeline.Paths(str(tmp_path / "it's a site"))
    shutil.copytree(empty_site.root, paths.root)
    homes.publish_homes(spark, paths.star, "hogares_prueba", BUCKETS)
    return paths


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def facts_of(spark, paths) -> list[str]:
    return sorted(str(r.asDict()) for r in warehouse.open_star(spark, paths.star).fact.collect())


def above_home_scans(text: str) -> list[list[str]]:
    """For each bucketed scan of a home table, the operators between it and the join it feeds."""
    lines, found = text.splitlines(), []
    depth = [re.search(r"[A-Za-z*(]", line).start() if line.strip() else 0 for line in lines]
    for i, line in enumerate(lines):
        if re.search(r"FileScan parquet \S*\.(hogares_por|medidores_por).*Bucketed: true", line):
            path, at = [], depth[i]
            for k in range(i - 1, -1, -1):
                if depth[k] < at:
                    at = depth[k]
                    if "Join" in lines[k]:
                        break
                    path.append(lines[k])
            found.append(path)
    return found


def test_the_home_side_is_not_shuffled(joined, site):
    tables = homes.open_homes(joined, "hogares_prueba")
    batch = readings(joined, {}, {"id_hogar": "HOG-002"}, {"id_hogar": None})
    star = homes.with_homes(warehouse.open_star(joined, site.star), tables)
    keyed = batch.join(tables.por_id, "id_hogar", "left")
    for df in (keyed, books.lookup_meter(batch, tables.medidores), ops.join_home(star), marts.v_consumo_por_hogar(star)):
        text = plan(df)
        assert "SortMergeJoin" in text and above_home_scans(text)
        assert not any("Exchange" in line for path in above_home_scans(text) for line in path)
    plain = warehouse.read_table(joined, site.star, "hogar_tarifa")
    assert plan(batch.join(plain, "id_hogar", "left")).count("Exchange") > plan(keyed).count("Exchange")


def test_a_small_batch_opens_the_buckets_of_its_ids(joined, site):
    tables = homes.open_homes(joined, "hogares_prueba")
    batch = readings(joined, {"id_hogar": None}, {"id_medidor": "no such meter", "id_hogar": ""})
    lookup, meters = homes.lookups_of(batch, tables)
    for df, column in ((lookup, "id_hogar"), (meters, "id_medidor")):
        opened = int(re.search(r"SelectedBucketsCount: (\d+) out of 8", plan(batch.select(column).join(df, column, "left"))).group(1))
        assert opened <= 2
    assert [r.id_hogar for r in lookup.collect()] == ["HOG-001"]  # by its meter
    whole = homes.lookups_of(batch, tables, most=1)
    assert [df.count() for df in whole] == [tables.por_id.count(), tables.medidores.count()]
    without = homes.lookups_of(batch.drop("id_hogar", "id_medidor"), tables)
    assert [df.count() for df in without] == [0, 0]
    assert [df.count() for df in homes.lookups_of(batch.limit(0), tables)] == [0, 0]


def test_batches_give_the_same_facts_with_buckets(spark, site, empty_site, tmp_path):
    other = pipeline.Paths(str(tmp_path / "other"))
    shutil.copytree(empty_site.root, other.root)
    rows = [{}, {"id_hogar": None}, {"id_hogar": "", "tarifa": None}, {"id_hogar": "HOG-003", "kwh_intervalo": 2.0},
            {"id_hogar": "nobody", "id_medidor": None}, {}]
    for n in (0, 1, 1):  # the last one comes again
        batch = readings(spark, *rows[n:])
        pipeline.process_batch(batch, n, site, micro_batch=True, database="hogares_prueba")
        pipeline.process_batch(batch, n, other, micro_batch=True)
    assert facts_of(spark, site) == facts_of(spark, other) and len(facts_of(spark, site)) == 11


def test_a_new_version_shows_new_homes_and_removes_the_one_before_last(spark, site):
    first = homes.open_homes(spark, "hogares_prueba").por_id
    n = first.count()
    registry = constant_frame(spark, [tuple(
        {"id_medidor": "MED-NEW", "id_hogar": "HOG-NEW", "ciudad": "Mérida", "tarifa": "1C"}.get(f) for f in warehouse.schemas.REGISTRY.names
    )], warehouse.schemas.REGISTRY)
    warehouse.create_star(spark, site.star, registry)
    second = homes.publish_homes(spark, site.star, "hogares_prueba", BUCKETS)
    assert second.por_id.count() == n + 1 == second.por_clave.count() and first.count() == n
    homes.publish_homes(spark, site.star, "hogares_prueba", BUCKETS)
    assert second.por_id.where("id_hogar = 'HOG-NEW'").count() == 1
    assert len(files.names(spark, f"{site.star}/cubetas")) == 2
    assert len(spark.catalog.listTables("hogares_prueba")) == 9  # three views, two versions


def test_an_interrupted_call_changes_nothing(spark, site, monkeypatch):
    shown = homes.open_homes(spark, "hogares_prueba").por_id.inputFiles()
    read = warehouse.read_table
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "read_table", lambda s, p, t: (_ for _ in ()).throw(OSError("lost")) if t == "medidores" else read(s, p, t))
        with pytest.raises(OSError):
            homes.publish_homes(spark, site.star, "hogares_prueba", BUCKETS)
    assert homes.open_homes(spark, "hogares_prueba").por_id.inputFiles() == shown
    homes.publish_homes(spark, site.star, "hogares_prueba", BUCKETS)
    assert len(files.names(spark, f"{site.star}/cubetas")) == 2
