from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.fixed_values import METERS, TARIFFS
from meterlake.operators import star as ops
from meterlake.operators.features import transform
from meterlake.operators.tariffs import month_to_date, price_tiered
from meterlake.plans import marts
from meterlake.sources import lake, ledger, warehouse
from meterlake.sources.readings import encode_readings, read_readings_stream
from meterlake.streaming import pipeline

START = datetime(2024, 1, 5, 23, 50)


def message(i: int, **extra) -> str:
    meter = METERS[i % 8]
    return json.dumps({
        "timestamp": (START + timedelta(seconds=75 * i)).isoformat(),
        "id_medidor": meter.id_medidor, "id_hogar": meter.id_hogar, "ciudad": meter.ciudad,
        "tarifa": meter.tarifa, "kwh_intervalo": round(0.1 + i / 1000, 6), "potencia_w": 100.0,
        "voltaje": 127.0, "corriente": 0.787, "factor_potencia": 0.9, "es_pico": int(i % 7 == 0),
        "estado": "ok", **extra,
    }, ensure_ascii=False)


def drop_files(folder, files: list[list[str]]):
    folder.mkdir(exist_ok=True)
    for lines in files:
        n = len(list(folder.iterdir()))
        file = folder / f"{n:04d}.jsonl"
        file.write_text("\n".join(lines) + "\n", encoding="utf-8")
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def stream(spark, source):
    return read_readings_stream(spark, source, fmt="text", max_files_per_trigger=1)


def test_stream_equals_batch(spark, installation, tmp_path):
    lines = [message(i) for i in range(24)]
    lines[5] = message(5, kwh_intervalo=None, voltaje=None, estado="señal_debil")
    source = drop_files(tmp_path / "in", [lines[:8], [*lines[8:16], "{broken"], lines[16:]])
    seen = {}
    pipeline.drain(stream(spark, source), installation, on_batch=seen.__setitem__)
    assert [seen[i]["filas_raw"] for i in range(3)] == [8, 9, 8]
    assert [seen[i]["filas_limpias"] for i in range(3)] == [7, 8, 8]
    assert sum(s["picos_detectados"] for s in seen.values()) == 4

    star = warehouse.open_star(spark, installation.star)
    assert star.fact.count() == 23
    general = marts.v_resumen_general(star).first()
    wanted = sum(round(0.1 + i / 1000, 6) for i in range(24) if i != 5)
    assert general.kwh_total == pytest.approx(wanted, abs=1e-9)
    assert general.total_picos == 4 and general.hogares_activos == 8
    assert pipeline.running_totals(spark, installation).first().total == 23
    assert [r.fecha.day for r in star.resumen_diario.select("fecha").distinct()
            .orderBy("fecha").collect()] == [5, 6]
    broken = pipeline.read_quarantine(spark, installation).collect()
    assert [r.registro_corrupto for r in broken] == ["{broken"]


def test_failed_attempt_then_restart_leaves_one_copy(spark, installation, tmp_path, monkeypatch):
    source = drop_files(tmp_path / "in", [[message(i) for i in range(8)]])
    honest = warehouse.refresh_daily

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(warehouse, "refresh_daily", lost)
    with pytest.raises(Exception, match="lost"):
        pipeline.drain(stream(spark, source), installation)
    assert warehouse.open_star(spark, installation.star).fact.count() == 8

    monkeypatch.setattr(warehouse, "refresh_daily", honest)
    drop_files(tmp_path / "in", [[message(i) for i in range(8, 12)]])
    pipeline.drain(stream(spark, source), installation)
    star = warehouse.open_star(spark, installation.star)
    assert star.fact.count() == 12
    assert star.resumen_diario.agg(F.sum("num_lecturas")).first()[0] == 12
    raw_schema = spark.read.parquet(f"{installation.raw}/year=*/month=*/day=*/batch_id=*").schema
    assert lake.read_raw(spark, installation.raw, raw_schema).count() == 12


def daily_is_that_of_the_facts(spark, paths):
    star = warehouse.open_star(spark, paths.star)
    wanted = ops.resumen_diario(star.fact)
    stored = star.resumen_diario.select(*wanted.columns)
    return wanted.exceptAll(stored).isEmpty() and stored.exceptAll(wanted).isEmpty()


def test_rollup_grows_batch_by_batch(spark, installation, make_readings):
    """Two dates, repeated batches, another run and a batch load in between."""
    def batch(n):
        return make_readings(*[
            {"kwh_intervalo": (n * 7 + i) / 1000, "id_hogar": METERS[i % 3].id_hogar,
             "timestamp": START + timedelta(minutes=10 * i + n), "es_pico": i % 2}
            for i in range(3)
        ])

    def run(n, name="0", micro=True):
        pipeline.process_batch(batch(n), n, installation, run=name, micro_batch=micro)

    for n in (0, 1, 1, 2):
        run(n)
        assert daily_is_that_of_the_facts(spark, installation)
    stored = warehouse.read_table(spark, installation.star, "fact_resumen_diario")
    assert {r.batch_id for r in stored.collect()} == {"0-0", "0-1", "0-2"}
    run(1)                      # an older batch once more
    assert daily_is_that_of_the_facts(spark, installation)
    run(0, "other")             # a replay beside it
    assert daily_is_that_of_the_facts(spark, installation)
    run(9, "load", micro=False)
    run(3)
    run(4)
    assert daily_is_that_of_the_facts(spark, installation)
    assert warehouse.open_star(spark, installation.star).fact.count() == 21


def test_a_lost_rollup_is_recomputed_from_its_facts(spark, installation, make_readings):
    for n in range(2):
        pipeline.process_batch(make_readings({}), n, installation, micro_batch=True)
    empty = warehouse.read_table(spark, installation.star, "fact_resumen_diario").where("false")
    empty.write.mode("overwrite").partitionBy("fecha", "batch_id").parquet(
        f"{installation.star}/fact_resumen_diario"
    )
    pipeline.process_batch(make_readings({}), 2, installation, micro_batch=True)
    facts = warehouse.open_star(spark, installation.star).fact
    warehouse.refresh_daily(facts.select("fecha"), installation.star)
    assert daily_is_that_of_the_facts(spark, installation)


def test_all_failed_batch_is_stored_raw_only(spark, installation, tmp_path):
    bad = [message(i, kwh_intervalo=None, estado="bateria_baja") for i in range(3)]
    source = drop_files(tmp_path / "in", [bad, [message(3)]])
    seen = {}
    pipeline.drain(stream(spark, source), installation, on_batch=seen.__setitem__)
    assert seen[0] == {"filas_raw": 3, "filas_limpias": 0, "filas_eliminadas": 3,
                       "picos_detectados": 0}
    assert seen[1]["filas_limpias"] == 1
    assert warehouse.open_star(spark, installation.star).fact.count() == 1


def test_late_readings_arrive_in_a_later_batch(spark, installation, tmp_path):
    late = message(1, timestamp="2023-12-31T23:59:59")
    source = drop_files(tmp_path / "in", [[message(0)], [late]])
    pipeline.drain(stream(spark, source), installation)
    star = warehouse.open_star(spark, installation.star)
    assert [str(r.fecha) for r in star.resumen_diario.orderBy("fecha").collect()] == [
        "2023-12-31", "2024-01-05",
    ]
    assert star.tiempo.where("tiempo_key = 202312312345").count() == 1


def test_replay_of_the_raw_lake_equals_the_direct_run(spark, installation, make_readings):
    rows = [{"kwh_intervalo": i / 10, "timestamp": START + timedelta(minutes=i)} for i in range(60)]
    df = make_readings(*rows)
    for n, part in enumerate((df.where("minute(timestamp) < 20"),
                              df.where("minute(timestamp) >= 20"))):
        pipeline.process_batch(part, n, installation)
    again = lake.reprocess_raw(spark, installation.raw, df.schema)
    direct = transform(df).select(*again.columns)
    assert again.exceptAll(direct).isEmpty() and direct.exceptAll(again).isEmpty()


def test_replay_with_a_new_checkpoint(spark, installation, tmp_path):
    from meterlake.operators.books import meter_registry

    source = drop_files(tmp_path / "in", [[message(i) for i in range(4)]])
    pipeline.drain(stream(spark, source), installation)
    other = pipeline.Paths(str(tmp_path / "replayed"))
    warehouse.create_star(spark, other.star, meter_registry(spark))
    pipeline.drain(stream(spark, source), other, run="v2")
    first, second = (warehouse.open_star(spark, p.star).fact.drop("batch_id")
                     for p in (installation, other))
    assert first.exceptAll(second).isEmpty() and second.count() == 4


def test_layout_of_the_lakes(spark, installation, make_readings):
    df = make_readings({}, {"timestamp": datetime(2023, 9, 1)})
    clock = datetime(2026, 3, 5, 1, 2)
    assert lake.write_raw(df, installation.raw, "0-0", clock).endswith(
        "/raw/year=2026/month=03/day=05/batch_id=0-0"
    )
    lake.write_processed(transform(df), installation.processed, "0-0")
    stored = lake.read_processed(spark, installation.processed, transform(df).schema)
    assert sorted((r.year, r.month) for r in stored.collect()) == [("2023", "09"), ("2024", "01")]
    files = spark.read.option("recursiveFileLookup", True).parquet(installation.processed)
    assert not {"year", "month", "batch_id"} & set(files.columns)


def test_repeated_readings_are_kept_unless_asked(installation, make_readings):
    df = make_readings({}, {})
    key = ("id_medidor", "timestamp")
    assert pipeline.process_batch(df, 0, installation)["filas_limpias"] == 2
    assert pipeline.process_batch(df, 1, installation, unique=key)["filas_limpias"] == 1


def test_messages_stay_as_received(spark, installation, tmp_path):
    """A key the schema lacks, odd spacing and a broken message come back from the raw lake; then the key is read."""
    lines = [message(0, firmware="1.2"), "  " + message(1), "{broken", message(2, firmware="1.3", estado="apagado")]
    source = drop_files(tmp_path / "in", [lines])
    pipeline.drain(stream(spark, source), installation)
    stored = [r.mensaje for r in lake.read_messages(spark, installation.raw).collect()]
    assert sorted(stored) == sorted(lines)
    field = T.StructField("firmware", T.StringType())
    again = lake.reprocess_messages(spark, installation.raw, [field])
    assert sorted((r.id_medidor, r.firmware) for r in again.collect()) == [("MED-001", "1.2"), ("MED-002", None)]
    assert "mensaje" not in again.columns
    assert lake.decode_again(spark, installation.raw).count() == 4
    assert warehouse.open_star(spark, installation.star).fact.count() == 2


def test_month_prices_in_the_stream(spark, installation, tmp_path):
    """Three micro-batches, the last one late: the ledger holds the prices of one run over everything."""
    kwh = {i: 4.9 if i % 8 == 0 else 0.5 for i in range(96)}
    on_time = [message(i, kwh_intervalo=kwh[i]) for i in range(96) if i % 5]
    late = [message(i, kwh_intervalo=kwh[i]) for i in range(96) if i % 5 == 0]
    source = drop_files(tmp_path / "in", [on_time[:40], on_time[40:], late])
    books = [t._replace(bloques=tuple(b._replace(limite_kwh=b.limite_kwh and 2.0) for b in t.bloques), dac_kwh_mes=9) for t in TARIFFS]
    pipeline.drain(stream(spark, source), installation, books=books, monthly=True)
    everything = lake.read_processed(spark, installation.processed, spark.read.parquet(installation.processed).schema)
    wanted = price_tiered(month_to_date(everything), books)
    columns = ["id_hogar", "timestamp", "kwh_intervalo", "nivel", "costo_mxn"]
    got = ledger.priced_readings(spark, installation.star)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, wanted.select(columns).collect()))
    assert ledger.read_ledger(spark, installation.star).where("signo < 0").count() > 0
    assert len({r.nivel for r in got.collect()}) > 2


def test_files_are_admitted_by_their_bytes(spark, installation, tmp_path):
    """Three triggers: two files fit into the first, a large one comes alone, the rest follows."""
    files = [[message(0)], [message(1)], [message(i) for i in range(2, 8)], [message(8)]]
    source = drop_files(tmp_path / "in", files)
    size = len(message(0).encode()) + 1
    limited = read_readings_stream(spark, source, fmt="text", max_bytes_per_trigger=2 * size + size // 2)
    seen = {}
    pipeline.drain(limited, installation, on_batch=seen.__setitem__)
    assert [seen[i]["filas_raw"] for i in range(len(seen))] == [2, 6, 1]
    assert warehouse.open_star(spark, installation.star).fact.count() == 9


def test_encoding_is_the_message_form(make_readings):
    text = encode_readings(make_readings({})).first().value
    assert json.loads(text)["timestamp"] == "2024-01-05T10:07:30"
    assert list(json.loads(text)) == list(json.loads(message(0)))


def test_kafka_needs_its_connector(spark):
    """Without the connector on the class path the source says so; no broker is contacted."""
    with pytest.raises(Exception, match="kafka"):
        read_readings_stream(spark, "readings", servers="nowhere:9092")
