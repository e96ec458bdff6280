from __future__ import annotations

import os
import shutil
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from pyspark.sql import types as T  # noqa: E402

from meterlake import schemas  # noqa: E402
from meterlake.session import builder, constant_frame  # noqa: E402

TYPED_READING = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()), *schemas.READING.fields[1:],
])
GOOD = {
    "timestamp": datetime(2024, 1, 5, 10, 7, 30), "id_medidor": "MED-001", "id_hogar": "HOG-001",
    "ciudad": "Ciudad de México", "tarifa": "1", "kwh_intervalo": 1.0, "potencia_w": 1000.0,
    "voltaje": 127.0, "corriente": 7.874, "factor_potencia": 0.9, "es_pico": 0, "estado": "ok",
}


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_readings(spark):
    """Readings from partial rows: what is not given is that of a good reading."""

    def make(*rows: dict, columns: list[str] | None = None):
        full = [{**GOOD, **row} for row in rows]
        frame = constant_frame(
            spark, [tuple(r[n] for n in TYPED_READING.names) for r in full], TYPED_READING
        )
        return frame.select(*columns) if columns else frame

    return make


@pytest.fixture(scope="session")
def empty_site(spark, tmp_path_factory):
    """An empty star with the default meters, made once."""
    from meterlake.operators.books import meter_registry
    from meterlake.sources import warehouse
    from meterlake.streaming.pipeline import Paths

    paths = Paths(str(tmp_path_factory.mktemp("template") / "site"))
    warehouse.create_star(spark, paths.star, meter_registry(spark))
    return paths


@pytest.fixture
def installation(empty_site, tmp_path):
    """A copy of the empty star for one test."""
    from meterlake.streaming.pipeline import Paths

    paths = Paths(str(tmp_path / "site"))
    shutil.copytree(empty_site.root, paths.root)
    return paths
