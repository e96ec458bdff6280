"""Inputs of the checked queries: readings from ``events``, and a star loaded from them."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.star import Star
from meterlake.session import shared_dir
from meterlake.sources import warehouse
from meterlake.sources.events import read_events, readings_from_events, registry_from_events
from meterlake.streaming.pipeline import Paths, process_batch

_loaded: dict[tuple[str, str], Paths] = {}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(read_events(spark, sf_dir))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_from_events(read_events(spark, sf_dir))


def new_root(spark: SparkSession, sf_dir: str) -> Paths:
    name = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    app = spark.sparkContext.applicationId
    return Paths(f"{shared_dir(spark)}/meterlake/{app}/{name}-{uuid.uuid4().hex[:8]}")


def load(spark: SparkSession, sf_dir: str) -> Paths:
    """Lake and star of these tables in a new root, through the ingestion path."""
    paths = new_root(spark, sf_dir)
    warehouse.create_star(spark, paths.star, registry(spark, sf_dir))
    process_batch(readings(spark, sf_dir), 0, paths)
    return paths


def loaded(spark: SparkSession, sf_dir: str) -> Paths:
    """Lake and star of these tables, loaded once per application.

    Queries over the star then read stored tables, as they would in use, instead of repeating the
    ingestion of all history in each of them.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = load(spark, sf_dir)
    return _loaded[key]


def star(spark: SparkSession, sf_dir: str) -> Star:
    return warehouse.open_star(spark, loaded(spark, sf_dir).star)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return warehouse.read_table(spark, loaded(spark, sf_dir).star, name)


def irregular(df: DataFrame) -> DataFrame:
    """Readings with blank, unknown and contradictory attributes, chosen by their measurements."""
    return df.withColumns({
        "id_hogar": F.when(F.col("es_pico") == 1, "")
        .when(F.col("voltaje") == 130, "HOG-DESCONOCIDO").otherwise(F.col("id_hogar")),
        "id_medidor": F.when(F.col("voltaje") == 130, "MED-DESCONOCIDO")
        .otherwise(F.col("id_medidor")),
        "tarifa": F.when(F.col("voltaje") < 104, None)
        .when(F.col("voltaje") == 120, "9X")
        .when(F.col("voltaje") == 110, "1E").otherwise(F.col("tarifa")),
        "ciudad": F.when(F.col("voltaje") == 120, "Otra").otherwise(F.col("ciudad")),
    })


def portable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: BIGINT, DOUBLE, text for dates and timestamps."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("long")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string")
        return column

    return df.select(*[plain(f).alias(f.name) for f in df.schema.fields])
