"""Home tables in buckets, so that a lookup moves the readings or facts only and a small batch reads few buckets.

The star's home tables are Parquet folders without order: a lookup too large to broadcast shuffles both sides.
``publish_homes`` writes them once more as bucketed tables of a database, a file per bucket. A join on the bucket
column then reads the home side where it lies, and a filter on it opens the buckets of its values only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.star import Star
from meterlake.sources import files, warehouse

#: At least as many as shuffle partitions, or the planner may prefer to shuffle both sides. For 100 million homes, some MB each.
BUCKETS = 512
#: Ids of a batch that come to the driver to choose buckets; a batch with more reads all buckets, without a shuffle of them.
IDS = 2048

#: Name of the table: its source in the star, its bucket column.
HOME_TABLES = {
    "hogares_por_id": ("hogar_tarifa", "id_hogar"),
    "hogares_por_clave": ("dim_hogar", "hogar_key"),
    "medidores_por_id": ("medidores", "id_medidor"),
}


@dataclass(frozen=True)
class HomeTables:
    """Home keys and city tariffs by home id, the home dimension by its key, the registry by meter id."""

    por_id: DataFrame
    por_clave: DataFrame
    medidores: DataFrame


def publish_homes(spark: SparkSession, path: str, database: str = "meterlake", buckets: int = BUCKETS) -> HomeTables:
    """Write the home tables of the star at ``path`` in buckets; say it again after ``create_star`` has added homes.

    Each call writes a version beside the last and then lets a view of the public name show it, so an interrupted call
    changes nothing and is simply repeated. The version shown before stays until the next call, for queries that have
    begun with it; all older and unfinished ones are removed.
    """
    db = f"`{database}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    version = uuid.uuid4().hex[:12]
    before = _version(spark, database)
    for name, (table, column) in HOME_TABLES.items():
        rows = warehouse.read_table(spark, path, table)
        rows.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column).option(
            "path", f"{path}/cubetas/{version}/{name}"
        ).format("parquet").saveAsTable(f"{db}.{name}_{version}")
    # One view after the other: all three hold the same homes but for those that came in between.
    for name in HOME_TABLES:
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS SELECT * FROM {db}.{name}_{version}")
    kept = {version, before}
    for table in spark.catalog.listTables(database):
        name, _, own = table.name.rpartition("_")
        if name in HOME_TABLES and own not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{table.name}")
    for folder in files.names(spark, f"{path}/cubetas"):
        if folder not in kept:
            files.remove(spark, f"{path}/cubetas/{folder}")
    return open_homes(spark, database)


def _version(spark: SparkSession, database: str) -> str | None:
    """The version that the views show; None before the first."""
    if not spark.catalog.tableExists(f"`{database}`.medidores_por_id"):
        return None
    shown = spark.table(f"`{database}`.medidores_por_id").inputFiles()
    return shown[0].split("/cubetas/")[-1].split("/")[0] if shown else None


def open_homes(spark: SparkSession, database: str = "meterlake") -> HomeTables:
    """What ``publish_homes`` last wrote, in any session of the catalogue."""
    return HomeTables(*(spark.table(f"`{database}`.{name}") for name in HOME_TABLES))


def with_homes(star: Star, homes: HomeTables) -> Star:
    """The star with its home dimension read from buckets."""
    return replace(star, hogar=homes.por_clave)


def lookups_of(clean: DataFrame, homes: HomeTables, most: int = IDS) -> tuple[DataFrame, DataFrame]:
    """(home lookup, registry) for the readings of a batch.

    With at most ``most`` different ids of homes and meters in the batch only their buckets are read; with more, both
    whole tables, where they lie. Either way every id of the batch that has an entry finds it.
    """
    meters = _cut(homes.medidores, "id_medidor", _ids(clean, "id_medidor", most))
    own = _ids(clean, "id_hogar", most)
    registered = None if own is None or meters is None else _ids(meters, "id_hogar", most)
    known = None if own is None or registered is None else sorted({*own, *registered})
    lookup = _cut(homes.por_id, "id_hogar", known)
    return homes.por_id if lookup is None else lookup, homes.medidores if meters is None else meters


def _ids(rows: DataFrame, column: str, most: int) -> list[str] | None:
    """Different values of a column, none if it is absent; None if there are more than ``most``."""
    if column not in rows.columns:
        return []
    values = rows.select(F.col(column).alias("id")).where("id IS NOT NULL").distinct()
    ids = [r.id for r in values.limit(most + 1).collect()]
    return None if len(ids) > most else ids


def _cut(table: DataFrame, column: str, ids: list[str] | None) -> DataFrame | None:
    return None if ids is None else table.where(F.col(column).isin(ids) if ids else F.lit(False))
