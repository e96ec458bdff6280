"""Session helpers."""

from __future__ import annotations

import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def builder(app_name: str = "meterlake") -> SparkSession.Builder:
    """Settings every job of this package likes; cluster sizing stays with spark-submit."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can see, as named by the session.

    Only a local session without the setting gets a folder of its own; a cluster must name one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="meterlake-")
    return _own_dirs[app]


def constant_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Constants as a local relation: its size is known to the planner, so joins to it broadcast."""
    columns = list(zip(*rows)) if rows else [()] * len(schema.names)
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)],
        schema=arrow,
    )
    return spark.createDataFrame(table, schema=schema)
