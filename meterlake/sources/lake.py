"""The lake: untouched readings by processing day, clean readings by event month.

Every batch owns its own partition directories and replaces them when it is repeated, so a retried
batch leaves one copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.fixed_values import TARIFFS, Tariff
from meterlake.operators.features import transform
from meterlake.sources.readings import INGESTED, MESSAGE, decode_readings, good_messages

_RAW_PARTITIONS = [T.StructField(c, T.StringType()) for c in ("year", "month", "day", "batch_id")]
_CLEAN_PARTITIONS = [T.StructField(c, T.StringType()) for c in ("year", "month", "batch_id")]


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Write, replacing exactly the partitions that occur in ``df``.

    The rebalance lets adaptive execution cut a hot partition into several files of advisory size
    and merge the crumbs of small ones.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def raw_folder(path: str, clock: datetime, batch_id: str) -> str:
    return f"{path}/year={clock:%Y}/month={clock:%m}/day={clock:%d}/batch_id={batch_id}"


def write_raw(
    readings: DataFrame, path: str, batch_id: str = "0", clock: datetime | None = None
) -> str:
    """Store a batch as it came under the day it was processed; returns its folder.

    ``clock`` is the processing time of the batch; a stream passes the time kept in its offset log.
    """
    folder = raw_folder(path, clock or datetime.now(), batch_id)
    readings.write.mode("overwrite").parquet(folder)
    return folder


def write_raw_counted(
    readings: DataFrame, path: str, batch_id: str, clock: datetime | None = None
) -> tuple[str, int]:
    """``write_raw`` that reads the batch once: returns its folder and its number of rows.

    With a column ``ingested_at``, constant in a batch, the rows themselves say the day, and the write observes
    it; a batch without rows writes nothing. The metrics belong to the tasks that write, so they count every
    row once, and a repeated batch anew.
    """
    if INGESTED not in readings.columns:
        seen = Observation()
        folder = write_raw(readings.observe(seen, F.count("*").alias("n")), path, batch_id, clock)
        return folder, seen.get["n"]
    seen = Observation()
    moment = F.col(INGESTED).cast("timestamp_ntz")
    pattern = {"year": "yyyy", "month": "MM", "day": "dd"}
    (
        readings.observe(seen, F.count("*").alias("n"), F.max(moment).alias("clock"))
        .withColumns({c: F.date_format(moment, p) for c, p in pattern.items()})
        .withColumn("batch_id", F.lit(batch_id)).drop(INGESTED)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day", "batch_id").parquet(path)
    )
    got = seen.get
    return (raw_folder(path, got["clock"], batch_id) if got["n"] else ""), got["n"]


def write_processed(clean: DataFrame, path: str, batch_id: str = "0") -> None:
    """Store clean readings by month of the reading; partition columns stay out of the files."""
    month = F.lpad(F.month("timestamp").cast("string"), 2, "0")
    replace_partitions(
        clean.withColumns({
            "year": F.year("timestamp").cast("string"),
            "month": month,
            "batch_id": F.lit(batch_id),
        }),
        path, "year", "month", "batch_id",
    )


def _with_partitions(schema: T.StructType, partitions: Sequence[T.StructField]) -> T.StructType:
    names = {p.name for p in partitions}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(partitions))


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The whole raw lake."""
    return spark.read.schema(_with_partitions(schema, _RAW_PARTITIONS)).parquet(path)


def read_raw_batch(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(folder)


def processed_folders(path: str, batch_id: str) -> str:
    """Pattern of the folders of a batch in the processed lake."""
    return f"{path}/year=*/month=*/batch_id={batch_id}"


def read_processed(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: str | None = None
) -> DataFrame:
    """The whole processed lake, or one batch of it (listing that batch's folders only)."""
    reader = spark.read.schema(_with_partitions(schema, _CLEAN_PARTITIONS))
    if batch_id is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(processed_folders(path, batch_id))


def reprocess_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    books: Sequence[Tariff] = TARIFFS,
    peak_scope: Sequence[str] | None = None,
) -> DataFrame:
    """Run all stored history through the same transform again."""
    partitions = [p.name for p in _RAW_PARTITIONS]
    return transform(read_raw(spark, path, schema).drop(*partitions), books, peak_scope)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Text of all messages of the raw lake as received (``mensaje``), with day and batch.

    Batches that came as columns, not as messages, have NULL.
    """
    schema = T.StructType([T.StructField(MESSAGE, T.StringType())])
    return read_raw(spark, path, schema)


def decode_again(
    spark: SparkSession, path: str, fields: Sequence[T.StructField] = ()
) -> DataFrame:
    """All stored messages decoded anew, with keys (``fields``) that were unknown when they came in."""
    return decode_readings(read_messages(spark, path).where(F.col(MESSAGE).isNotNull()), MESSAGE, fields=fields)


def reprocess_messages(
    spark: SparkSession,
    path: str,
    fields: Sequence[T.StructField] = (),
    books: Sequence[Tariff] = TARIFFS,
    peak_scope: Sequence[str] | None = None,
) -> DataFrame:
    """As ``reprocess_raw``, from the messages themselves; ``fields`` pass through the transform."""
    partitions = [p.name for p in _RAW_PARTITIONS]
    return transform(good_messages(decode_again(spark, path, fields)).drop(*partitions), books, peak_scope)


def to_records(df: DataFrame, column: str = "registro") -> DataFrame:
    """Result rows as JSON objects, one per row."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(column))


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
