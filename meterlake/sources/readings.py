"""Readings in: a Kafka topic or JSON-lines files, decoded with one fixed schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schemas

CORRUPT = "registro_corrupto"
MESSAGE = "mensaje"
INGESTED = "ingested_at"


def decode_readings(
    messages: DataFrame,
    value: str = "value",
    keep: str | None = None,
    fields: Sequence[T.StructField] = (),
) -> DataFrame:
    """UTF-8 JSON objects to reading columns; other columns of the messages are kept.

    A key that is missing becomes NULL. A message that is no JSON object of this schema keeps its
    text in ``registro_corrupto`` instead of stopping the job. ``keep`` names a column for the text of every message
    as it came, so that keys the schema lacks are not lost; ``fields`` are such keys, decoded as well.
    """
    schema = T.StructType([*schemas.READING.fields, *fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"),
        schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in messages.columns if c != value]
    text = [F.col(value).cast("string").alias(keep)] if keep else []
    kept = [keep] if keep else []
    return messages.select(*others, parsed.alias("_lectura"), *text).select(*others, "_lectura.*", *kept)


def good_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT, MESSAGE)


def encode_readings(readings: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Readings to one JSON object per row, column ``value`` (the topic's message form), ``extra`` columns included."""
    fields: list[Column | str] = [
        F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("T")).alias(c)
        if c == "timestamp" else c
        for c in [*schemas.READING.names, *extra]
        if c in readings.columns
    ]
    return readings.select(F.to_json(F.struct(*fields)).alias("value"))


def read_readings_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "kafka",
    servers: str | None = None,
    min_messages: int | None = 8,
    max_delay: str = "5s",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Decoded readings as a stream, with the time the micro-batch was planned.

    ``fmt="kafka"``: ``source`` is a topic, read from the earliest offset; a micro-batch starts at
    ``min_messages`` or after ``max_delay``. ``fmt="text"``: ``source`` is a folder of JSON-lines
    files; a micro-batch takes files up to ``max_files_per_trigger`` or ``max_bytes_per_trigger`` (one file at
    least; whichever is set), and the query's trigger interval is the time limit. The text of every message stays beside its columns (``mensaje``) for the raw lake. Positions live in the query's checkpoint. ``ingested_at`` is fixed per micro-batch and
    stored with its offsets, so a repeated batch gets the same value.
    """
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", source)
            .option("startingOffsets", "earliest")
        )
        if min_messages:
            reader = reader.option("minOffsetsPerTrigger", min_messages).option(
                "maxTriggerDelay", max_delay
            )
        messages = reader.options(**options).load().select("value")
    else:
        reader = spark.readStream.format(fmt)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if max_bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
        messages = reader.options(**options).load(source).select("value")
    return decode_readings(messages, keep=MESSAGE).withColumn(INGESTED, F.current_timestamp())
