"""The ingestion stream: raw lake, cleansing, processed lake, star, rollup.

Each micro-batch is stored before it is used, and every later step reads the stored copy: executors
may be lost at any point without re-reading the source differently. All writes of a batch replace
that batch's own partitions, and batch numbers come from the checkpoint, so a repeated batch leaves
the result of one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlake import schemas
from meterlake.fixed_values import TARIFFS, Tariff
from meterlake.functions.exact import count_where, exact_sum, half_up
from meterlake.operators.features import transform
from meterlake.sources import files, homes, lake, ledger, warehouse
from meterlake.sources.readings import CORRUPT, INGESTED, MESSAGE, good_messages

log = logging.getLogger(__name__)

COUNTS = ("filas_raw", "filas_limpias", "filas_eliminadas", "picos_detectados")


@dataclass(frozen=True)
class Paths:
    """Folders of one installation, all below a root that every executor can reach."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def processed(self) -> str:
        return f"{self.root}/processed"

    @property
    def star(self) -> str:
        return f"{self.root}/star"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def process_batch(
    batch: DataFrame,
    batch_id: int | str,
    paths: Paths,
    books: Sequence[Tariff] = TARIFFS,
    peak_scope: Sequence[str] | None = None,
    run: str = "0",
    micro_batch: bool = False,
    unique: Sequence[str] = (),
    clock: datetime | None = None,
    monthly: bool = False,
    database: str | None = None,
) -> dict[str, int]:
    """Body of one micro-batch, also usable on a batch DataFrame; returns its counts.

    The batch is read once, to be written to the raw lake; its number of rows and the clock of a stream are
    observed by that write. ``clock`` is the processing time of a batch without ``ingested_at``, by
    default now; a caller that repeats a batch passes the same, or the raw lake keeps it under two
    days. Messages that could not be decoded
    stay there with their text (``read_quarantine``). ``run`` separates the batches of a replay with
    a new checkpoint from earlier ones. ``micro_batch`` says that a batch is small beside the registry.
    ``unique`` names columns, such as meter and
    timestamp, of which a batch keeps one reading each; by default repeated readings are kept.
    ``monthly`` also prices the batch by month-to-date totals (``sources.ledger``); ``batch_id`` must be a
    number then, which orders the batches. ``database`` has the home tables in buckets
    (``homes.publish_homes``): the batch reads the buckets of its ids, and neither table is scanned or shuffled.
    """
    spark = batch.sparkSession
    batch_name = f"{run}-{batch_id}"
    folder, received = lake.write_raw_counted(batch, paths.raw, batch_name, clock)
    if not received:
        return dict.fromkeys(COUNTS, 0)
    raw = lake.read_raw_batch(spark, folder, batch.drop(INGESTED).schema)
    if CORRUPT in raw.columns:
        raw = good_messages(raw)
    raw = raw.drop(MESSAGE)
    if unique:
        raw = raw.dropDuplicates(list(unique))
    clean = transform(raw, books, peak_scope)
    lake.write_processed(clean, paths.processed, batch_name)
    days = days_written(spark, paths, clean, batch_name)
    if days:
        stored = lake.read_processed(spark, paths.processed, clean.schema, batch_name)
        lookups = homes.lookups_of(stored, homes.open_homes(spark, database)) if database else None
        warehouse.load_star(stored, paths.star, batch_name, books, micro_batch, list(days), lookups)
        if monthly:
            ledger.price_batch(stored, paths.star, int(batch_id), books)
    kept, peaks = (sum(n[i] for n in days.values()) for i in range(2))
    counts = dict(zip(COUNTS, (received, kept, received - kept, peaks)))
    log.info("batch %s: %s", batch_name, counts)
    return counts


def read_quarantine(spark: SparkSession, paths: Paths) -> DataFrame:
    """Messages of all batches that were no readings, as text."""
    schema = T.StructType([*schemas.READING.fields, T.StructField(CORRUPT, T.StringType())])
    return lake.read_raw(spark, paths.raw, schema).where(F.col(CORRUPT).isNotNull()).select(
        CORRUPT, "year", "month", "day", "batch_id"
    )


def days_written(
    spark: SparkSession, paths: Paths, clean: DataFrame, batch_name: str
) -> dict[date, tuple[int, int]]:
    """Clean readings and peaks of a stored batch for each of its dates; none if nothing was left to store."""
    if not files.matches(spark, lake.processed_folders(paths.processed, batch_name)):
        return {}  # every reading was removed
    stored = lake.read_processed(spark, paths.processed, clean.schema, batch_name)
    rows = stored.groupBy(F.col("timestamp").cast("date").alias("fecha")).agg(
        F.count("*").alias("n"), count_where(F.col("es_pico")).alias("p")
    ).collect()
    return {r.fecha: (r.n, r.p) for r in rows}


def start_pipeline(
    readings: DataFrame,
    paths: Paths,
    books: Sequence[Tariff] = TARIFFS,
    peak_scope: Sequence[str] | None = None,
    run: str = "0",
    available_now: bool = False,
    processing_time: str | None = None,
    micro_batch: bool = True,
    unique: Sequence[str] = (),
    monthly: bool = False,
    database: str | None = None,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Start the ingestion of a reading stream into an existing star.

    ``available_now`` drains what is there and stops. ``micro_batch=False`` suits a first drain
    whose batches hold most homes. ``on_batch`` gets the counts of every batch
    (observed metrics would count a batch as often as it is read). Late readings need no watermark: whatever
    date a batch touches is recomputed. Replay: a new ``run`` and a new root.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        counts = process_batch(
            batch, batch_id, paths, books, peak_scope, run, micro_batch, unique, monthly=monthly, database=database
        )
        if on_batch is not None:
            on_batch(batch_id, counts)

    writer = readings.writeStream.foreachBatch(body).option(
        "checkpointLocation", f"{paths.checkpoint}/{run}"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def drain(readings: DataFrame, paths: Paths, **options) -> None:
    """Process everything that is available, then return."""
    start_pipeline(readings, paths, available_now=True, **options).awaitTermination()


def running_totals(spark: SparkSession, paths: Paths) -> DataFrame:
    """Readings and kWh in the warehouse, from the daily rollup instead of all facts."""
    daily = warehouse.read_table(spark, paths.star, "fact_resumen_diario")
    return daily.agg(
        F.coalesce(F.sum("num_lecturas"), F.lit(0)).alias("total"),
        half_up(exact_sum(F.col("kwh_total")), 4).alias("kwh"),
    )
