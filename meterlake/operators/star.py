"""The star: dimensions, facts, daily rollup, key audits, and the star joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake import schemas
from meterlake.fixed_values import TARIFFS, TOP_PEAKS, Tariff
from meterlake.functions import calendar as cal
from meterlake.functions.exact import count_where, exact_avg, exact_sum
from meterlake.operators.books import first_block_prices
from meterlake.operators.tariffs import home_tariffs, price_flat, resolve_home_tariff
from meterlake.session import constant_frame

KEY_BUCKETS = 4096


@dataclass(frozen=True)
class Star:
    """The tables a query reads."""

    fact: DataFrame
    tiempo: DataFrame
    region: DataFrame
    hogar: DataFrame
    resumen_diario: DataFrame | None = None
    resumen_horario: DataFrame | None = None
    picos_mayores: DataFrame | None = None
    hogares_activos: DataFrame | None = None


# --- dimensions -------------------------------------------------------------------------------


def dim_tiempo(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row per quarter hour that occurs in the readings."""
    buckets = readings.select(cal.bucket_15min(F.col(ts)).alias("_b")).distinct()
    b = F.col("_b")
    return buckets.select(
        cal.tiempo_key(b).alias("tiempo_key"),
        cal.iso_text(b).alias("timestamp"),
        b.cast("date").alias("fecha"),
        F.year(b).alias("year"),
        F.month(b).alias("month"),
        F.day(b).alias("day"),
        F.hour(b).alias("hora"),
        cal.dia_semana(b).alias("dia_semana"),
        cal.es_finde(b).alias("es_finde"),
        F.quarter(b).alias("trimestre"),
        cal.mes_nombre(F.month(b)).alias("mes_nombre"),
    )


def dim_region(spark: SparkSession, books: Sequence[Tariff] = TARIFFS) -> DataFrame:
    """One row per tariff code; the key is its position in the book."""
    return first_block_prices(spark, books).select(
        F.col("posicion").alias("region_key"),
        F.col("tarifa").alias("region"),
        F.col("precio_base").alias("tarifa_kwh"),
    )


def new_dim_region(
    spark: SparkSession, books: Sequence[Tariff], existing: DataFrame
) -> DataFrame:
    """Tariffs of the book that the dimension lacks; keys go on after the highest one there.

    The window sees a few rows of the book.
    """
    absent = dim_region(spark, books).join(existing.select("region"), "region", "left_anti")
    highest = existing.agg(F.coalesce(F.max("region_key"), F.lit(0))).scalar()
    in_book_order = F.row_number().over(Window.orderBy("region_key"))
    return absent.select(
        (highest + in_book_order).alias("region_key"), "region", "tarifa_kwh"
    )


def _key_bucket(natural_key: Column) -> Column:
    return F.conv(F.substring(F.md5(natural_key), 1, 3), 16, 10).cast("long")


def assign_home_keys(new_homes: DataFrame, existing: DataFrame) -> DataFrame:
    """Give new homes a surrogate key that no home has.

    Ids are hashed over a fixed number of buckets and numbered inside their bucket, after the
    numbers already taken there; the key interleaves number and bucket. So numbering needs no global
    order and no counter, is the same on every retry, and keys never change as homes are added.
    """
    taken = existing.groupBy(_key_bucket(F.col("id_hogar")).alias("_bucket")).agg(
        F.count("*").alias("_tomados")
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("id_hogar")
    return (
        new_homes.withColumn("_bucket", _key_bucket(F.col("id_hogar")))
        .withColumn("_n", F.row_number().over(in_bucket))
        .join(taken, "_bucket", "left")
        .withColumn(
            "hogar_key",
            (F.coalesce("_tomados", F.lit(0)) + F.col("_n") - 1) * KEY_BUCKETS
            + F.col("_bucket") + 1,
        )
        .drop("_bucket", "_n", "_tomados")
    )


def merge_new_keys(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``existing``, one per key (insert if absent).

    Equal rows are merged first, by hash; what is left is one row per key and variant.
    """
    absent = new.distinct().join(existing.select(key), key, "left_anti")
    row = F.struct(*[c for c in new.columns if c != key])
    return absent.groupBy(key).agg(F.min_by(row, row).alias("_fila")).select(
        key, "_fila.*"
    ).select(*new.columns)


def new_dim_hogar(registry: DataFrame, existing: DataFrame, region: DataFrame) -> DataFrame:
    """Registry homes not yet in the dimension, with their keys; the first meter of a home wins."""
    candidates = registry.select("id_hogar", "id_medidor", "ciudad", "tarifa")
    fresh = merge_new_keys(existing, candidates, "id_hogar")
    keyed = assign_home_keys(fresh, existing)
    return keyed.join(
        region.select("region_key", F.col("region").alias("tarifa")), "tarifa", "left"
    ).select(*schemas.DIM_HOGAR.names)


def seed_dims(
    spark: SparkSession, registry: DataFrame, books: Sequence[Tariff] = TARIFFS
) -> tuple[DataFrame, DataFrame]:
    """Region and home dimensions of an empty star."""
    region = dim_region(spark, books)
    return region, new_dim_hogar(
        registry, constant_frame(spark, [], schemas.DIM_HOGAR), region
    )


# --- facts ------------------------------------------------------------------------------------


def home_lookup(
    hogar: DataFrame, registry: DataFrame, books: Sequence[Tariff] = TARIFFS
) -> DataFrame:
    """Home key and city tariff, one row per home, so readings meet the home tables once."""
    return hogar.select("id_hogar", "hogar_key").join(
        home_tariffs(registry, books), "id_hogar", "full"
    )


def resolve_keys(
    clean: DataFrame,
    tiempo: DataFrame | None,
    region: DataFrame,
    homes: DataFrame,
    registry: DataFrame,
) -> DataFrame:
    """Add time, home and region keys and the city tariff; a miss gives NULL and keeps the row.

    ``tiempo=None`` takes the time key as computed: for readings whose quarter hours were just
    merged into the dimension.
    """
    resolved = resolve_home_tariff(clean, registry).withColumn(
        "_tk", cal.tiempo_key(cal.bucket_15min(F.col("timestamp")))
    )
    if tiempo is None:
        timed = resolved.withColumnRenamed("_tk", "tiempo_key")
    else:
        times = tiempo.select("tiempo_key")
        timed = resolved.join(times, F.col("_tk") == F.col("tiempo_key"), "left").drop("_tk")
    regions = region.select("region_key", F.col("region").alias("_region"))
    homes = homes.withColumnRenamed("id_hogar", "_hogar")
    return (
        timed.join(regions, F.col("tarifa_resuelta") == F.col("_region"), "left")
        .join(homes, F.col("hogar_resuelto") == F.col("_hogar"), "left")
        .drop("_region", "_hogar")
    )


def build_fact(
    clean: DataFrame,
    tiempo: DataFrame | None,
    region: DataFrame,
    homes: DataFrame,
    registry: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    batch_id: str = "0",
) -> DataFrame:
    """One fact row per clean reading, priced by city tariff."""
    keyed = resolve_keys(clean, tiempo, region, homes, registry)
    priced = price_flat(keyed, books, F.coalesce("tarifa_ciudad", "tarifa_resuelta"))
    payload = [
        F.col(c) if c in priced.columns else F.lit(None).cast("double").alias(c)
        for c in ("voltaje", "corriente", "factor_potencia", "potencia_w")
    ]
    return priced.select(
        "tiempo_key", "hogar_key", "region_key",
        F.col("timestamp").alias("timestamp_real"), "kwh_intervalo", *payload,
        "costo_mxn", "es_pico",
        F.col("timestamp").cast("date").alias("fecha"),
        F.lit(batch_id).alias("batch_id"),
    )


def resumen_diario(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily rollup; NULL home or region keys form groups of their own. ``by`` adds group columns.

    The date is the fact's own, which it shares with its quarter hour; facts without a quarter hour are left out.
    """
    return fact.where(F.col("tiempo_key").isNotNull()).groupBy("fecha", "hogar_key", "region_key", *by).agg(
        *consumption(), F.max("kwh_intervalo").alias("kwh_max"),
        exact_avg(F.col("kwh_intervalo")).alias("kwh_promedio"),
        F.count("*").alias("num_lecturas"),
    ).select(*schemas.RESUMEN_DIARIO.names, *by)


def resumenes(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Both rollups in one pass over the facts: rows of date, home and region, and rows of date, hour and region.

    ``por_hora`` tells them apart; the hour is the quarter hour's. Facts without a quarter hour are left out.
    """
    timed = fact.where(F.col("tiempo_key").isNotNull()).withColumn(
        "hora", (F.call_function("div", "tiempo_key", F.lit(100)) % 100).cast("int")
    )
    sets = [["fecha", "region_key", "hogar_key", *by], ["fecha", "region_key", "hora", *by]]
    return timed.groupingSets(sets, "fecha", "region_key", "hogar_key", "hora", *by).agg(
        *consumption(), F.max("kwh_intervalo").alias("kwh_max"),
        exact_avg(F.col("kwh_intervalo")).alias("kwh_promedio"),
        F.count("*").alias("num_lecturas"), (F.grouping("hogar_key") == 1).alias("por_hora"),
    )


def daily_rows(both: DataFrame, *more: str) -> DataFrame:
    return both.where("NOT por_hora").select(*schemas.RESUMEN_DIARIO.names, *more)


def hourly_rows(both: DataFrame, *more: str) -> DataFrame:
    return both.where("por_hora").select(*schemas.RESUMEN_HORARIO.names, *more)


def _added_up(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(
        exact_sum(F.col("kwh_total")).alias("kwh_total"),
        F.max("kwh_max").alias("kwh_max"),
        (exact_sum(F.col("kwh_total")) / F.sum("num_lecturas")).alias("kwh_promedio"),
        exact_sum(F.col("costo_total")).alias("costo_total"),
        F.sum("num_lecturas").alias("num_lecturas"),
        F.sum("num_picos").alias("num_picos"),
    )


def merge_daily(parts: DataFrame) -> DataFrame:
    """Add up rollup rows of the same date, home and region; exact, like the rollup itself."""
    return _added_up(parts, "fecha", "hogar_key", "region_key").select(*schemas.RESUMEN_DIARIO.names)


def merge_hourly(parts: DataFrame) -> DataFrame:
    """Add up rollup rows of the same date, hour and region."""
    return _added_up(parts, "fecha", "hora", "region_key").select(*schemas.RESUMEN_HORARIO.names)


def active_homes(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the home keys that occur on each date in ``rows``, facts or daily rollup; one row per bucket of keys.

    A bit per home instead of a row. Unlike counts of distinct homes, bitmaps of dates, batches or both can be
    united, and repeated homes are counted once. Rows without home and facts without a quarter hour are left out.
    """
    known = rows.where("hogar_key IS NOT NULL")
    if "tiempo_key" in rows.columns:
        known = known.where("tiempo_key IS NOT NULL")
    bucket, bit = F.bitmap_bucket_number("hogar_key"), F.bitmap_bit_position("hogar_key")
    return known.groupBy("fecha", bucket.alias("cubeta"), *by).agg(F.bitmap_construct_agg(bit).alias("mapa")).select(
        *schemas.HOGARES_ACTIVOS.names, *by
    )


def merge_active(parts: DataFrame) -> DataFrame:
    """One bitmap per date and bucket of those of its batches."""
    return parts.groupBy("fecha", "cubeta").agg(F.bitmap_or_agg("mapa").alias("mapa")).select(*schemas.HOGARES_ACTIVOS.names)


def count_homes(parts: DataFrame) -> DataFrame:
    """One row: the number of different homes (``hogares``) in all bitmaps of ``parts``; zero if there are none."""
    united = parts.groupBy("cubeta").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("mapa")), F.lit(0)).cast("long").alias("hogares"))


def biggest_peaks(fact: DataFrame, by: Sequence[str] = (), limit: int = TOP_PEAKS) -> DataFrame:
    """The ``limit`` biggest peaks of known homes for each date, with a region and without one.

    Of such lists the lists of their union can be made again, so they are kept per batch and merged when
    read. The planner cuts the groups before the shuffle: a task sends ``limit`` rows per date.
    """
    ranked = Window.partitionBy("fecha", F.col("region_key").isNull(), *by).orderBy(
        F.desc("kwh_intervalo"), "timestamp_real", "hogar_key"
    )
    peaks = fact.where("hogar_key IS NOT NULL")
    if "es_pico" in fact.columns:
        peaks = peaks.where("es_pico")
    return peaks.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= limit).select(
        *schemas.PICOS_MAYORES.names, *by
    )


def consumption() -> list[Column]:
    """The three measures most queries share."""
    return [
        exact_sum(F.col("kwh_intervalo")).alias("kwh_total"),
        exact_sum(F.col("costo_mxn")).alias("costo_total"),
        count_where(F.col("es_pico")).alias("num_picos"),
    ]


# --- key audits -------------------------------------------------------------------------------


def fk_violations(star: Star) -> DataFrame:
    """Number of fact rows whose key is set but absent from its dimension, per dimension.

    Keys are counted per value before they meet the dimension, so the anti joins see one row per
    distinct key.
    """

    def dangling(name: str, dimension: DataFrame, key: str) -> DataFrame:
        used = star.fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        return used.join(dimension.select(key), key, "left_anti").agg(
            F.lit(name).alias("tabla"), F.coalesce(F.sum("n"), F.lit(0)).alias("filas")
        )

    return (
        dangling("dim_tiempo", star.tiempo, "tiempo_key")
        .unionByName(dangling("dim_hogar", star.hogar, "hogar_key"))
        .unionByName(dangling("dim_region", star.region, "region_key"))
    )


def pk_duplicates(table: DataFrame, *key: str) -> DataFrame:
    """Key values that occur more than once, and how often."""
    return table.groupBy(*key).agg(F.count("*").alias("veces")).where("veces > 1")


# --- star joins -------------------------------------------------------------------------------


def join_time(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Facts with their time attributes. ``fecha`` is part of the join key, so a date predicate on
    the result reaches the partitions of the fact table."""
    fact = star.fact if fact is None else fact
    return fact.join(star.tiempo, ["tiempo_key", "fecha"])


def with_date(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Facts that have a quarter hour, for questions of day grain: the fact carries its date, so they need
    no time dimension."""
    return (star.fact if fact is None else fact).where(F.col("tiempo_key").isNotNull())


def join_region(star: Star, fact: DataFrame | None = None) -> DataFrame:
    fact = star.fact if fact is None else fact
    return fact.join(star.region, "region_key")


def join_home(star: Star, fact: DataFrame | None = None) -> DataFrame:
    fact = star.fact if fact is None else fact
    return fact.join(star.hogar.drop("region_key"), "hogar_key")
