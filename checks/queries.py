"""The registered queries. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.stage import irregular, loaded, new_root, portable, readings, registry, star, table
from meterlake.fixed_values import Block, Tariff
from meterlake.functions import calendar as cal
from meterlake.functions import energy, exact, periods, text
from meterlake.operators import books, features, peaks, quality, tariffs
from meterlake.operators import star as star_ops
from meterlake.plans import daily, hourly, listings, marts, report
from meterlake.sources import catalog, homes, lake, ledger, warehouse
from meterlake.sources.events import read_events, readings_from_events
from meterlake.sources.readings import CORRUPT, MESSAGE, decode_readings, encode_readings
from meterlake.streaming import pipeline

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}

HOUR, DAY, WEEK, MONTH = "2024-01-05 9", "2024-01-05", "2024-W02", "2024-01"


def register(function: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(spark, sf_dir))

    REGISTERED[name or function.__name__] = run
    return run


def named(name: str) -> Callable[[Query], Query]:
    return lambda function: register(function, name)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_readings(readings(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------------------------


@named("decode_readings")
def decode_readings_json(spark, sf_dir):
    messages = encode_readings(readings(spark, sf_dir))
    return decode_readings(messages).select(
        F.col(CORRUPT).isNull().alias("valida"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"), "id_medidor", "tarifa",
        "ciudad", exact.zero_if_null(F.col("kwh_intervalo")).alias("kwh_intervalo"),
        exact.zero_if_null(F.col("voltaje")).alias("voltaje"), "es_pico", "estado",
    )


@register
def write_raw(spark, sf_dir):
    df = readings(spark, sf_dir)
    stored = lake.read_raw(spark, loaded(spark, sf_dir).raw, df.schema)
    return stored.groupBy("estado").agg(
        F.count("*").alias("filas"), F.count("kwh_intervalo").alias("con_medida")
    )


@register
def write_processed(spark, sf_dir):
    schema = features.transform(readings(spark, sf_dir)).schema
    stored = lake.read_processed(spark, loaded(spark, sf_dir).processed, schema)
    return stored.groupBy("year", "month").agg(
        F.count("*").alias("filas"), exact.exact_sum(F.col("costo_mxn")).alias("costo")
    )


@register
def reprocess_raw(spark, sf_dir):
    schema = readings(spark, sf_dir).schema
    again = lake.reprocess_raw(spark, loaded(spark, sf_dir).raw, schema)
    return again.groupBy("tarifa").agg(
        F.count("*").alias("filas"),
        exact.exact_sum(F.col("kwh_intervalo")).alias("kwh"),
        exact.count_where(F.col("es_pico")).alias("picos"),
    )


@register
def load_fact(spark, sf_dir):
    return star(spark, sf_dir).fact.select(
        "tiempo_key", "hogar_key", "region_key", "timestamp_real", "kwh_intervalo", "voltaje",
        "potencia_w", "costo_mxn", "es_pico", "fecha",
    )


@register
def refresh_daily(spark, sf_dir):
    return star(spark, sf_dir).resumen_diario


@register
def merge_new_keys(spark, sf_dir):
    """Quarter hours that only removed readings have: absent from the clean time dimension."""
    everything = star_ops.dim_tiempo(readings(spark, sf_dir))
    existing = star_ops.dim_tiempo(clean(spark, sf_dir))
    return star_ops.merge_new_keys(existing, everything, "tiempo_key").select(
        "tiempo_key", "timestamp"
    )


@register
def seed_dims(spark, sf_dir):
    region, hogar = star_ops.seed_dims(spark, registry(spark, sf_dir))
    return hogar.join(region, "region_key")


@named("query")
def query_views(spark, sf_dir):
    warehouse.register_views(spark, star(spark, sf_dir))
    return warehouse.query(
        spark,
        "SELECT v.region, v.fecha >= :desde AS reciente, COUNT(*) AS dias, "
        "MAX(v.num_lecturas) AS max_lecturas, MAX(r.tarifa_kwh) AS tarifa_kwh "
        "FROM v_consumo_por_region v JOIN dim_region r ON r.region = v.region GROUP BY ALL",
        desde="2024-01-10",
    )


@register
def register_views(spark, sf_dir):
    """Every table and view is there by its name: rows in each."""
    warehouse.register_views(spark, star(spark, sf_dir))
    names = (
        "fact_consumo", "dim_tiempo", "dim_region", "dim_hogar", "fact_resumen_diario",
        "v_consumo_por_region", "v_consumo_por_hogar", "v_perfil_horario", "v_picos",
        "v_resumen_general",
    )
    return warehouse.query(spark, " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, COUNT(*) AS filas FROM {name}" for name in names
    ))


@register
def create_star(spark, sf_dir):
    """Seeded rows by tariff: homes and meters of the registry."""
    homes = table(spark, sf_dir, "dim_hogar")
    region = table(spark, sf_dir, "dim_region")
    lookup = table(spark, sf_dir, "hogar_tarifa").select("hogar_key", "tarifa_ciudad")
    return homes.join(region, "region_key").join(lookup, "hogar_key").groupBy(
        "region", "tarifa_ciudad"
    ).agg(F.count("*").alias("hogares"), F.count_distinct("id_medidor").alias("medidores"))


@register
def to_records(spark, sf_dir):
    rows = marts.v_consumo_por_region(star(spark, sf_dir)).select(
        "region", "fecha", "num_lecturas", "num_picos"
    )
    return lake.to_records(rows)


@register
def reprocess_messages(spark, sf_dir):
    """Messages with a key the first schema lacks, some of them broken, stored and decoded again with it."""
    paths = new_root(spark, sf_dir)
    df = readings(spark, sf_dir)
    df = df.withColumn("firmware", F.concat(F.lit("v"), (F.col("event_id") % 7).cast("string")))
    sent = encode_readings(df, ["firmware"]).select(
        F.when(F.col("value").contains('"v3"'), F.concat(F.lit("{roto "), "value")).otherwise(F.col("value")).alias("value")
    )
    lake.write_raw(decode_readings(sent, keep=MESSAGE), paths.raw)
    again = lake.reprocess_messages(spark, paths.raw, [T.StructField("firmware", T.StringType())])
    return again.groupBy("firmware", "tarifa").agg(
        F.count("*").alias("filas"), exact.exact_sum(F.col("kwh_intervalo")).alias("kwh"),
    )


_folded_stars: dict[tuple[str, str], str] = {}


def _folded(spark, sf_dir):
    """Two batches by event number, the second late in every day; all but the last days folded; then the first again.

    Loaded once per application, like the other stored tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _folded_stars:
        return warehouse.open_star(spark, _folded_stars[key])
    paths = new_root(spark, sf_dir)
    warehouse.create_star(spark, paths.star, registry(spark, sf_dir))
    rows = features.transform(readings(spark, sf_dir)).withColumn("_lote", F.pmod(F.col("event_id"), F.lit(2)))
    for step, lote in enumerate((0, 1, 0)):
        warehouse.load_star(rows.where(F.col("_lote") == lote).drop("_lote"), paths.star, f"0-{lote}", micro_batch=True)
        if step == 1:
            warehouse.fold_days(spark, paths.star, date(2024, 1, 20))
    _folded_stars[key] = paths.star
    return warehouse.open_star(spark, paths.star)


@register
def fold_fact(spark, sf_dir):
    return _folded(spark, sf_dir).fact.select(
        "tiempo_key", "hogar_key", "region_key", "timestamp_real", "kwh_intervalo", "voltaje",
        "potencia_w", "costo_mxn", "es_pico", "fecha",
    )


@register
def fold_daily(spark, sf_dir):
    return _folded(spark, sf_dir).resumen_diario


@register
def fold_general(spark, sf_dir):
    return daily.resumen_general(_folded(spark, sf_dir))


# --- filters ----------------------------------------------------------------------------------


@register
def drop_null_readings(spark, sf_dir):
    return quality.drop_null_readings(readings(spark, sf_dir)).select("event_id", "kwh_intervalo")


@register
def filter_kwh_range(spark, sf_dir):
    return quality.filter_kwh_range(readings(spark, sf_dir)).select("event_id", "kwh_intervalo")


@register
def filter_voltage_range(spark, sf_dir):
    return quality.filter_voltage_range(readings(spark, sf_dir)).select("event_id", "voltaje")


@register
def filter_status_ok(spark, sf_dir):
    return quality.filter_status_ok(readings(spark, sf_dir)).select("event_id", "estado")


@register
def clean_readings(spark, sf_dir):
    return clean(spark, sf_dir).select(
        "event_id", "timestamp", "id_medidor", "id_hogar", "ciudad", "tarifa", "kwh_intervalo",
        "potencia_w", "voltaje", "es_pico",
    )


def _period(kind: str, value: str, **options) -> Query:
    def run(spark, sf_dir):
        return report.facts_of_period(star(spark, sf_dir), kind, value, **options).select(
            "tiempo_key", "hogar_key", "timestamp_real", "kwh_intervalo"
        )

    return run


for _name, _kind, _value in (
    ("period_hour", "hora", HOUR),
    ("period_day", "dia", DAY),
    ("period_week", "semana", WEEK),
    ("period_month", "mes", MONTH),
    ("period_filter", "semana", "2024-W"),
):
    register(_period(_kind, _value), _name)


@register
def only_peaks(spark, sf_dir):
    return marts.only_peaks(star(spark, sf_dir).fact).select(
        "hogar_key", "timestamp_real", "kwh_intervalo"
    )


@register
def touched_dates(spark, sf_dir):
    """Facts of the dates that hold a very large reading."""
    fact = star(spark, sf_dir).fact
    dates = fact.where("kwh_intervalo > 4.9").select("fecha")
    return warehouse.touched_dates(fact, dates).groupBy("fecha").agg(F.count("*").alias("filas"))


# --- derived columns --------------------------------------------------------------------------


@register
def parse_timestamp(spark, sf_dir):
    """ISO text parsed; the text is broken for readings whose status is not ok."""
    iso = F.replace(F.col("timestamp").cast("string"), F.lit(" "), F.lit("T"))
    broken = F.when(F.col("estado") == "ok", iso).otherwise(F.concat(F.lit("?"), iso))
    parsed = quality.parse_timestamp(readings(spark, sf_dir).withColumn("timestamp", broken))
    return parsed.where("timestamp IS NOT NULL").select("event_id", "timestamp")


@register
def time_features(spark, sf_dir):
    return features.time_features(readings(spark, sf_dir)).select(
        "event_id", "hora", "dia_semana", "es_finde"
    )


@register
def bucket_15min(spark, sf_dir):
    bucket = cal.bucket_15min(F.col("timestamp"))
    return readings(spark, sf_dir).withColumn("cuarto", bucket).select(
        "event_id", "cuarto", cal.tiempo_key(F.col("cuarto")).alias("tiempo_key")
    )


@register
def dim_tiempo(spark, sf_dir):
    return star_ops.dim_tiempo(clean(spark, sf_dir))


@register
def mes_nombre(spark, sf_dir):
    """Month names of every reading day and of the days that many months later as its hour."""
    tiempo = star(spark, sf_dir).tiempo
    later = F.add_months("fecha", F.col("hora"))
    return tiempo.select(later.alias("fecha")).distinct().select(
        "fecha", cal.mes_nombre(F.month("fecha")).alias("mes_nombre"),
        F.quarter("fecha").alias("trimestre"),
    )


@register
def flag_peaks(spark, sf_dir):
    return peaks.flag_peaks(clean(spark, sf_dir)).select("event_id", "kwh_intervalo", "es_pico")


@register
def flag_peaks_by_tariff(spark, sf_dir):
    return peaks.flag_peaks(clean(spark, sf_dir), ["tarifa"]).select(
        "event_id", "tarifa", "es_pico"
    )


@register
def flag_peaks_by_home(spark, sf_dir):
    return peaks.flag_peaks(clean(spark, sf_dir), ["id_hogar"]).select("event_id", "es_pico")


@register
def transform(spark, sf_dir):
    return features.transform(readings(spark, sf_dir)).select(
        "event_id", "timestamp", "hora", "dia_semana", "es_finde", "es_pico", "costo_mxn"
    )


@register
def cost_etl(spark, sf_dir):
    return tariffs.cost_etl(irregular(clean(spark, sf_dir))).select("event_id", "costo_mxn")


@register
def cost_dwh(spark, sf_dir):
    odd = irregular(clean(spark, sf_dir))
    return tariffs.cost_dwh(
        odd, table(spark, sf_dir, "medidores"), homes=table(spark, sf_dir, "hogar_tarifa")
    ).select("event_id", "costo_dwh")


@register
def price_flat(spark, sf_dir):
    return tariffs.price_flat(clean(spark, sf_dir), out="costo").groupBy("tarifa").agg(
        F.count("*").alias("filas"), exact.exact_sum(F.col("costo")).alias("costo")
    )


def _scaled(spark, sf_dir) -> DataFrame:
    """Clean readings at ten times their energy, so that totals reach all blocks."""
    return clean(spark, sf_dir).withColumn("kwh_intervalo", F.col("kwh_intervalo") * 10)


@register
def month_to_date(spark, sf_dir):
    return tariffs.month_to_date(_scaled(spark, sf_dir), tiebreak=["event_id"]).select(
        "event_id", "kwh_acumulado_mes"
    )


@register
def price_tiered(spark, sf_dir):
    totals = tariffs.month_to_date(_scaled(spark, sf_dir), tiebreak=["event_id"])
    return tariffs.price_tiered(totals).select("event_id", "nivel", "costo_mxn")


@register
def price_tiered_totals(spark, sf_dir):
    totals = tariffs.month_to_date(_scaled(spark, sf_dir), tiebreak=["event_id"])
    return tariffs.price_tiered(totals).groupBy("nivel").agg(
        F.count("*").alias("filas"), exact.exact_sum(F.col("costo_mxn")).alias("costo")
    )


@register
def month_ledger(spark, sf_dir):
    """Three batches, the last of them late and the second repeated after it: prices as over all readings."""
    path = new_root(spark, sf_dir).star
    rows = _scaled(spark, sf_dir)
    late = F.pmod(F.col("event_id"), F.lit(5)) == 0
    second = F.col("timestamp") >= F.lit("2024-01-12").cast("timestamp_ntz")
    batches = [rows.where(~late & ~second), rows.where(~late & second), rows.where(late)]
    for lote in (0, 1, 2, 1):
        ledger.price_batch(batches[lote], path, lote, tiebreak=["event_id"])
    return ledger.priced_readings(spark, path).select("event_id", "nivel", "costo_mxn")


@register
def month_bills(spark, sf_dir):
    """Bills per home and month from the ledger of two batches, every other reading being late."""
    path = new_root(spark, sf_dir).star
    rows = _scaled(spark, sf_dir)
    for lote in (0, 1):
        ledger.price_batch(rows.where(F.pmod("event_id", F.lit(2)) == lote), path, lote, tiebreak=["event_id"])
    bills = ledger.month_bills(spark, path)
    return bills.select("id_hogar", "mes", "kwh", "costo", "lecturas", (F.col("correcciones") > 0).alias("corregida"))


@register
def tier_bounds(spark, sf_dir):
    """Blocks with their bounds and the number of home-months that end in each."""
    months = _scaled(spark, sf_dir).groupBy(
        "tarifa", "id_hogar", F.year("timestamp"), F.month("timestamp")
    ).agg(exact.exact_sum(F.col("kwh_intervalo")).alias("total"))
    tiers = books.tier_bounds(spark)
    used = books.tier_range_join(months, tiers, "tarifa", "total").groupBy(
        "tarifa", "nivel"
    ).agg(F.count("*").alias("n"))
    return tiers.join(F.broadcast(used), ["tarifa", "nivel"], "left").select(
        "tarifa", "nivel", "desde", F.coalesce("hasta", F.lit(-1.0)).alias("hasta"), "precio",
        exact.zero_if_null(F.col("n")).alias("hogares_mes"),
    )


@register
def tier_range_join(spark, sf_dir):
    totals = tariffs.month_to_date(_scaled(spark, sf_dir), tiebreak=["event_id"])
    return books.tier_range_join(totals, books.tier_bounds(spark), "tarifa").select(
        "event_id", "nivel", "precio"
    )


@register
def resolve_home_tariff(spark, sf_dir):
    odd = irregular(clean(spark, sf_dir))
    return tariffs.resolve_home_tariff(odd, table(spark, sf_dir, "medidores")).select(
        "event_id", "hogar_resuelto", "tarifa_resuelta"
    )


@register
def zero_if_null(spark, sf_dir):
    """Totals of every day from the one before the first reading to the one after the last."""
    fact = star(spark, sf_dir).fact
    bounds = fact.agg(F.date_sub(F.min("fecha"), 1).alias("a"), F.date_add(F.max("fecha"), 1).alias("b"))
    days = bounds.where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("fecha"))
    totals = fact.groupBy("fecha").agg(exact.exact_sum(F.col("kwh_intervalo")).alias("sum"))
    return days.join(totals, "fecha", "left").select(
        F.col("fecha").cast("string").alias("dia"), exact.zero_if_null(F.col("sum")).alias("kwh")
    )


# --- joins ------------------------------------------------------------------------------------


@register
def join_region(spark, sf_dir):
    return star_ops.join_region(star(spark, sf_dir)).select(
        "timestamp_real", "hogar_key", "region", "tarifa_kwh"
    )


@register
def join_time(spark, sf_dir):
    return star_ops.join_time(star(spark, sf_dir)).select(
        "timestamp_real", "hogar_key", "fecha", "hora", "dia_semana", "mes_nombre"
    )


@register
def join_home(spark, sf_dir):
    return star_ops.join_home(star(spark, sf_dir)).select(
        "timestamp_real", "id_hogar", "id_medidor", "ciudad"
    )


@register
def resolve_keys(spark, sf_dir):
    """Keys of readings with blank and unknown attributes; a miss shows as -1."""
    keyed = star_ops.resolve_keys(
        irregular(clean(spark, sf_dir)),
        *[table(spark, sf_dir, t)
          for t in ("dim_tiempo", "dim_region", "hogar_tarifa", "medidores")],
    )
    return keyed.select("event_id", *[
        F.coalesce(k, F.lit(-1)).alias(k) for k in ("tiempo_key", "hogar_key", "region_key")
    ])


@register
def lookup_meter(spark, sf_dir):
    odd = irregular(readings(spark, sf_dir))
    return books.lookup_meter(odd, table(spark, sf_dir, "medidores")).select(
        "event_id",
        F.coalesce("hogar_registro", F.lit("-")).alias("hogar_registro"),
        F.coalesce("tarifa_registro", F.lit("-")).alias("tarifa_registro"),
    )


@register
def tariff_of_city(spark, sf_dir):
    return books.tariff_of_city(irregular(readings(spark, sf_dir))).select(
        "event_id", "ciudad", "tarifa_ciudad"
    )


@register
def lookup_tariff(spark, sf_dir):
    return books.lookup_tariff(irregular(readings(spark, sf_dir))).select(
        "event_id", "tarifa_aplicada", "precio_base"
    )


@register
def dense_hours(spark, sf_dir):
    """Peaks by hour, all 24 hours; some have none."""
    s = star(spark, sf_dir)
    peaks = star_ops.join_time(s, marts.only_peaks(s.fact)).groupBy("hora")
    return marts.dense_hours(peaks.agg(F.count("*").alias("lecturas")), "lecturas")


@register
def dense_heatmap(spark, sf_dir):
    """All cells for the peaks only, which leave many cells empty."""
    s = star(spark, sf_dir)
    cells = star_ops.join_time(s, marts.only_peaks(s.fact)).groupBy("dia_semana", "hora").agg(
        exact.exact_avg(F.col("kwh_intervalo")).alias("kwh")
    )
    return marts.dense_heatmap(cells)


@register
def fk_violations(spark, sf_dir):
    return star_ops.fk_violations(star(spark, sf_dir))


@register
def pk_duplicates(spark, sf_dir):
    """Homes with several readings in one quarter hour."""
    return star_ops.pk_duplicates(star(spark, sf_dir).fact, "hogar_key", "tiempo_key")


@register
def pk_duplicates_dimensions(spark, sf_dir):
    """No dimension key occurs twice: counts per table."""
    s = star(spark, sf_dir)

    def audit(name: str, table: DataFrame, key: str) -> DataFrame:
        return star_ops.pk_duplicates(table, key).agg(
            F.lit(name).alias("tabla"), F.count("*").alias("claves")
        )

    return (
        audit("dim_tiempo", s.tiempo, "tiempo_key")
        .unionByName(audit("dim_hogar", s.hogar, "hogar_key"))
        .unionByName(audit("dim_hogar.id_hogar", s.hogar, "id_hogar"))
        .unionByName(audit("dim_region", s.region, "region"))
    )


# --- aggregations over the star ---------------------------------------------------------------


def _mart(function: Callable, name: str | None = None) -> None:
    def run(spark, sf_dir):
        return function(star(spark, sf_dir))

    register(run, name or function.__name__)


for _function in (
    marts.v_consumo_por_region, marts.v_consumo_por_hogar, marts.v_perfil_horario, marts.v_picos,
    marts.v_resumen_general, marts.resumen, marts.consumo_region, marts.ranking_hogares,
    marts.serie_diaria, marts.perfil_horario, marts.heatmap, marts.picos, marts.picos_por_hora,
    marts.top_picos, marts.warehouse_totals,
):
    _mart(_function)


@register
def resumen_diario(spark, sf_dir):
    s = star(spark, sf_dir)
    return star_ops.resumen_diario(s.fact)


def _report(function: Callable, kind: str, value: str, name: str) -> None:
    def run(spark, sf_dir):
        return function(star(spark, sf_dir), kind, value)

    register(run, name)


for _function, _name in (
    (daily.consumo_por_region, "daily_consumo_por_region"),
    (daily.consumo_por_hogar, "daily_consumo_por_hogar"),
    (daily.resumen_general, "daily_resumen_general"),
    (daily.resumen, "daily_resumen"),
    (daily.top_picos, "daily_top_picos"),
    (hourly.consumo_por_region, "hourly_consumo_por_region"),
    (hourly.perfil_horario, "hourly_perfil_horario"),
    (hourly.picos_por_hora, "hourly_picos_por_hora"),
    (hourly.heatmap, "hourly_heatmap"),
):
    _mart(_function, _name)


_in_catalog: set[str] = set()


def _published(name: str) -> Query:
    """The view as a new session finds it, over the star with folded days."""
    def run(spark, sf_dir):
        _folded(spark, sf_dir)
        database = f"meterlake_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}"
        path = _folded_stars[spark.sparkContext.applicationId, sf_dir]
        if path not in _in_catalog:
            catalog.publish_star(spark, path, database)
            _in_catalog.add(path)
        return spark.newSession().table(f"{database}.{name}")

    return run


for _name in ("v_consumo_por_region", "v_consumo_por_hogar", "v_perfil_horario", "v_picos", "v_resumen_general"):
    register(_published(_name), f"catalog_{_name}")
register(_published("fact_resumen_diario"), "catalog_resumen_diario")

_in_buckets: dict[tuple[str, str], str] = {}


def _homes(spark, sf_dir) -> homes.HomeTables:
    """The home tables in buckets, as a new session finds them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _in_buckets:
        database = f"cubetas_{hashlib.md5(sf_dir.encode()).hexdigest()[:8]}"
        homes.publish_homes(spark, loaded(spark, sf_dir).star, database, buckets=16)
        _in_buckets[key] = database
    return homes.open_homes(spark, _in_buckets[key])


@register
def bucketed_resolve_keys(spark, sf_dir):
    """Keys from home tables in buckets; a miss shows as -1."""
    odd = irregular(clean(spark, sf_dir))
    tiempo, region = (table(spark, sf_dir, t) for t in ("dim_tiempo", "dim_region"))
    keyed = star_ops.resolve_keys(odd, tiempo, region, *homes.lookups_of(odd, _homes(spark, sf_dir)))
    return keyed.select("event_id", *[
        F.coalesce(k, F.lit(-1)).alias(k) for k in ("tiempo_key", "hogar_key", "region_key")
    ])


@register
def bucketed_lookup_meter(spark, sf_dir):
    odd = irregular(readings(spark, sf_dir))
    return books.lookup_meter(odd, _homes(spark, sf_dir).medidores).select(
        "event_id",
        F.coalesce("hogar_registro", F.lit("-")).alias("hogar_registro"),
        F.coalesce("tarifa_registro", F.lit("-")).alias("tarifa_registro"),
    )


@register
def bucketed_join_home(spark, sf_dir):
    by_key = homes.with_homes(star(spark, sf_dir), _homes(spark, sf_dir))
    return star_ops.join_home(by_key).select("timestamp_real", "id_hogar", "id_medidor", "ciudad")


@register
def hogares_por_periodo(spark, sf_dir):
    """Different homes by day, week and month, after a fold and a batch that came again."""
    s = _folded(spark, sf_dir)
    dia, semana, mes = (
        daily.hogares_por_periodo(s, kind).select(F.lit(kind).alias("tipo"), "desde", "hogares")
        for kind in ("dia", "semana", "mes")
    )
    return dia.unionByName(semana).unionByName(mes)


for _function, _kind, _value, _name in (
    (daily.report_region, "mes", MONTH, "daily_report_region"),
    (daily.report_homes, "semana", WEEK, "daily_report_homes"),
    (daily.report_peaks, "semana", WEEK, "daily_report_peaks"),
    (daily.preview_resumen, "semana", WEEK, "daily_preview_resumen"),
    (hourly.report_region, "hora", HOUR, "hourly_report_region"),
    (hourly.report_profile, "dia", DAY, "hourly_report_profile"),
    (report.preview_resumen, "semana", WEEK, "preview_resumen"),
    (report.preview_resumen, "hora", HOUR, "preview_resumen_hour"),
    (report.report_region, "mes", MONTH, "report_region"),
    (report.report_homes, "semana", WEEK, "report_homes"),
    (report.ranked_homes, "mes", MONTH, "ranked_homes"),
    (report.report_peaks, "semana", WEEK, "report_peaks"),
    (report.report_profile, "dia", DAY, "report_profile"),
):
    _report(_function, _kind, _value, _name)


@named("period_report")
def period_report_parts(spark, sf_dir):
    """Rows in each part of a day's report."""
    parts = report.period_report(star(spark, sf_dir), "dia", DAY)
    counts = [
        df.agg(F.lit(name).alias("parte"), F.count("*").alias("filas"))
        for name, df in parts.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


@register
def period_report_values(spark, sf_dir):
    """What the parts of a day's report hold: a line and its kWh."""
    lines = {"resumen": "label", "por_region": "region", "por_hogar": "id_hogar", "picos": "timestamp_real", "perfil": "hora"}
    result = None
    for name, df in report.period_report(star(spark, sf_dir), "dia", DAY).items():
        value = "kwh_prom" if name == "perfil" else "kwh"
        part = df.select(F.lit(name).alias("parte"), F.col(lines[name]).cast("string").alias("linea"), F.col(value).alias("kwh"))
        result = part if result is None else result.unionByName(part)
    return result


@register
def preview_resumen_empty(spark, sf_dir):
    return report.preview_resumen(star(spark, sf_dir), "mes", "2031-05", keep_empty=True)


@register
def fk_violations_found(spark, sf_dir):
    """As fk_violations, dimensions having lost some of their rows."""
    s = star(spark, sf_dir)
    return star_ops.fk_violations(star_ops.Star(
        s.fact, s.tiempo.where("hora <> 3"), s.region.where("region_key <> 5"), s.hogar.where("hogar_key % 7 <> 0")
    ))


@register
def pk_duplicates_found(spark, sf_dir):
    """Keys of a home dimension that holds some homes twice and a few three times."""
    hogar = star(spark, sf_dir).hogar
    twice = hogar.unionByName(hogar.where("hogar_key % 5 = 0")).unionByName(hogar.where("hogar_key % 15 = 0"))
    return star_ops.pk_duplicates(twice, "hogar_key")


@register
def cost_other_book(spark, sf_dir):
    """Two tariffs of another utility, the second for all cities that the first does not serve."""
    book = (
        Tariff("A", ("Guadalajara", "Monterrey"), (Block(None, 2.125),), 500, 9.0),
        Tariff("B", (), (Block(None, 3.25),), 500, 9.0),
    )
    priced = tariffs.cost_dwh(clean(spark, sf_dir), registry(spark, sf_dir), book, default="B")
    return priced.select("event_id", "costo_dwh")


@register
def batch_stats(spark, sf_dir):
    return quality.batch_stats(readings(spark, sf_dir))


@register
def batch_moments(spark, sf_dir):
    return peaks.batch_moments(clean(spark, sf_dir)).select(
        "lecturas", exact.half_up(F.col("media"), 8).alias("media"),
        exact.half_up(F.col("desviacion"), 8).alias("desviacion"),
    )


@register
def batch_moments_by_tariff(spark, sf_dir):
    return peaks.batch_moments(clean(spark, sf_dir), ["tarifa"]).select(
        "tarifa", "lecturas", exact.half_up(F.col("media"), 8).alias("media"),
        exact.half_up(F.col("desviacion"), 8).alias("desviacion"),
    )


# --- listings and shapes ----------------------------------------------------------------------


@register
def unique_buckets(spark, sf_dir):
    bucket = cal.bucket_15min(F.col("timestamp"))
    per_day = clean(spark, sf_dir).select(bucket.alias("b")).distinct()
    return per_day.groupBy(F.col("b").cast("date").alias("fecha")).agg(
        F.count("*").alias("cuartos")
    )


for _function in (
    listings.period_list_hour, listings.period_list_day, listings.period_list_week,
    listings.period_list_month,
):

    def _listing(function: Callable) -> None:
        def run(spark, sf_dir):
            return function(star(spark, sf_dir).tiempo)

        register(run, function.__name__)

    _listing(_function)


@register
def series_by_region(spark, sf_dir):
    return marts.series_by_region(marts.serie_diaria(star(spark, sf_dir)), "fecha", "kwh")


@register
def heatmap_matrix(spark, sf_dir):
    return marts.heatmap_matrix(marts.heatmap(star(spark, sf_dir)))


# --- scalar functions -------------------------------------------------------------------------


def _bands(spark, sf_dir) -> DataFrame:
    """Reading energies at scales that reach every band of the texts."""
    return readings(spark, sf_dir).select(
        "event_id",
        F.explode(F.array(F.lit(0.0001), F.lit(0.01), F.lit(1.0), F.lit(1000.0))).alias("escala"),
        "kwh_intervalo",
    ).withColumn("v", F.col("kwh_intervalo") * F.col("escala"))


@register
def fmt_kwh(spark, sf_dir):
    return _bands(spark, sf_dir).select(
        "event_id", "escala", text.fmt_kwh(F.col("v")).alias("texto")
    )


@register
def fmt_mxn(spark, sf_dir):
    return _bands(spark, sf_dir).select(
        "event_id", "escala", text.fmt_mxn(F.col("v")).alias("texto")
    )


@register
def fmt_dashboard(spark, sf_dir):
    return _bands(spark, sf_dir).select(
        "event_id", "escala",
        text.fmt_dashboard_kwh(F.col("v")).alias("kwh"),
        text.fmt_dashboard_mxn(F.col("v")).alias("mxn"),
    )


@register
def period_label(spark, sf_dir):
    """Labels of all periods of the star."""
    tiempo = star(spark, sf_dir).tiempo
    result = None
    for kind in periods.KINDS:
        part = listings.period_list(tiempo, kind, complete=True).select(
            F.lit(kind).alias("kind"), "value",
            periods.period_label(kind, F.col("value")).alias("label"),
        )
        result = part if result is None else result.unionByName(part)
    return result


@register
def day_index(spark, sf_dir):
    tiempo = star(spark, sf_dir).tiempo
    return tiempo.select("dia_semana").distinct().select(
        "dia_semana",
        cal.day_index(F.concat(F.lit(" "), F.upper("dia_semana"), F.lit("  "))).alias("dia"),
    )


@register
def energy_columns(spark, sf_dir):
    watts, volts = F.col("potencia_w"), F.col("voltaje")
    return quality.drop_null_readings(readings(spark, sf_dir)).select(
        "event_id",
        energy.kwh_of_power(watts).alias("kwh"),
        energy.current_of_power(watts, volts).alias("corriente"),
    )


@register
def expected_load(spark, sf_dir):
    """Expected against observed power by hour."""
    hourly = clean(spark, sf_dir).groupBy(F.hour("timestamp").alias("hora")).agg(
        exact.exact_avg(F.col("potencia_w")).alias("w")
    )
    mean, deviation = energy.expected_load(F.col("hora"))
    return hourly.select(
        "hora", mean.alias("media_w"), deviation.alias("desv_w"),
        exact.half_up(F.col("w"), 3).alias("observada_w"),
    )


# --- streaming --------------------------------------------------------------------------------


@named("process_batch")
def stream_pipeline(spark, sf_dir):
    """The events as a JSON stream through the whole ingestion, read back from the star."""
    paths = new_root(spark, sf_dir)
    warehouse.create_star(spark, paths.star, registry(spark, sf_dir))
    events = (
        spark.readStream.schema(read_events(spark, sf_dir).schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    messages = decode_readings(encode_readings(readings_from_events(events)))
    pipeline.drain(messages.withColumn("ingested_at", F.current_timestamp()), paths)
    result = warehouse.open_star(spark, paths.star)
    return marts.v_consumo_por_region(result)


@named("running_totals")
def stream_totals(spark, sf_dir):
    """Running totals as kept by the daily rollup."""
    return pipeline.running_totals(spark, loaded(spark, sf_dir))
