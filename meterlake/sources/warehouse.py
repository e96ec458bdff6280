"""The star as Parquet tables in one folder.

Facts, rollup and quarter hours are partitioned by date and batch: date predicates prune them, and a
repeated batch replaces its own partitions. A batch lists the dates it touches and no others. Once a day is
closed, ``fold_days`` makes one partition of its many. Other dimensions only grow, by rows whose key is absent.

A fold is written beside the partitions it replaces, under a name no reader accepts, until its journal
entry is there; from then on readers accept it and leave out what it replaces. So it may be interrupted
anywhere and repeated. Folded facts remember their batch (``lote``): a batch that comes again after all is
first taken out of its fold.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schemas
from meterlake.fixed_values import TARIFFS, Tariff
from meterlake.operators import star as ops
from meterlake.operators.star import Star
from meterlake.plans import marts
from meterlake.session import constant_frame
from meterlake.sources import files
from meterlake.sources.lake import replace_partitions

_HOME_LOOKUP = T.StructType([
    T.StructField("id_hogar", T.StringType()),
    T.StructField("hogar_key", T.LongType()),
    T.StructField("tarifa_ciudad", T.StringType()),
])

TABLES = {
    "dim_tiempo": schemas.DIM_TIEMPO,
    "dim_region": schemas.DIM_REGION,
    "dim_hogar": schemas.DIM_HOGAR,
    "fact_consumo": schemas.FACT_CONSUMO,
    "fact_resumen_diario": T.StructType(
        [*schemas.RESUMEN_DIARIO.fields, T.StructField("batch_id", T.StringType())]
    ),
    "fact_resumen_horario": T.StructType(
        [*schemas.RESUMEN_HORARIO.fields, T.StructField("batch_id", T.StringType())]
    ),
    "fact_picos_mayores": T.StructType(
        [*schemas.PICOS_MAYORES.fields, T.StructField("batch_id", T.StringType())]
    ),
    "fact_hogares_activos": T.StructType(
        [*schemas.HOGARES_ACTIVOS.fields, T.StructField("batch_id", T.StringType())]
    ),
    "medidores": schemas.REGISTRY,
    "hogar_tarifa": _HOME_LOOKUP,
}
#: What is kept of the facts of a date: how parts of it merge, how it comes from facts, and its order in files.
ROLLUPS = {
    "fact_resumen_diario": (ops.merge_daily, lambda facts: ops.daily_rows(ops.resumenes(facts)), "hogar_key"),
    "fact_resumen_horario": (ops.merge_hourly, lambda facts: ops.hourly_rows(ops.resumenes(facts)), "hora"),
    "fact_picos_mayores": (ops.biggest_peaks, ops.biggest_peaks, "hogar_key"),
    "fact_hogares_activos": (ops.merge_active, ops.active_homes, "cubeta"),
}
#: Tables with a partition per date and batch.
DATED = ("fact_consumo", *ROLLUPS, "dim_tiempo")
#: In the files of ``fact_consumo``: the batch of a folded row, NULL in partitions of a single batch.
LOTE = T.StructField("lote", T.StringType())
FOLD = "plegado-"


def stored_schema(table: str) -> T.StructType:
    fields = list(TABLES[table].fields)
    if table == "dim_tiempo":
        fields.append(T.StructField("batch_id", T.StringType()))
    if table == "fact_consumo":
        fields.append(LOTE)
    return T.StructType(fields)


def _reader(spark: SparkSession, path: str, table: str):
    return spark.read.schema(stored_schema(table)).option("basePath", f"{path}/{table}")


def read_parts(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The current partitions of a dated table, ``batch_id`` being the partition's name."""
    folds, replaced = _folds(spark, path)
    part = F.col("batch_id")
    counts = ~part.startswith(FOLD) | part.isin(*folds) if folds else ~part.startswith(FOLD)
    for day, parts in replaced.get(table, {}).items():
        counts &= ~((F.col("fecha") == F.lit(day).cast("date")) & part.isin(*parts))
    return _reader(spark, path, table).parquet(f"{path}/{table}").where(counts)


def _of_days(spark: SparkSession, path: str, table: str, days: Iterable[date]) -> DataFrame:
    """The current partitions of some days; only their folders are listed."""
    state = _folds(spark, path)
    parts = {d: _current(spark, path, table, d, state) for d in days}
    return _of_parts(spark, path, table, parts)


def _of_parts(spark: SparkSession, path: str, table: str, parts: Mapping[date, Sequence[str]]) -> DataFrame:
    folders = [f"{path}/{table}/fecha={d}/batch_id={p}" for d, own in parts.items() for p in own]
    if not folders:
        return constant_frame(spark, [], stored_schema(table))
    return _reader(spark, path, table).parquet(*folders)


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    if table not in DATED:
        return spark.read.schema(TABLES[table]).parquet(f"{path}/{table}")
    df = read_parts(spark, path, table)
    if table == "fact_consumo":
        df = df.withColumn("batch_id", F.coalesce("lote", "batch_id"))
    return df.select(*TABLES[table].names)


def open_star(spark: SparkSession, path: str) -> Star:
    return Star(
        fact=read_table(spark, path, "fact_consumo"),
        tiempo=read_table(spark, path, "dim_tiempo"),
        region=read_table(spark, path, "dim_region"),
        hogar=read_table(spark, path, "dim_hogar"),
        resumen_diario=ops.merge_daily(read_table(spark, path, "fact_resumen_diario")),
        resumen_horario=ops.merge_hourly(read_table(spark, path, "fact_resumen_horario")),
        picos_mayores=ops.biggest_peaks(read_table(spark, path, "fact_picos_mayores")),
        hogares_activos=read_table(spark, path, "fact_hogares_activos"),
    )


def _read_or_empty(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, bool]:
    """The table and whether it exists yet."""
    if files.names(spark, f"{path}/{table}"):
        return read_table(spark, path, table), True
    return constant_frame(spark, [], TABLES[table]), False


def _add_rows(spark: SparkSession, path: str, table: str, new: Callable) -> DataFrame:
    """Append ``new(existing)`` to a table, creating it if needed; returns the table as it is now."""
    existing, found = _read_or_empty(spark, path, table)
    rows = new(existing).select(*TABLES[table].names)
    # Not cached in between: a cached plan keeps all shuffle partitions, one small file each.
    if not found or not rows.isEmpty():
        rows.write.mode("append").parquet(f"{path}/{table}")
    return read_table(spark, path, table)


def create_star(
    spark: SparkSession, path: str, registry: DataFrame, books: Sequence[Tariff] = TARIFFS
) -> None:
    """Create missing tables with their declared schema, then add absent regions and homes.

    May run again, also with a longer registry: what is there stays as it is.
    """
    for table in DATED:
        if not files.names(spark, f"{path}/{table}"):
            empty = constant_frame(spark, [], stored_schema(table))
            empty.write.partitionBy("fecha", "batch_id").parquet(f"{path}/{table}")

    region = _add_rows(
        spark, path, "dim_region",
        lambda known: ops.new_dim_region(spark, books, known),
    )
    meters = _add_rows(
        spark, path, "medidores",
        lambda known: ops.merge_new_keys(
            known, registry.select(*schemas.REGISTRY.names), "id_medidor"
        ),
    )
    hogar = _add_rows(
        spark, path, "dim_hogar", lambda known: ops.new_dim_hogar(meters, known, region)
    )
    ops.home_lookup(hogar, meters, books).select(*_HOME_LOOKUP.names).write.mode(
        "overwrite"
    ).parquet(f"{path}/hogar_tarifa")


def load_star(
    clean: DataFrame,
    path: str,
    batch_id: str = "0",
    books: Sequence[Tariff] = TARIFFS,
    micro_batch: bool = False,
    days: Sequence[date] | None = None,
    lookups: tuple[DataFrame, DataFrame] | None = None,
) -> None:
    """Load a clean batch: new quarter hours, facts, and the batch's part of the daily rollup.

    ``clean`` is read several times: pass a stored batch, not a long lineage. Any step may be
    repeated with the same batch without effect. ``micro_batch`` cuts the home lookup and the registry
    to the ids of the batch; both are still scanned. The dates (``days``, if known already) of the batch come to the driver: at most one
    value per day of the calendar, as many as the folders the batch writes. ``lookups``: see ``load_fact``.
    """
    spark = clean.sparkSession
    if days is None:
        dates = clean.select(F.col("timestamp").cast("date").alias("fecha")).where("fecha IS NOT NULL")
        days = [r.fecha for r in dates.distinct().collect()]
    finish_folds(spark, path)
    take_out_of_folds(spark, path, batch_id, days)
    merge_dim_tiempo(clean, path, batch_id, days)
    load_fact(clean, path, batch_id, books, micro_batch, lookups)
    refresh_daily(days, path, batch_id)


def merge_dim_tiempo(clean: DataFrame, path: str, batch_id: str = "0", days: Sequence[date] | None = None) -> None:
    """Add the quarter hours of the batch that the dimension lacks, as a partition of the batch.

    ``days`` are the dates of the batch; only their quarter hours are looked up. If an attempt is repeated,
    what it wrote counts as known.
    """
    spark = clean.sparkSession
    known = read_table(spark, path, "dim_tiempo") if days is None else _of_days(spark, path, "dim_tiempo", days)
    new = ops.dim_tiempo(clean).join(known.select("tiempo_key"), "tiempo_key", "left_anti")
    replace_partitions(
        new.select(*TABLES["dim_tiempo"].names, F.lit(batch_id).alias("batch_id")),
        f"{path}/dim_tiempo", "fecha", "batch_id",
    )


def load_fact(
    clean: DataFrame,
    path: str,
    batch_id: str = "0",
    books: Sequence[Tariff] = TARIFFS,
    small_batch: bool = False,
    lookups: tuple[DataFrame, DataFrame] | None = None,
) -> None:
    """Append the facts of a batch, replacing those of an earlier attempt.

    The batch's quarter hours must be in the time dimension already (``merge_dim_tiempo``).

    ``small_batch`` (micro-batches) first cuts the home lookup and the registry to the ids that
    occur in the batch, so neither large table is shuffled for every batch. ``lookups``, the home lookup and the
    registry in buckets (``homes.lookups_of``), are used as they are.
    """
    spark = clean.sparkSession
    homes, meters = lookups or (read_table(spark, path, "hogar_tarifa"), read_table(spark, path, "medidores"))
    if small_batch and lookups is None:
        meters = meters.join(clean.select("id_medidor").distinct(), "id_medidor", "left_semi")
        seen = clean.select("id_hogar").unionByName(meters.select("id_hogar")).distinct()
        homes = homes.join(seen, "id_hogar", "left_semi")
    fact = ops.build_fact(
        clean,
        None,
        read_table(spark, path, "dim_region"),
        homes,
        meters,
        books,
        batch_id,
    )
    replace_partitions(
        fact.select(*schemas.FACT_CONSUMO.names), f"{path}/fact_consumo", "fecha", "batch_id"
    )


def touched_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts of the dates in ``dates`` (column ``fecha``), however many.

    Their first and last date prune the partitions; a semi join selects between them.
    """
    span = dates.agg(F.min("fecha").alias("first"), F.max("fecha").alias("last")).first()
    if span["first"] is None:
        return fact.where("false")
    near = fact.where(F.col("fecha").between(F.lit(span["first"]), F.lit(span["last"])))
    return near.join(dates.select("fecha").distinct(), "fecha", "left_semi")


def refresh_daily(dates: DataFrame | Sequence[date], path: str, batch_id: str | None = None) -> None:
    """Recompute the rollup rows of the given dates from their facts; other dates stay.

    Rollup rows are kept per partition of the facts and added up when read, so a batch writes its own part
    only, whatever else the day holds; ``batch_id`` says which partition, None recomputes those of all.
    Repeating it replaces the same partitions. Dates as a DataFrame (column ``fecha``) stay off the driver;
    of dates as a list only the folders are listed.
    """
    if isinstance(dates, DataFrame):
        facts = touched_dates(read_parts(dates.sparkSession, path, "fact_consumo"), dates)
        facts = facts if batch_id is None else facts.where(F.col("batch_id") == batch_id)
    elif batch_id is None:
        facts = _of_days(SparkSession.active(), path, "fact_consumo", dates)
    else:
        facts = _of_parts(SparkSession.active(), path, "fact_consumo", {d: [batch_id] for d in dates})
    _write_daily(facts, path)


def _write_daily(facts: DataFrame, path: str) -> None:
    """Both rollups of ``facts`` and their homes, from one pass over them, and their biggest peaks."""
    both = ops.resumenes(facts, by=("batch_id",)).persist()
    for table, rows in (("fact_resumen_diario", ops.daily_rows), ("fact_resumen_horario", ops.hourly_rows)):
        replace_partitions(
            rows(both, "batch_id").select(*TABLES[table].names), f"{path}/{table}", "fecha", "batch_id"
        )
    homes = ops.active_homes(ops.daily_rows(both, "batch_id"), by=("batch_id",))
    replace_partitions(homes.select(*TABLES["fact_hogares_activos"].names), f"{path}/fact_hogares_activos", "fecha", "batch_id")
    both.unpersist()
    replace_partitions(
        ops.biggest_peaks(facts, by=("batch_id",)).select(*TABLES["fact_picos_mayores"].names),
        f"{path}/fact_picos_mayores", "fecha", "batch_id",
    )


# --- folding ----------------------------------------------------------------------------------


def _folds(spark: SparkSession, path: str) -> tuple[list[str], dict[str, dict[str, list[str]]]]:
    """Names of the folds that count, and by table and date the partitions that unfinished ones replace."""
    entries = files.names(spark, f"{path}/plegados")
    replaced: dict[str, dict[str, list[str]]] = {}
    for entry in entries:
        if entry.endswith(".json") and entry.replace(".json", ".hecho") not in entries:
            for table, days in json.loads(files.read(spark, f"{path}/plegados/{entry}")).items():
                for day, parts in days.items():
                    replaced.setdefault(table, {}).setdefault(day, []).extend(parts)
    return sorted({e.rpartition(".")[0] for e in entries if e.startswith(FOLD)}), replaced


def _current(spark: SparkSession, path: str, table: str, day: date, state: tuple) -> list[str]:
    """Names of a day's partitions that count under the ``state`` of folds, those never finished left out."""
    folds, replaced = state
    gone = replaced.get(table, {}).get(str(day), [])
    parts = [n.removeprefix("batch_id=") for n in files.names(spark, f"{path}/{table}/fecha={day}") if n.startswith("batch_id=")]
    return [p for p in parts if p not in gone and (not p.startswith(FOLD) or p in folds)]


def finish_folds(spark: SparkSession, path: str) -> None:
    """Remove what committed folds replace. Called before every load and fold, and as often as one likes."""
    folder = f"{path}/plegados"
    entries = files.names(spark, folder)
    for entry in entries:
        if not entry.endswith(".json"):
            continue
        done = entry.replace(".json", ".hecho")
        if done not in entries:
            for table, days in json.loads(files.read(spark, f"{folder}/{entry}")).items():
                for day, parts in days.items():
                    for part in parts:
                        files.remove(spark, f"{path}/{table}/fecha={day}/batch_id={part}")
            files.publish(spark, f"{folder}/{done}", entry)
        files.remove(spark, f"{folder}/{entry}")


def fold_days(
    spark: SparkSession, path: str, before: date, parts: int = 2, since: date | None = None, remove: bool = True
) -> list[date]:
    """Make one partition of the many of every day before ``before``, in facts, rollup and quarter hours.

    Only days with ``parts`` partitions at least in some table are written; a day that was folded and got late
    readings is folded again. The facts of a day are sorted by quarter hour and cut into files of advisory
    size; the rollup is added up. Queries give the same rows before, during and after. ``since`` spares the
    listing of old days. With ``remove=False`` the replaced partitions stay, unread, for queries that began
    earlier, until the next load or fold. Returns the days. Interrupted folds may simply be repeated; like
    loads, they need to be the only writer.
    """
    finish_folds(spark, path)
    days = sorted({
        date.fromisoformat(n.removeprefix("fecha="))
        for table in DATED for n in files.names(spark, f"{path}/{table}")
        if n.startswith("fecha=") and "__" not in n
    })
    plan: dict[str, dict[date, list[str]]] = {table: {} for table in DATED}
    state = _folds(spark, path)
    for day in days:
        if day < before and (since is None or day >= since):
            own = {table: _current(spark, path, table, day, state) for table in DATED}
            if max(map(len, own.values())) >= parts:
                for table in DATED:
                    if own[table]:
                        plan[table][day] = own[table]
    return _fold(spark, path, plan, remove)


def _fold(
    spark: SparkSession, path: str, plan: dict[str, dict[date, list[str]]], remove: bool = True, without: str | None = None
) -> list[date]:
    """Write, commit and finish the fold of the partitions in ``plan``, rows of the batch ``without`` left out."""
    chosen = sorted({d for own in plan.values() for d in own})
    if not chosen:
        return []
    entry = json.dumps({t: {str(d): p for d, p in own.items()} for t, own in plan.items()}, sort_keys=True)
    fold = FOLD + hashlib.md5(f"{entry}{without}".encode()).hexdigest()[:16]
    old = {table: _of_parts(spark, path, table, own) for table, own in plan.items()}
    for table in plan:  # what an interrupted attempt left
        for day in plan[table]:
            files.remove(spark, f"{path}/{table}/fecha={day}/batch_id={fold}")
    named = F.lit(fold).alias("batch_id")
    facts = old["fact_consumo"].withColumn("lote", F.coalesce("lote", "batch_id"))
    if without is not None:
        facts = facts.where(F.col("lote") != without)
    facts = facts.withColumn("batch_id", F.lit(fold))
    _write_fold(facts, path, "fact_consumo", "tiempo_key")
    written = {d: [fold] for d in chosen if f"batch_id={fold}" in files.names(spark, f"{path}/fact_consumo/fecha={d}")}
    for table, (merge, of_facts, order) in ROLLUPS.items():
        rows = merge(old[table]) if without is None else of_facts(_of_parts(spark, path, "fact_consumo", written))
        _write_fold(rows.select("*", named), path, table, order)
    if "dim_tiempo" in plan:
        times = old["dim_tiempo"].drop("batch_id").distinct().select("*", named)
        _write_fold(times, path, "dim_tiempo", "tiempo_key")
    files.publish(spark, f"{path}/plegados/{fold}.json", entry)
    if remove:
        finish_folds(spark, path)
    return chosen


def _write_fold(df: DataFrame, path: str, table: str, order: str) -> None:
    rows = df.select(*stored_schema(table).names).hint("rebalance", F.col("fecha"))
    rows.sortWithinPartitions("fecha", "batch_id", order).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("fecha", "batch_id").parquet(f"{path}/{table}")


def take_out_of_folds(spark: SparkSession, path: str, batch_id: str, days: Iterable[date]) -> None:
    """Fold again without ``batch_id`` those of ``days`` whose fold holds it, so that it can be loaded anew."""
    state = _folds(spark, path)
    if not state[0]:
        return

    def folds_of(table: str, day: date) -> list[str]:
        return [p for p in _current(spark, path, table, day, state) if p.startswith(FOLD)]

    folded = {}
    for day in days:
        parts = folds_of("fact_consumo", day)
        if parts:
            folded[day] = parts
    if not folded:
        return
    held = _of_parts(spark, path, "fact_consumo", folded).where(F.col("lote") == batch_id)
    again = {r.fecha: folded[r.fecha] for r in held.select("fecha").distinct().collect()}
    if again:
        rollups = {t: {d: folds_of(t, d) for d in again} for t in ROLLUPS}
        _fold(spark, path, {"fact_consumo": again, **rollups}, without=batch_id)


def register_views(spark: SparkSession, star: Star) -> None:
    """Tables and views under their SQL names, for ``query``."""
    tables = {
        "fact_consumo": star.fact,
        "dim_tiempo": star.tiempo,
        "dim_region": star.region,
        "dim_hogar": star.hogar,
        "fact_resumen_diario": star.resumen_diario,
        "fact_resumen_horario": star.resumen_horario,
        "v_consumo_por_region": marts.v_consumo_por_region(star),
        "v_consumo_por_hogar": marts.v_consumo_por_hogar(star),
        "v_perfil_horario": marts.v_perfil_horario(star),
        "v_picos": marts.v_picos(star),
        "v_resumen_general": marts.v_resumen_general(star),
    }
    for name, df in tables.items():
        if df is not None:
            df.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, **args: Any) -> DataFrame:
    """SQL over the registered views; values are bound as named parameters. Errors propagate."""
    return spark.sql(sql, args=args or None)
