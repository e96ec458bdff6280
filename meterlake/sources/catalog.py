"""The star in the session's catalogue: external tables over its folder, and permanent views by the public names.

``warehouse.register_views`` names DataFrames for one session. What is published here is found by every session
of the catalogue, without a DataFrame or this package: plain SQL text over Parquet folders. The views follow the
journal of folds by the same rules as ``warehouse.read_parts``, so they show every row once before, during and
after a fold.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from meterlake.sources.warehouse import DATED, FOLD, TABLES, stored_schema

_PARTITIONS = ("fecha", "batch_id")
_LISTED = "spark.sql.hive.manageFilesourcePartitions"


def _number(column: str) -> str:
    return f"NULLIF(CAST({column} AS DOUBLE), DOUBLE('NaN'))"


def _sum(column: str) -> str:
    """As ``functions.exact.exact_sum``."""
    return f"SUM(CAST(FLOOR({_number(column)} * 1000000D + 0.5D) AS BIGINT)) / 1000000D"


def _mean(column: str) -> str:
    return f"{_sum(column)} / NULLIF(COUNT({_number(column)}), 0)"


_MEASURES = f"""{_sum('kwh_intervalo')} AS kwh_total, {_sum('costo_mxn')} AS costo_total,
  COUNT_IF(es_pico) AS num_picos"""
_ADDED_UP = f"""{_sum('kwh_total')} AS kwh_total, MAX(kwh_max) AS kwh_max,
  {_sum('costo_total')} AS costo_total, SUM(num_lecturas) AS num_lecturas, SUM(num_picos) AS num_picos"""

#: Views over the current partitions (``{db}.<table>_vigente``) and other tables, in order of their dependence.
VIEWS = {
    "fact_consumo": """SELECT tiempo_key, hogar_key, region_key, timestamp_real, kwh_intervalo, voltaje, corriente,
  factor_potencia, potencia_w, costo_mxn, es_pico, fecha, COALESCE(lote, batch_id) AS batch_id
FROM {db}.fact_consumo_vigente""",
    "dim_tiempo": "SELECT * EXCEPT (batch_id) FROM {db}.dim_tiempo_vigente",
    "fact_resumen_diario": f"""SELECT hogar_key, region_key, {_ADDED_UP},
  {_sum('kwh_total')} / SUM(num_lecturas) AS kwh_promedio, fecha
FROM {{db}}.fact_resumen_diario_vigente GROUP BY fecha, hogar_key, region_key""",
    "fact_resumen_horario": f"""SELECT hora, region_key, {_ADDED_UP}, fecha
FROM {{db}}.fact_resumen_horario_vigente GROUP BY fecha, hora, region_key""",
    "fact_hogares_activos": """SELECT cubeta, BITMAP_OR_AGG(mapa) AS mapa, fecha
FROM {db}.fact_hogares_activos_vigente GROUP BY fecha, cubeta""",
    "v_consumo_por_region": f"""SELECT r.region, CAST(f.fecha AS STRING) AS fecha, {_MEASURES},
  {_mean('kwh_intervalo')} AS kwh_promedio, COUNT(*) AS num_lecturas
FROM {{db}}.fact_consumo f JOIN {{db}}.dim_region r USING (region_key)
WHERE f.tiempo_key IS NOT NULL GROUP BY r.region, f.fecha""",
    "v_consumo_por_hogar": f"""SELECT h.id_hogar, h.ciudad, r.region, t.kwh_total, t.costo_total, t.num_picos
FROM (SELECT hogar_key, region_key, {_MEASURES} FROM {{db}}.fact_consumo GROUP BY hogar_key, region_key) t
JOIN {{db}}.dim_region r ON r.region_key = t.region_key JOIN {{db}}.dim_hogar h ON h.hogar_key = t.hogar_key""",
    "v_perfil_horario": f"""SELECT t.hora, {_mean('kwh_intervalo')} AS kwh_promedio,
  MAX(f.kwh_intervalo) AS kwh_max, COUNT_IF(f.es_pico) AS num_picos
FROM {{db}}.fact_consumo f JOIN {{db}}.dim_tiempo t ON t.tiempo_key = f.tiempo_key AND t.fecha = f.fecha
GROUP BY t.hora ORDER BY t.hora""",
    "v_picos": """SELECT CAST(f.timestamp_real AS STRING) AS timestamp_real, t.hora, h.id_hogar, h.ciudad, r.region,
  f.kwh_intervalo, f.costo_mxn
FROM {db}.fact_consumo f JOIN {db}.dim_tiempo t ON t.tiempo_key = f.tiempo_key AND t.fecha = f.fecha
JOIN {db}.dim_region r ON r.region_key = f.region_key JOIN {db}.dim_hogar h ON h.hogar_key = f.hogar_key
WHERE f.es_pico ORDER BY f.kwh_intervalo DESC, f.timestamp_real, h.id_hogar""",
    "v_resumen_general": f"""SELECT COUNT(*) AS total_lecturas, {_sum('kwh_intervalo')} AS kwh_total,
  {_mean('kwh_intervalo')} AS kwh_promedio, {_sum('costo_mxn')} AS costo_total,
  COUNT_IF(es_pico) AS total_picos, COUNT(DISTINCT hogar_key) AS hogares_activos
FROM {{db}}.fact_consumo""",
}

#: From the journal: the folds that count, and the partitions that unfinished ones replace.
_JOURNAL = {
    "plegados_validos": r"""SELECT DISTINCT REGEXP_EXTRACT(_metadata.file_name, '^(.*)[.]', 1) AS pliegue
FROM {db}.plegados_diario""",
    "partes_reemplazadas": """SELECT DISTINCT tabla, CAST(dia AS DATE) AS fecha, parte
FROM (SELECT REGEXP_EXTRACT(_metadata.file_name, '^(.*)[.]', 1) AS pliegue, value FROM {db}.plegados_diario
      WHERE _metadata.file_name LIKE '%.json') j
LEFT ANTI JOIN (SELECT REGEXP_EXTRACT(_metadata.file_name, '^(.*)[.]', 1) AS pliegue FROM {db}.plegados_diario
      WHERE _metadata.file_name LIKE '%.hecho') h ON h.pliegue = j.pliegue
LATERAL VIEW EXPLODE(FROM_JSON(j.value, 'map<string,map<string,array<string>>>')) t AS tabla, dias
LATERAL VIEW EXPLODE(dias) d AS dia, partes LATERAL VIEW EXPLODE(partes) p AS parte""",
}
_CURRENT = """SELECT p.* FROM {db}.{table}_partes p
LEFT ANTI JOIN {db}.partes_reemplazadas r ON r.tabla = '{table}' AND r.fecha = p.fecha AND r.parte = p.batch_id
WHERE p.batch_id NOT LIKE '{fold}%' OR p.batch_id IN (SELECT pliegue FROM {db}.plegados_validos)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _create(spark: SparkSession, name: str, schema: T.StructType, place: str, fmt: str = "parquet", partitions: tuple[str, ...] = ()) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parted = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {parted} LOCATION {_quoted(place)}")


def publish_star(spark: SparkSession, path: str, database: str = "meterlake") -> None:
    """Make the star at ``path`` the content of ``database``: tables and views that every session finds.

    May be repeated, also with another star. Partitions are found in the folder, not kept in the catalogue, so a
    batch or a fold has nothing to register; a session that has read a table before says ``refresh_star`` first.
    Files are never removed, neither by publishing nor by dropping the tables.
    """
    db = f"`{database}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION {_quoted(f'{path}/catalogo')}")
    before = spark.conf.get(_LISTED, None)
    spark.conf.set(_LISTED, "false")
    try:
        for table in TABLES:
            if table in DATED:
                _create(spark, f"{db}.{table}_partes", stored_schema(table), f"{path}/{table}", partitions=_PARTITIONS)
            else:
                _create(spark, f"{db}.{table}", TABLES[table], f"{path}/{table}")
        _create(spark, f"{db}.plegados_diario", T.StructType([T.StructField("value", T.StringType())]), f"{path}/plegados", "text")
    finally:
        spark.conf.unset(_LISTED) if before is None else spark.conf.set(_LISTED, before)
    current = {f"{t}_vigente": _CURRENT.format(db=db, table=t, fold=FOLD) for t in DATED}
    for name, text in {**_JOURNAL, **current, **VIEWS}.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {text.format(db=db)}")


def refresh_star(spark: SparkSession, database: str = "meterlake") -> None:
    """Let this session see the files that batches and folds have written since it first read the tables."""
    for table in (*(f"{t}_partes" if t in DATED else t for t in TABLES), "plegados_diario"):
        spark.catalog.refreshTable(f"`{database}`.{table}")
