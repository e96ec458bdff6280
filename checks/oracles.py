"""Independent SQL for the registered queries, over the driver's tables.

One prelude derives readings, clean readings and the star from ``events``; unused parts cost
nothing. Sums are DECIMAL, statistics are the engine's own.
"""

from __future__ import annotations

PRELUDE = """
WITH slots(slot, ciudad, tarifa, factor) AS (VALUES
  (0, 'Ciudad de México', '1', 0.8), (1, 'Ciudad de México', '1', 1.3),
  (2, 'Guadalajara', '1B', 1.1), (3, 'Guadalajara', '1B', 0.7),
  (4, 'Monterrey', '1E', 1.5), (5, 'Monterrey', '1E', 1.8),
  (6, 'Mérida', '1F', 1.4), (7, 'Veracruz', '1C', 1.0)),
book(region_key, tarifa, ciudad, p1) AS (VALUES
  (1, '1', 'Ciudad de México', CAST(0.954 AS DECIMAL(10,3))),
  (2, '1B', 'Guadalajara', CAST(0.906 AS DECIMAL(10,3))),
  (3, '1E', 'Monterrey', CAST(0.785 AS DECIMAL(10,3))),
  (4, '1F', 'Mérida', CAST(0.741 AS DECIMAL(10,3))),
  (5, '1C', 'Veracruz', CAST(0.859 AS DECIMAL(10,3)))),
tiers(tarifa, nivel, desde, hasta, precio) AS (VALUES
  ('1', '1', 0, 75, CAST(0.954 AS DECIMAL(10,3))), ('1', '2', 75, 215, 1.013),
  ('1', '3', 215, 465, 1.313), ('1', '4', 465, 500, 3.397), ('1', 'DAC', 500, NULL, 6.18),
  ('1B', '1', 0, 100, 0.906), ('1B', '2', 100, 300, 1.013), ('1B', '3', 300, 600, 1.313),
  ('1B', 'DAC', 600, NULL, 6.18),
  ('1E', '1', 0, 300, 0.785), ('1E', '2', 300, 800, 0.944), ('1E', '3', 800, 850, 1.313),
  ('1E', 'DAC', 850, NULL, 6.18),
  ('1F', '1', 0, 300, 0.741), ('1F', '2', 300, 800, 0.900), ('1F', '3', 800, 1000, 1.313),
  ('1F', 'DAC', 1000, NULL, 6.18),
  ('1C', '1', 0, 150, 0.859), ('1C', '2', 150, 450, 1.013), ('1C', '3', 450, 700, 1.313),
  ('1C', 'DAC', 700, NULL, 6.18)),
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         (event_type = 'error' AND event_id % 2 = 0) AS bad
  FROM events),
readings AS (
  SELECT event_id, ts AS "timestamp",
         'MED-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS id_medidor,
         'HOG-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS id_hogar,
         s.ciudad, s.tarifa,
         CASE WHEN NOT bad THEN value / 50.0 END AS kwh_intervalo,
         CASE WHEN NOT bad THEN value / 50.0 * 1000.0 END AS potencia_w,
         CASE WHEN NOT bad THEN 95 + k * CAST(0.5 AS DOUBLE) END AS voltaje,
         CASE WHEN k % 33 = 0 THEN 1 ELSE 0 END AS es_pico,
         CASE WHEN event_type = 'error'
              THEN ['timeout_comunicacion', 'señal_debil', 'bateria_baja', 'reinicio_medidor',
                    'corte_temporal'][event_id % 5 + 1]
              ELSE 'ok' END AS estado
  FROM ev JOIN slots s ON ev.user_id % 8 = s.slot),
registry AS (SELECT DISTINCT id_medidor, id_hogar, ciudad, tarifa FROM readings),
clean AS (
  SELECT *, CAST(kwh_intervalo AS DECIMAL(18,6)) AS d FROM readings
  WHERE kwh_intervalo IS NOT NULL AND kwh_intervalo BETWEEN 0 AND 5
    AND voltaje BETWEEN 100 AND 140 AND estado = 'ok'),
moments AS (
  SELECT avg(kwh_intervalo) AS media, coalesce(nullif(stddev_samp(kwh_intervalo), 0), 1) AS sd
  FROM clean),
flagged AS (
  SELECT clean.* EXCLUDE (es_pico),
         (kwh_intervalo > media + 3 * sd OR es_pico = 1) AS es_pico
  FROM clean, moments),
odd AS (
  SELECT * EXCLUDE (id_hogar, id_medidor, tarifa, ciudad),
         CASE WHEN es_pico = 1 THEN '' WHEN voltaje = 130 THEN 'HOG-DESCONOCIDO'
              ELSE id_hogar END AS id_hogar,
         CASE WHEN voltaje = 130 THEN 'MED-DESCONOCIDO' ELSE id_medidor END AS id_medidor,
         CASE WHEN voltaje < 104 THEN NULL WHEN voltaje = 120 THEN '9X'
              WHEN voltaje = 110 THEN '1E' ELSE tarifa END AS tarifa,
         CASE WHEN voltaje = 120 THEN 'Otra' ELSE ciudad END AS ciudad
  FROM readings),
odd_clean AS (
  SELECT odd.*, c.d FROM odd JOIN (SELECT event_id, d FROM clean) c ON c.event_id = odd.event_id),
odd_resolved AS (
  SELECT o.*, coalesce(nullif(o.id_hogar, ''), g.id_hogar, '') AS hogar_resuelto,
         coalesce(nullif(o.tarifa, ''), g.tarifa, '1') AS tarifa_resuelta
  FROM odd_clean o LEFT JOIN registry g ON g.id_medidor = o.id_medidor),
hogar AS (
  SELECT (row_number() OVER (PARTITION BY b ORDER BY id_hogar) - 1) * 4096 + b + 1 AS hogar_key,
         id_hogar, id_medidor, ciudad, tarifa
  FROM (SELECT *, CAST('0x' || substr(md5(id_hogar), 1, 3) AS BIGINT) AS b FROM registry)),
bucketed AS (
  SELECT *, time_bucket(INTERVAL '15 minutes', "timestamp") AS cuarto FROM flagged),
tiempo AS (
  SELECT CAST(strftime(cuarto, '%Y%m%d%H%M') AS BIGINT) AS tiempo_key,
         strftime(cuarto, '%Y-%m-%dT%H:%M:%S') AS "timestamp", CAST(cuarto AS DATE) AS fecha,
         year(cuarto) AS "year", month(cuarto) AS "month", day(cuarto) AS "day",
         hour(cuarto) AS hora, dayname(cuarto) AS dia_semana, isodow(cuarto) >= 6 AS es_finde,
         quarter(cuarto) AS trimestre,
         ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre',
          'Octubre', 'Noviembre', 'Diciembre'][month(cuarto)] AS mes_nombre
  FROM (SELECT DISTINCT cuarto FROM bucketed)),
fact AS (
  SELECT CAST(strftime(b.cuarto, '%Y%m%d%H%M') AS BIGINT) AS tiempo_key, h.hogar_key,
         r.region_key, b."timestamp" AS timestamp_real, b.kwh_intervalo, b.voltaje, b.potencia_w,
         b.d, round(b.d * r.p1, 6) AS c, b.es_pico, CAST(b.cuarto AS DATE) AS fecha,
         hour(b.cuarto) AS hora, dayname(b.cuarto) AS dia_semana,
         h.id_hogar, h.id_medidor, h.ciudad, r.tarifa AS region
  FROM bucketed b JOIN hogar h ON h.id_hogar = b.id_hogar JOIN book r ON r.tarifa = b.tarifa),
month_totals AS (
  SELECT event_id, tarifa, CAST(kwh_intervalo * 10 AS DECIMAL(18,6)) AS x,
         coalesce(sum(CAST(kwh_intervalo * 10 AS DECIMAL(18,6))) OVER (
           PARTITION BY id_hogar, year("timestamp"), month("timestamp")
           ORDER BY "timestamp", event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS antes
  FROM clean),
placed AS (
  SELECT m.event_id, m.antes, t.nivel, t.precio, round(m.x * t.precio, 6) AS costo
  FROM month_totals m JOIN tiers t
    ON t.tarifa = m.tarifa AND m.antes >= t.desde AND (t.hasta IS NULL OR m.antes < t.hasta)),
bands AS (
  SELECT event_id, escala, kwh_intervalo * escala AS v,
         CAST(coalesce(kwh_intervalo * escala, 0) AS DECIMAL(28,10)) AS n
  FROM readings, (VALUES (CAST(0.0001 AS DOUBLE)), (0.01), (1.0), (1000.0)) e(escala))
"""

_HOUR = "fecha = DATE '2024-01-05' AND hora = 9"
_DAY = "fecha = DATE '2024-01-05'"
_WEEK = "year(fecha) = 2024 AND week(fecha) = 2"
_MONTH = "year(fecha) = 2024 AND month(fecha) = 1"

_MEASURES = (
    "CAST(sum(d) AS DOUBLE) AS kwh_total, CAST(sum(c) AS DOUBLE) AS costo_total, "
    "CAST(count(*) FILTER (WHERE es_pico) AS BIGINT) AS num_picos"
)
_AVG = "CAST(sum(d) AS DOUBLE) / count(*)"


def _round(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def _text(value: str, digits: int, grouped: bool) -> str:
    pattern = f"{{:,.{digits}f}}" if grouped else f"{{:.{digits}f}}"
    return f"format('{pattern}', CAST(round({value}, {digits}) AS DOUBLE))"


def _kwh_text(n: str) -> str:
    return (
        f"CASE WHEN {n} >= 1000 THEN {_text(n, 1, True)} WHEN {n} >= 1 THEN {_text(n, 3, False)} "
        f"WHEN {n} >= 0.001 THEN {_text(n, 4, False)} ELSE {_text(n, 6, False)} END"
    )


def _mxn_text(n: str) -> str:
    return (
        f"'$' || CASE WHEN {n} >= 100 THEN {_text(n, 2, True)} "
        f"WHEN {n} >= 1 THEN {_text(n, 3, False)} "
        f"WHEN {n} >= 0.001 THEN {_text(n, 4, False)} ELSE {_text(n, 6, False)} END"
    )


def _period(where: str) -> str:
    return (
        "SELECT tiempo_key, hogar_key, CAST(timestamp_real AS VARCHAR) AS timestamp_real, "
        f"kwh_intervalo FROM fact WHERE {where}"
    )


_REPORT_MEASURES = (
    "CAST(sum(d) AS DOUBLE) AS kwh, " + _round("sum(c)", 4) + " AS costo, "
    "CAST(count(*) FILTER (WHERE es_pico) AS BIGINT) AS picos"
)


def _preview(where: str, label: str) -> str:
    return f"""SELECT '{label}' AS label, lecturas, kwh, {_kwh_text('CAST(kwh AS DECIMAL(28,10))')}
      AS kwh_fmt, costo, {_mxn_text('CAST(costo AS DECIMAL(28,10))')} AS costo_fmt, picos, hogares
      FROM (SELECT count(*) AS lecturas, {_REPORT_MEASURES}, count(DISTINCT hogar_key) AS hogares
            FROM fact WHERE {where}) WHERE lecturas > 0"""


def _homes(where: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY kwh DESC, hogar_key) AS posicion,
      id_hogar, ciudad, region, kwh, costo, picos
      FROM (SELECT hogar_key, id_hogar, ciudad, region, {_REPORT_MEASURES} FROM fact
            WHERE {where} GROUP BY ALL ORDER BY kwh DESC, hogar_key LIMIT 8)"""


def _peaks(where: str) -> str:
    return f"""SELECT substr(CAST(timestamp_real AS VARCHAR), 1, 19) AS timestamp_real, id_hogar,
      ciudad, {_round('d', 6)} AS kwh, {_round('c', 4)} AS costo FROM fact
      WHERE es_pico AND {where} ORDER BY d DESC, fact.timestamp_real, hogar_key LIMIT 10"""


_PROFILE = f"""SELECT hora, {_round(_AVG, 6)} AS kwh_prom, {_round('max(d)', 6)} AS kwh_max
  FROM fact WHERE {_DAY} GROUP BY hora"""

_BY_REGION = f"""SELECT region, CAST(fecha AS VARCHAR) AS fecha, {_MEASURES},
  {_AVG} AS kwh_promedio, count(*) AS num_lecturas FROM fact GROUP BY region, fecha"""
_BY_HOUR = f"""SELECT hora, {_AVG} AS kwh_promedio, max(kwh_intervalo) AS kwh_max,
  CAST(count(*) FILTER (WHERE es_pico) AS BIGINT) AS num_picos FROM fact GROUP BY hora"""
_GENERAL = f"""SELECT count(*) AS total_lecturas, CAST(sum(d) AS DOUBLE) AS kwh_total,
  {_AVG} AS kwh_promedio, CAST(sum(c) AS DOUBLE) AS costo_total,
  CAST(count(*) FILTER (WHERE es_pico) AS BIGINT) AS total_picos,
  count(DISTINCT hogar_key) AS hogares_activos FROM fact"""
_DAILY = f"""SELECT hogar_key, region_key, {_MEASURES}, max(kwh_intervalo) AS kwh_max,
  {_AVG} AS kwh_promedio, count(*) AS num_lecturas, CAST(fecha AS VARCHAR) AS fecha
  FROM fact GROUP BY fecha, hogar_key, region_key"""
_SERIES = f"""SELECT CAST(fecha AS VARCHAR) AS fecha, region, {_round('sum(d)', 3)} AS kwh
  FROM fact GROUP BY fecha, region"""
_MOMENTS = f"""count(*) AS lecturas, {_round('avg(kwh_intervalo)', 8)} AS media,
  {_round('stddev_samp(kwh_intervalo)', 8)} AS desviacion"""
_DAYS = """(VALUES (0, 'Monday', 'Lun'), (1, 'Tuesday', 'Mar'), (2, 'Wednesday', 'Mié'),
  (3, 'Thursday', 'Jue'), (4, 'Friday', 'Vie'), (5, 'Saturday', 'Sáb'), (6, 'Sunday', 'Dom'))
  dias(dia, dia_semana, dia_corto)"""
_HOURS = "(SELECT CAST(range AS INTEGER) AS hora FROM range(24)) horas"
_MONTH_NAMES = """['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
  'Septiembre', 'Octubre', 'Noviembre', 'Diciembre']"""
_PERIODS = {
    "hora": (
        "SELECT DISTINCT fecha, hora, CAST(fecha AS VARCHAR) || ' ' || hora AS value, "
        "lpad(CAST(hora AS VARCHAR), 2, '0') || ':00 h — ' || CAST(fecha AS VARCHAR) AS label, "
        "CAST(fecha AS VARCHAR) || '  ' || lpad(CAST(hora AS VARCHAR), 2, '0') || ':00 – ' || "
        "lpad(CAST(hora AS VARCHAR), 2, '0') || ':59 h' AS title "
        "FROM tiempo ORDER BY fecha DESC, hora DESC LIMIT 72"
    ),
    "dia": (
        "SELECT DISTINCT CAST(fecha AS VARCHAR) AS value, CAST(fecha AS VARCHAR) AS label, "
        f"day(fecha) || ' de ' || {_MONTH_NAMES}[month(fecha)] || ' de ' || year(fecha) AS title "
        "FROM tiempo ORDER BY value DESC LIMIT 90"
    ),
    "semana": (
        "SELECT DISTINCT year(fecha) || '-W' || lpad(CAST(week(fecha) AS VARCHAR), 2, '0') "
        "AS value, value AS label, 'Semana ' || lpad(CAST(week(fecha) AS VARCHAR), 2, '0') || "
        "' · ' || strftime(date_trunc('week', fecha), '%d/%m') || ' – ' || "
        "strftime(date_trunc('week', fecha) + INTERVAL 6 DAY, '%d/%m/%Y') AS title FROM tiempo"
    ),
    "mes": (
        "SELECT DISTINCT year(fecha) || '-' || lpad(CAST(month(fecha) AS VARCHAR), 2, '0') "
        f"AS value, value AS label, {_MONTH_NAMES}[month(fecha)] || ' ' || year(fecha) AS title "
        "FROM tiempo"
    ),
}

BODIES: dict[str, str] = {
    "decode_readings": """SELECT TRUE AS valida, CAST("timestamp" AS VARCHAR) AS "timestamp", id_medidor,
        tarifa, ciudad, coalesce(kwh_intervalo, 0) AS kwh_intervalo,
        coalesce(voltaje, 0) AS voltaje, CAST(es_pico AS BIGINT) AS es_pico, estado FROM readings""",
    "write_raw": """SELECT estado, count(*) AS filas, count(kwh_intervalo) AS con_medida
        FROM readings GROUP BY estado""",
    "write_processed": """SELECT strftime(timestamp_real, '%Y') AS "year",
        strftime(timestamp_real, '%m') AS "month", count(*) AS filas,
        CAST(sum(c) AS DOUBLE) AS costo FROM fact GROUP BY 1, 2""",
    "reprocess_raw": """SELECT region AS tarifa, count(*) AS filas, CAST(sum(d) AS DOUBLE) AS kwh,
        count(*) FILTER (WHERE es_pico) AS picos FROM fact GROUP BY region""",
    "load_fact": """SELECT tiempo_key, hogar_key, CAST(region_key AS BIGINT) AS region_key,
        CAST(timestamp_real AS VARCHAR) AS timestamp_real, kwh_intervalo, voltaje, potencia_w,
        CAST(c AS DOUBLE) AS costo_mxn, es_pico, CAST(fecha AS VARCHAR) AS fecha FROM fact""",
    "reprocess_messages": """SELECT 'v' || CAST(event_id % 7 AS VARCHAR) AS firmware, tarifa, count(*) AS filas,
        CAST(sum(d) AS DOUBLE) AS kwh FROM clean WHERE event_id % 7 <> 3 GROUP BY ALL""",
    "refresh_daily": _DAILY,
    "fold_daily": _DAILY,
    "fold_fact": """SELECT tiempo_key, hogar_key, CAST(region_key AS BIGINT) AS region_key,
        CAST(timestamp_real AS VARCHAR) AS timestamp_real, kwh_intervalo, voltaje, potencia_w,
        CAST(c AS DOUBLE) AS costo_mxn, es_pico, CAST(fecha AS VARCHAR) AS fecha FROM fact""",
    "merge_new_keys": """SELECT DISTINCT
        CAST(strftime(time_bucket(INTERVAL '15 minutes', "timestamp"), '%Y%m%d%H%M') AS BIGINT)
          AS tiempo_key,
        strftime(time_bucket(INTERVAL '15 minutes', "timestamp"), '%Y-%m-%dT%H:%M:%S')
          AS "timestamp"
        FROM readings WHERE time_bucket(INTERVAL '15 minutes', "timestamp")
          NOT IN (SELECT cuarto FROM bucketed)""",
    "seed_dims": """SELECT h.hogar_key, h.id_hogar, h.id_medidor, h.ciudad,
        CAST(b.region_key AS BIGINT) AS region_key, b.tarifa AS region,
        CAST(b.p1 AS DOUBLE) AS tarifa_kwh FROM hogar h JOIN book b ON b.tarifa = h.tarifa""",
    "query": f"""SELECT v.region, v.fecha >= '2024-01-10' AS reciente, count(*) AS dias,
        max(v.num_lecturas) AS max_lecturas, CAST(max(b.p1) AS DOUBLE) AS tarifa_kwh
        FROM ({_BY_REGION}) v JOIN book b ON b.tarifa = v.region GROUP BY ALL""",
    "register_views": f"""SELECT 'fact_consumo' AS tabla, count(*) AS filas FROM fact
        UNION ALL SELECT 'dim_tiempo', count(*) FROM tiempo
        UNION ALL SELECT 'dim_region', count(*) FROM book
        UNION ALL SELECT 'dim_hogar', count(*) FROM hogar
        UNION ALL SELECT 'fact_resumen_diario', count(*) FROM ({_DAILY})
        UNION ALL SELECT 'v_consumo_por_region', count(*) FROM ({_BY_REGION})
        UNION ALL SELECT 'v_consumo_por_hogar', count(DISTINCT hogar_key) FROM fact
        UNION ALL SELECT 'v_perfil_horario', count(DISTINCT hora) FROM fact
        UNION ALL SELECT 'v_picos', count(*) FROM fact WHERE es_pico
        UNION ALL SELECT 'v_resumen_general', 1""",
    "create_star": """SELECT h.tarifa AS region, b.tarifa AS tarifa_ciudad, count(*) AS hogares,
        count(DISTINCT h.id_medidor) AS medidores
        FROM hogar h JOIN book b ON b.ciudad = h.ciudad GROUP BY h.tarifa, b.tarifa""",
    "transform": """SELECT f.event_id, CAST(f."timestamp" AS VARCHAR) AS "timestamp",
        hour(f."timestamp") AS hora, dayname(f."timestamp") AS dia_semana,
        isodow(f."timestamp") >= 6 AS es_finde, f.es_pico,
        CAST(round(f.d * b.p1, 6) AS DOUBLE) AS costo_mxn
        FROM flagged f JOIN book b ON b.tarifa = f.tarifa""",
    "to_records": f"""SELECT '{{"region":"' || region || '","fecha":"' || fecha ||
        '","num_lecturas":' || num_lecturas || ',"num_picos":' || num_picos || '}}' AS registro
        FROM ({_BY_REGION})""",
    "drop_null_readings": """SELECT event_id, kwh_intervalo FROM readings
        WHERE kwh_intervalo IS NOT NULL AND "timestamp" IS NOT NULL""",
    "filter_kwh_range": """SELECT event_id, kwh_intervalo FROM readings
        WHERE kwh_intervalo >= 0 AND kwh_intervalo <= 5""",
    "filter_voltage_range": """SELECT event_id, voltaje FROM readings
        WHERE voltaje >= 100 AND voltaje <= 140""",
    "filter_status_ok": "SELECT event_id, estado FROM readings WHERE estado = 'ok'",
    "clean_readings": """SELECT event_id, CAST("timestamp" AS VARCHAR) AS "timestamp", id_medidor,
        id_hogar, ciudad, tarifa, kwh_intervalo, potencia_w, voltaje,
        CAST(es_pico AS BIGINT) AS es_pico FROM clean""",
    "period_hour": _period(_HOUR),
    "period_day": _period(_DAY),
    "period_week": _period(_WEEK),
    "period_month": _period(_MONTH),
    "period_filter": _period("TRUE"),
    "only_peaks": """SELECT hogar_key, CAST(timestamp_real AS VARCHAR) AS timestamp_real,
        kwh_intervalo FROM fact WHERE es_pico""",
    "touched_dates": """SELECT CAST(fecha AS VARCHAR) AS fecha, count(*) AS filas FROM fact
        WHERE fecha IN (SELECT fecha FROM fact WHERE kwh_intervalo > 4.9) GROUP BY fecha""",
    "parse_timestamp": """SELECT event_id, CAST("timestamp" AS VARCHAR) AS "timestamp"
        FROM readings WHERE estado = 'ok'""",
    "time_features": """SELECT event_id, hour("timestamp") AS hora,
        dayname("timestamp") AS dia_semana, isodow("timestamp") >= 6 AS es_finde FROM readings""",
    "bucket_15min": """SELECT event_id,
        CAST(time_bucket(INTERVAL '15 minutes', "timestamp") AS VARCHAR) AS cuarto,
        CAST(strftime(time_bucket(INTERVAL '15 minutes', "timestamp"), '%Y%m%d%H%M') AS BIGINT)
          AS tiempo_key FROM readings""",
    "dim_tiempo": """SELECT tiempo_key, "timestamp", CAST(fecha AS VARCHAR) AS fecha, "year",
        "month", "day", hora, dia_semana, es_finde, trimestre, mes_nombre FROM tiempo""",
    "mes_nombre": f"""SELECT DISTINCT CAST(CAST(dia AS DATE) AS VARCHAR) AS fecha,
        {_MONTH_NAMES}[month(dia)] AS mes_nombre, quarter(dia) AS trimestre
        FROM (SELECT fecha + to_months(CAST(hora AS INTEGER)) AS dia FROM tiempo)""",
    "flag_peaks": "SELECT event_id, kwh_intervalo, es_pico FROM flagged",
    "flag_peaks_by_tariff": """SELECT event_id, tarifa,
        (kwh_intervalo > avg(kwh_intervalo) OVER (PARTITION BY tarifa) + 3 * coalesce(
           nullif(stddev_samp(kwh_intervalo) OVER (PARTITION BY tarifa), 0), 1)
         OR es_pico = 1) AS es_pico FROM clean""",
    "flag_peaks_by_home": """SELECT event_id,
        (kwh_intervalo > avg(kwh_intervalo) OVER (PARTITION BY id_hogar) + 3 * coalesce(
           nullif(stddev_samp(kwh_intervalo) OVER (PARTITION BY id_hogar), 0), 1)
         OR es_pico = 1) AS es_pico FROM clean""",
    "cost_etl": """SELECT o.event_id, CAST(round(o.d * coalesce(b.p1, 0.954), 6) AS DOUBLE)
        AS costo_mxn FROM odd_clean o LEFT JOIN book b ON b.tarifa = o.tarifa""",
    "cost_dwh": """SELECT o.event_id,
        CAST(round(o.d * coalesce(c.p1, t.p1, 0.954), 6) AS DOUBLE) AS costo_dwh
        FROM odd_resolved o LEFT JOIN registry g ON g.id_hogar = o.hogar_resuelto
        LEFT JOIN book c ON c.ciudad = g.ciudad LEFT JOIN book t ON t.tarifa = o.tarifa_resuelta""",
    "price_flat": """SELECT b.tarifa, count(*) AS filas,
        CAST(sum(round(d * p1, 6)) AS DOUBLE) AS costo
        FROM clean JOIN book b ON b.tarifa = clean.tarifa GROUP BY b.tarifa""",
    "month_to_date": "SELECT event_id, CAST(antes AS DOUBLE) AS kwh_acumulado_mes FROM month_totals",
    "price_tiered": "SELECT event_id, nivel, CAST(costo AS DOUBLE) AS costo_mxn FROM placed",
    "month_ledger": "SELECT event_id, nivel, CAST(costo AS DOUBLE) AS costo_mxn FROM placed",
    "month_bills": """SELECT id_hogar, CAST(strftime(c."timestamp", '%Y%m') AS BIGINT) AS mes,
        CAST(sum(CAST(kwh_intervalo * 10 AS DECIMAL(18,6))) AS DOUBLE) AS kwh, CAST(sum(costo) AS DOUBLE) AS costo,
        count(*) AS lecturas, bool_or(c.event_id % 2 = 0 AND p.nivel <> q.nivel) AS corregida
        FROM clean c JOIN placed p ON p.event_id = c.event_id LEFT JOIN (
          SELECT m.event_id, t.nivel FROM (
            SELECT event_id, tarifa, coalesce(sum(CAST(kwh_intervalo * 10 AS DECIMAL(18,6))) OVER (
              PARTITION BY id_hogar, year("timestamp"), month("timestamp") ORDER BY "timestamp", event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS antes
            FROM clean WHERE event_id % 2 = 0) m JOIN tiers t
          ON t.tarifa = m.tarifa AND m.antes >= t.desde AND (t.hasta IS NULL OR m.antes < t.hasta)) q ON q.event_id = c.event_id
        GROUP BY ALL""",
    "price_tiered_totals": """SELECT nivel, count(*) AS filas, CAST(sum(costo) AS DOUBLE) AS costo
        FROM placed GROUP BY nivel""",
    "tier_bounds": """SELECT t.tarifa, t.nivel, CAST(t.desde AS DOUBLE) AS desde,
        CAST(coalesce(t.hasta, -1) AS DOUBLE) AS hasta, CAST(t.precio AS DOUBLE) AS precio,
        count(m.total) AS hogares_mes
        FROM tiers t LEFT JOIN (
          SELECT tarifa, id_hogar, sum(CAST(kwh_intervalo * 10 AS DECIMAL(18,6))) AS total
          FROM clean GROUP BY tarifa, id_hogar, year("timestamp"), month("timestamp")) m
        ON m.tarifa = t.tarifa AND m.total >= t.desde AND (t.hasta IS NULL OR m.total < t.hasta)
        GROUP BY t.tarifa, t.nivel, t.desde, t.hasta, t.precio""",
    "tier_range_join": "SELECT event_id, nivel, CAST(precio AS DOUBLE) AS precio FROM placed",
    "resolve_home_tariff": "SELECT event_id, hogar_resuelto, tarifa_resuelta FROM odd_resolved",
    "zero_if_null": """SELECT CAST(CAST(c.dia AS DATE) AS VARCHAR) AS dia,
        CAST(coalesce(sum(d), 0) AS DOUBLE) AS kwh
        FROM (SELECT unnest(range(min(fecha) - INTERVAL 1 DAY, max(fecha) + INTERVAL 2 DAY,
              INTERVAL 1 DAY)) AS dia FROM fact) c
        LEFT JOIN fact ON fact.fecha = c.dia GROUP BY c.dia""",
    "join_region": """SELECT CAST(timestamp_real AS VARCHAR) AS timestamp_real, hogar_key, region,
        CAST(b.p1 AS DOUBLE) AS tarifa_kwh FROM fact JOIN book b ON b.region_key = fact.region_key""",
    "join_time": """SELECT CAST(timestamp_real AS VARCHAR) AS timestamp_real, hogar_key,
        CAST(t.fecha AS VARCHAR) AS fecha, t.hora, t.dia_semana, t.mes_nombre
        FROM fact JOIN tiempo t ON t.tiempo_key = fact.tiempo_key""",
    "join_home": """SELECT CAST(timestamp_real AS VARCHAR) AS timestamp_real, h.id_hogar,
        h.id_medidor, h.ciudad FROM fact JOIN hogar h ON h.hogar_key = fact.hogar_key""",
    "resolve_keys": """SELECT o.event_id,
        CAST(strftime(time_bucket(INTERVAL '15 minutes', o."timestamp"), '%Y%m%d%H%M') AS BIGINT)
          AS tiempo_key, coalesce(h.hogar_key, -1) AS hogar_key,
        CAST(coalesce(b.region_key, -1) AS BIGINT) AS region_key
        FROM odd_resolved o LEFT JOIN hogar h ON h.id_hogar = o.hogar_resuelto
        LEFT JOIN book b ON b.tarifa = o.tarifa_resuelta""",
    "lookup_meter": """SELECT o.event_id, coalesce(g.id_hogar, '-') AS hogar_registro,
        coalesce(g.tarifa, '-') AS tarifa_registro
        FROM odd o LEFT JOIN registry g ON g.id_medidor = o.id_medidor""",
    "tariff_of_city": """SELECT o.event_id, o.ciudad, coalesce(b.tarifa, '1') AS tarifa_ciudad
        FROM odd o LEFT JOIN book b ON b.ciudad = o.ciudad""",
    "lookup_tariff": """SELECT o.event_id, coalesce(b.tarifa, '1') AS tarifa_aplicada,
        CAST(coalesce(b.p1, 0.954) AS DOUBLE) AS precio_base
        FROM odd o LEFT JOIN book b ON b.tarifa = o.tarifa""",
    "dense_hours": f"""SELECT horas.hora, count(f.hogar_key) AS lecturas FROM {_HOURS}
        LEFT JOIN (SELECT * FROM fact WHERE es_pico) f ON f.hora = horas.hora GROUP BY horas.hora""",
    "dense_heatmap": f"""SELECT dias.dia, dias.dia_semana, dias.dia_corto, horas.hora,
        coalesce(p.kwh, 0) AS kwh FROM {_DAYS} CROSS JOIN {_HOURS}
        LEFT JOIN (SELECT dia_semana, hora, {_AVG} AS kwh FROM fact WHERE es_pico
                   GROUP BY dia_semana, hora) p
        ON p.dia_semana = dias.dia_semana AND p.hora = horas.hora""",
    "fk_violations": """SELECT 'dim_tiempo' AS tabla, count(*) AS filas FROM fact
          WHERE tiempo_key NOT IN (SELECT tiempo_key FROM tiempo)
        UNION ALL SELECT 'dim_hogar', count(*) FROM fact
          WHERE hogar_key NOT IN (SELECT hogar_key FROM hogar)
        UNION ALL SELECT 'dim_region', count(*) FROM fact
          WHERE region_key NOT IN (SELECT region_key FROM book)""",
    "pk_duplicates": """SELECT hogar_key, tiempo_key, count(*) AS veces FROM fact
        GROUP BY hogar_key, tiempo_key HAVING count(*) > 1""",
    "pk_duplicates_dimensions": """SELECT 'dim_tiempo' AS tabla,
          count(*) - count(DISTINCT tiempo_key) AS claves FROM tiempo
        UNION ALL SELECT 'dim_hogar', count(*) - count(DISTINCT hogar_key) FROM hogar
        UNION ALL SELECT 'dim_hogar.id_hogar', count(*) - count(DISTINCT id_hogar) FROM hogar
        UNION ALL SELECT 'dim_region', count(*) - count(DISTINCT tarifa) FROM book""",
    "v_consumo_por_region": _BY_REGION,
    "v_consumo_por_hogar": f"""SELECT id_hogar, ciudad, region, {_MEASURES} FROM fact
        GROUP BY id_hogar, ciudad, region""",
    "v_perfil_horario": _BY_HOUR,
    "v_picos": """SELECT CAST(timestamp_real AS VARCHAR) AS timestamp_real, hora, id_hogar, ciudad,
        region, kwh_intervalo, CAST(c AS DOUBLE) AS costo_mxn FROM fact WHERE es_pico""",
    "v_resumen_general": _GENERAL,
    "resumen": f"""SELECT total_lecturas, kwh_total,
        {_kwh_text('CAST(kwh_total AS DECIMAL(28,10))')} AS kwh_total_fmt, costo_total,
        {_mxn_text('CAST(costo_total AS DECIMAL(28,10))')} AS costo_total_fmt, total_picos,
        hogares_activos FROM ({_GENERAL})""",
    "consumo_region": """SELECT region, CAST(sum(d) AS DOUBLE) AS kwh,
        CAST(sum(c) AS DOUBLE) AS costo FROM fact GROUP BY region""",
    "ranking_hogares": """SELECT id_hogar, ciudad, CAST(sum(d) AS DOUBLE) AS kwh FROM fact
        GROUP BY id_hogar, ciudad, region""",
    "serie_diaria": _SERIES,
    "perfil_horario": f"""SELECT hora, {_round(_AVG, 5)} AS prom, {_round('max(d)', 4)} AS maximo
        FROM fact GROUP BY hora""",
    "heatmap": f"SELECT dia_semana, hora, {_AVG} AS kwh FROM fact GROUP BY dia_semana, hora",
    "picos": """SELECT CAST(timestamp_real AS VARCHAR) AS "timestamp", region, kwh_intervalo
        FROM fact WHERE es_pico
        ORDER BY timestamp_real DESC, hogar_key, kwh_intervalo DESC LIMIT 500""",
    "picos_por_hora": f"""SELECT horas.hora, count(f.hogar_key) AS num_picos FROM {_HOURS}
        LEFT JOIN (SELECT * FROM fact WHERE es_pico) f ON f.hora = horas.hora
        GROUP BY horas.hora""",
    "top_picos": f"""SELECT substr(CAST(timestamp_real AS VARCHAR), 1, 19) AS "timestamp", ciudad,
        region, {_round('d', 4)} AS kwh, {_round('c', 4)} AS costo FROM fact WHERE es_pico
        ORDER BY d DESC, timestamp_real, hogar_key LIMIT 10""",
    "warehouse_totals": f"SELECT count(*) AS total, {_round('sum(d)', 4)} AS kwh FROM fact",
    "resumen_diario": _DAILY,
    "preview_resumen": _preview(_WEEK, "Semana 02 · 08/01 – 14/01/2024"),
    "preview_resumen_hour": _preview(_HOUR, "2024-01-05  09:00 – 09:59 h"),
    "report_region": f"""SELECT region, {_REPORT_MEASURES}, count(*) AS lecturas FROM fact
        WHERE {_MONTH} GROUP BY region""",
    "hourly_report_region": f"""SELECT region, {_REPORT_MEASURES}, count(*) AS lecturas FROM fact
        WHERE {_HOUR} GROUP BY region""",
    "report_homes": f"SELECT * EXCLUDE (posicion) FROM ({_homes(_WEEK)})",
    "ranked_homes": _homes(_MONTH),
    "report_peaks": _peaks(_WEEK),
    "report_profile": _PROFILE,
    "period_report": f"""SELECT 'resumen' AS parte, count(*) AS filas
          FROM ({_preview(_DAY, '')})
        UNION ALL SELECT 'por_region', count(DISTINCT region) FROM fact WHERE {_DAY}
        UNION ALL SELECT 'por_hogar', count(*) FROM ({_homes(_DAY)})
        UNION ALL SELECT 'picos', count(*) FROM ({_peaks(_DAY)})
        UNION ALL SELECT 'perfil', count(*) FROM ({_PROFILE})""",
    "period_report_values": f"""SELECT 'resumen' AS parte, label AS linea, kwh
          FROM ({_preview(_DAY, '5 de Enero de 2024')})
        UNION ALL SELECT 'por_region', region, CAST(sum(d) AS DOUBLE) FROM fact WHERE {_DAY} GROUP BY region
        UNION ALL SELECT 'por_hogar', id_hogar, kwh FROM ({_homes(_DAY)})
        UNION ALL SELECT 'picos', timestamp_real, kwh FROM ({_peaks(_DAY)})
        UNION ALL SELECT 'perfil', CAST(hora AS VARCHAR), kwh_prom FROM ({_PROFILE})""",
    "hogares_por_periodo": " UNION ALL ".join(
        f"""SELECT '{tipo}' AS tipo, CAST(CAST(date_trunc('{unit}', CAST(fecha AS DATE)) AS DATE) AS VARCHAR) AS desde,
        count(DISTINCT hogar_key) AS hogares FROM fact GROUP BY ALL"""
        for tipo, unit in (("dia", "day"), ("semana", "week"), ("mes", "month"))
    ),
    "preview_resumen_empty": f"""SELECT 'Mayo 2031' AS label, count(*) AS lecturas, CAST(0 AS DOUBLE) AS kwh,
        {_kwh_text('CAST(0 AS DECIMAL(28,10))')} AS kwh_fmt, CAST(0 AS DOUBLE) AS costo,
        {_mxn_text('CAST(0 AS DECIMAL(28,10))')} AS costo_fmt, count(*) FILTER (WHERE es_pico) AS picos,
        count(DISTINCT hogar_key) AS hogares FROM fact WHERE fecha >= DATE '2031-05-01'""",
    "fk_violations_found": """SELECT 'dim_tiempo' AS tabla, count(*) AS filas FROM fact WHERE hora = 3
        UNION ALL SELECT 'dim_hogar', count(*) FROM fact WHERE hogar_key % 7 = 0
        UNION ALL SELECT 'dim_region', count(*) FROM fact WHERE region_key = 5""",
    "pk_duplicates_found": """SELECT hogar_key, CASE WHEN hogar_key % 15 = 0 THEN 3 ELSE 2 END::BIGINT AS veces
        FROM hogar WHERE hogar_key % 5 = 0""",
    "cost_other_book": """SELECT event_id, CAST(round(d * CASE WHEN ciudad IN ('Guadalajara', 'Monterrey')
        THEN CAST(2.125 AS DECIMAL(10,3)) ELSE 3.25 END, 6) AS DOUBLE) AS costo_dwh FROM clean""",
    "batch_stats": """SELECT (SELECT count(*) FROM readings) AS filas_raw,
        count(*) AS filas_limpias, (SELECT count(*) FROM readings) - count(*) AS filas_eliminadas,
        count(*) FILTER (WHERE es_pico) AS picos_detectados FROM flagged""",
    "batch_moments": f"SELECT {_MOMENTS} FROM clean",
    "batch_moments_by_tariff": f"SELECT tarifa, {_MOMENTS} FROM clean GROUP BY tarifa",
    "unique_buckets": """SELECT CAST(fecha AS VARCHAR) AS fecha, count(*) AS cuartos FROM tiempo
        GROUP BY fecha""",
    "series_by_region": f"SELECT region, fecha AS x, kwh AS y FROM ({_SERIES})",
    "heatmap_matrix": f"""SELECT dias.dia, dias.dia_corto, {', '.join(
        f'coalesce(max(kwh) FILTER (WHERE hora = {h}), 0) AS h{h:02d}' for h in range(24))}
        FROM {_DAYS} LEFT JOIN (SELECT dia_semana, hora, {_AVG} AS kwh FROM fact
          GROUP BY dia_semana, hora) f ON f.dia_semana = dias.dia_semana
        GROUP BY dias.dia, dias.dia_corto""",
    "fmt_kwh": f"SELECT event_id, escala, {_kwh_text('n')} AS texto FROM bands",
    "fmt_mxn": f"SELECT event_id, escala, {_mxn_text('n')} AS texto FROM bands",
    "fmt_dashboard": rf"""SELECT event_id, escala,
        CASE WHEN n >= 1000 THEN regexp_replace({_text('n', 3, True)}, '(\.\d+?)0+$', '\1')
             WHEN n >= 1 THEN {_text('n', 3, False)} ELSE {_text('n', 4, False)} END AS kwh,
        '$' || CASE WHEN n >= 100 THEN regexp_replace({_text('n', 3, True)}, '(\.\d\d)0$', '\1')
             ELSE {_text('n', 3, False)} END AS mxn FROM bands""",
    "period_label": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, value, title AS label FROM ({sql.split(' LIMIT ')[0]})"
        for kind, sql in _PERIODS.items()
    ),
    "day_index": "SELECT DISTINCT dia_semana, isodow(fecha) - 1 AS dia FROM tiempo",
    "energy_columns": """SELECT event_id,
        floor(potencia_w * CAST(30 AS DOUBLE) / CAST(36 AS DOUBLE) + 0.5) / 1e6 AS kwh,
        floor(potencia_w / voltaje * 1000 + 0.5) / 1000 AS corriente
        FROM readings WHERE kwh_intervalo IS NOT NULL""",
    "expected_load": f"""SELECT hora, CAST(CASE WHEN hora < 6 THEN 80 WHEN hora < 9 THEN 600
          WHEN hora < 13 THEN 300 WHEN hora < 15 THEN 700 WHEN hora < 18 THEN 250
          WHEN hora < 22 THEN 900 ELSE 200 END AS DOUBLE) AS media_w,
        CAST(CASE WHEN hora < 6 THEN 30 WHEN hora < 9 THEN 200 WHEN hora < 13 THEN 100
          WHEN hora < 15 THEN 250 WHEN hora < 18 THEN 80 WHEN hora < 22 THEN 350 ELSE 60 END
          AS DOUBLE) AS desv_w,
        {_round('CAST(sum(CAST(potencia_w AS DECIMAL(18,6))) AS DOUBLE) / count(*)', 3)}
          AS observada_w FROM fact GROUP BY hora""",
    "process_batch": _BY_REGION,
    "running_totals": f"SELECT count(*) AS total, {_round('sum(d)', 4)} AS kwh FROM fact",
}
for _kind, _name in (("hora", "hour"), ("dia", "day"), ("semana", "week"), ("mes", "month")):
    BODIES[f"period_list_{_name}"] = f"SELECT value, label FROM ({_PERIODS[_kind]})"


# The rollup must give what all facts give.
for _rolled, _name in (
    ("daily_consumo_por_region", "v_consumo_por_region"),
    ("daily_consumo_por_hogar", "v_consumo_por_hogar"),
    ("daily_resumen_general", "v_resumen_general"),
    ("daily_resumen", "resumen"),
    ("fold_general", "v_resumen_general"),
    *((f"catalog_{name}", name) for name in (
        "v_consumo_por_region", "v_consumo_por_hogar", "v_perfil_horario", "v_picos", "v_resumen_general", "resumen_diario",
    )),
    *((f"bucketed_{name}", name) for name in ("resolve_keys", "lookup_meter", "join_home")),
    ("daily_preview_resumen", "preview_resumen"),
    ("daily_report_region", "report_region"),
    ("daily_report_homes", "report_homes"),
    ("daily_report_peaks", "report_peaks"),
    ("daily_top_picos", "top_picos"),
    ("hourly_consumo_por_region", "v_consumo_por_region"),
    ("hourly_perfil_horario", "v_perfil_horario"),
    ("hourly_picos_por_hora", "picos_por_hora"),
    ("hourly_heatmap", "heatmap"),
    ("hourly_report_profile", "report_profile"),
):
    BODIES[_rolled] = BODIES[_name]


def all_oracles() -> dict[str, str]:
    return {name: PRELUDE + body for name, body in BODIES.items()}
