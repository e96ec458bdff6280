"""Declared schemas of readings and star tables. Nothing is inferred per batch."""

from __future__ import annotations

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("id_medidor", T.StringType()),
    T.StructField("id_hogar", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("tarifa", T.StringType()),
    T.StructField("kwh_intervalo", T.DoubleType()),
    T.StructField("potencia_w", T.DoubleType()),
    T.StructField("voltaje", T.DoubleType()),
    T.StructField("corriente", T.DoubleType()),
    T.StructField("factor_potencia", T.DoubleType()),
    T.StructField("es_pico", T.IntegerType()),
    T.StructField("estado", T.StringType()),
])

REGISTRY = T.StructType([
    T.StructField("id_medidor", T.StringType()),
    T.StructField("id_hogar", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("tarifa", T.StringType()),
    T.StructField("factor", T.DoubleType()),
])

DIM_TIEMPO = T.StructType([
    T.StructField("tiempo_key", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("fecha", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hora", T.IntegerType()),
    T.StructField("dia_semana", T.StringType()),
    T.StructField("es_finde", T.BooleanType()),
    T.StructField("trimestre", T.IntegerType()),
    T.StructField("mes_nombre", T.StringType()),
])

DIM_REGION = T.StructType([
    T.StructField("region_key", T.IntegerType()),
    T.StructField("region", T.StringType()),
    T.StructField("tarifa_kwh", T.DoubleType()),
])

DIM_HOGAR = T.StructType([
    T.StructField("hogar_key", T.LongType()),
    T.StructField("id_hogar", T.StringType()),
    T.StructField("id_medidor", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("region_key", T.IntegerType()),
])

# fecha and batch_id are the partition columns: date pruning and idempotent batch replacement.
FACT_CONSUMO = T.StructType([
    T.StructField("tiempo_key", T.LongType()),
    T.StructField("hogar_key", T.LongType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("timestamp_real", T.TimestampNTZType()),
    T.StructField("kwh_intervalo", T.DoubleType()),
    T.StructField("voltaje", T.DoubleType()),
    T.StructField("corriente", T.DoubleType()),
    T.StructField("factor_potencia", T.DoubleType()),
    T.StructField("potencia_w", T.DoubleType()),
    T.StructField("costo_mxn", T.DoubleType()),
    T.StructField("es_pico", T.BooleanType()),
    T.StructField("fecha", T.DateType()),
    T.StructField("batch_id", T.StringType()),
])

RESUMEN_DIARIO = T.StructType([
    T.StructField("hogar_key", T.LongType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("kwh_total", T.DoubleType()),
    T.StructField("kwh_max", T.DoubleType()),
    T.StructField("kwh_promedio", T.DoubleType()),
    T.StructField("costo_total", T.DoubleType()),
    T.StructField("num_lecturas", T.LongType()),
    T.StructField("num_picos", T.LongType()),
    T.StructField("fecha", T.DateType()),
])

RESUMEN_HORARIO = T.StructType([
    T.StructField("hora", T.IntegerType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("kwh_total", T.DoubleType()),
    T.StructField("kwh_max", T.DoubleType()),
    T.StructField("costo_total", T.DoubleType()),
    T.StructField("num_lecturas", T.LongType()),
    T.StructField("num_picos", T.LongType()),
    T.StructField("fecha", T.DateType()),
])

# Homes with readings on a date: a bitmap of the keys of each bucket.
HOGARES_ACTIVOS = T.StructType([
    T.StructField("cubeta", T.LongType()),
    T.StructField("mapa", T.BinaryType()),
    T.StructField("fecha", T.DateType()),
])

# The biggest peaks of a date, as kept at load.
PICOS_MAYORES = T.StructType([
    T.StructField("timestamp_real", T.TimestampNTZType()),
    T.StructField("hogar_key", T.LongType()),
    T.StructField("region_key", T.IntegerType()),
    T.StructField("kwh_intervalo", T.DoubleType()),
    T.StructField("costo_mxn", T.DoubleType()),
    T.StructField("fecha", T.DateType()),
])
