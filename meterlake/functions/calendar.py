"""Calendar attributes of zone-less timestamps.

Every expression works on TIMESTAMP_NTZ or DATE directly. Pattern formatting is avoided on event
time because it would go through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.fixed_values import DAY_SPELLINGS, DAYS_EN, MONTHS_ES


def _pick(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def bucket_15min(ts: Column) -> Column:
    """Start of the quarter hour; use inside select/withColumn (NULL timestamps are dropped)."""
    return F.window(ts, "15 minutes")["start"]


def tiempo_key(bucket: Column) -> Column:
    """yyyyMMddHHmm as BIGINT."""
    day = (F.year(bucket) * 10000 + F.month(bucket) * 100 + F.day(bucket)).cast("long")
    return day * 10000 + F.hour(bucket) * 100 + F.minute(bucket)


def iso_text(bucket: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss of a bucket (which has no fraction of a second)."""
    return F.replace(bucket.cast("string"), F.lit(" "), F.lit("T"))


def date_text(day: Column) -> Column:
    return day.cast("date").cast("string")


def timestamp_text(ts: Column) -> Column:
    """Timestamp text cut to whole seconds."""
    return F.substring(ts.cast("string"), 1, 19)


def dia_semana(ts: Column) -> Column:
    return _pick(DAYS_EN, F.weekday(ts) + 1)


def es_finde(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def mes_nombre(month: Column) -> Column:
    return _pick(MONTHS_ES, month)


def iso_year(day: Column) -> Column:
    """Year that owns the ISO week of a date: the year of that week's Thursday."""
    return F.year(F.date_add(day, 3 - F.weekday(day)))


def day_index(name: Column) -> Column:
    """0 = Monday … 6 = Sunday for an English or Spanish day name, accents optional."""
    key = F.lower(F.trim(name))
    index = F.lit(None).cast("int")
    for i, spellings in enumerate(DAY_SPELLINGS):
        index = F.when(key.isin(*spellings), F.lit(i)).otherwise(index)
    return index
