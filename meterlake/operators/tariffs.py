"""Pricing of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.fixed_values import DEFAULT_TARIFF, TARIFFS, Tariff
from meterlake.functions.exact import MILLION, from_micro, to_micro
from meterlake.operators.books import (
    lookup_meter,
    lookup_tariff,
    tariff_of_city,
    tier_bounds,
    tier_range_join,
)


# What orders readings of one home and moment, as far as the columns are there.
TIEBREAK = (
    "id_medidor", "kwh_intervalo", "potencia_w", "voltaje", "corriente", "factor_potencia", "estado",
)


def _amount(kwh: Column, price: Column) -> Column:
    """kWh times price, six decimals half up, in integer arithmetic."""
    product = to_micro(kwh) * to_micro(price) + F.lit(MILLION // 2)
    return from_micro(F.call_function("div", product, F.lit(MILLION)))


def price_flat(
    df: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    code: str | Column = "tarifa",
    out: str = "costo_mxn",
    default: str = DEFAULT_TARIFF,
) -> DataFrame:
    """Price at the first block of the tariff: the cost when nothing was used yet this month."""
    return lookup_tariff(df, books, code, default).withColumn(
        out, _amount(F.col("kwh_intervalo"), F.col("precio_base"))
    ).drop("tarifa_aplicada", "precio_base")


def cost_etl(
    clean: DataFrame, books: Sequence[Tariff] = TARIFFS, default: str = DEFAULT_TARIFF
) -> DataFrame:
    """Cost by the tariff written on the reading (default tariff if it has none)."""
    code = F.col("tarifa") if "tarifa" in clean.columns else F.lit(None).cast("string")
    return price_flat(clean, books, code, default=default)


def _text(df: DataFrame, column: str) -> Column:
    """The column, with absent columns and blank text as NULL."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    return F.nullif(F.col(column), F.lit(""))


def resolve_home_tariff(
    readings: DataFrame, registry: DataFrame, default: str = DEFAULT_TARIFF
) -> DataFrame:
    """Add ``hogar_resuelto`` and ``tarifa_resuelta``; ``default`` is the tariff of a reading that has none.

    Each is the reading's own value, else the registry's by meter, else "" and the default tariff.
    Only readings that lack one of the two are joined to the registry; the others, normally nearly
    all, are not shuffled.
    """
    own = readings.withColumns({
        "hogar_resuelto": _text(readings, "id_hogar"),
        "tarifa_resuelta": _text(readings, "tarifa"),
    })
    whole = F.col("hogar_resuelto").isNotNull() & F.col("tarifa_resuelta").isNotNull()
    if "id_medidor" not in readings.columns:
        return own.withColumns({
            "hogar_resuelto": F.coalesce("hogar_resuelto", F.lit("")),
            "tarifa_resuelta": F.coalesce("tarifa_resuelta", F.lit(default)),
        })
    repaired = lookup_meter(own.where(~whole), registry).withColumns({
        "hogar_resuelto": F.coalesce("hogar_resuelto", "hogar_registro", F.lit("")),
        "tarifa_resuelta": F.coalesce(
            F.col("tarifa_resuelta"),
            F.nullif(F.col("tarifa_registro"), F.lit("")),
            F.lit(default),
        ),
    }).drop("hogar_registro", "tarifa_registro")
    return own.where(whole).unionByName(repaired)


def home_tariffs(
    registry: DataFrame, books: Sequence[Tariff] = TARIFFS, default: str = DEFAULT_TARIFF
) -> DataFrame:
    """Tariff of the city of every registered home, by its first meter; one row per home."""
    meters = registry.select("id_hogar", "id_medidor", "ciudad").distinct()
    homes = meters.groupBy("id_hogar").agg(F.min_by("ciudad", "id_medidor").alias("ciudad"))
    return tariff_of_city(homes, books, default=default).select("id_hogar", "tarifa_ciudad")


def cost_dwh(
    readings: DataFrame,
    registry: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    homes: DataFrame | None = None,
    out: str = "costo_dwh",
    default: str = DEFAULT_TARIFF,
) -> DataFrame:
    """Cost by the tariff of the home's city; for an unknown home by the resolved tariff.

    ``homes`` is a stored home lookup; without it the lookup is derived from the registry.
    """
    resolved = resolve_home_tariff(readings, registry, default)
    cities = (home_tariffs(registry, books, default) if homes is None else homes).select(
        F.col("id_hogar").alias("_hogar"), "tarifa_ciudad"
    )
    joined = resolved.join(cities, F.col("hogar_resuelto") == F.col("_hogar"), "left")
    code = F.coalesce("tarifa_ciudad", "tarifa_resuelta")
    return price_flat(joined, books, code, out, default).drop("_hogar", "tarifa_ciudad")


def month_to_date(
    df: DataFrame,
    home: str = "id_hogar",
    ts: str = "timestamp",
    tiebreak: Sequence[str] | None = None,
    kwh: str = "kwh_intervalo",
    slice_length: str = "15 minutes",
) -> DataFrame:
    """Add ``kwh_acumulado_mes``: what the home used this month before the reading.

    Two levels, so a home with a large share of all rows is never one sort: slice totals (partially
    aggregated before their shuffle) give the running total at the start of each slice, at most
    2,976 quarter hours per home and month; inside a slice the readings are accumulated in order.
    Readings are shuffled once, by home, month and slice, for both the window and the join. Take a
    shorter slice where one meter reports extremely often; a slice over a month end counts for each
    month apart. Readings of one moment follow ``tiebreak``, by default the meter and the measures.

    Readings of no home (NULL or blank) have no total, 0, and no window; one without timestamp has
    NULL. No row is lost.
    """
    if tiebreak is None:
        tiebreak = [c for c in TIEBREAK if c in df.columns]
    known = (F.trim(F.coalesce(F.col(home).cast("string"), F.lit(""))) != "") & F.col(ts).isNotNull()
    outside = df.where(~known).withColumn(
        "kwh_acumulado_mes", F.when(F.col(ts).isNotNull(), F.lit(0.0))
    )
    keyed = df.where(known).withColumns({
        "_cuarto": F.window(F.col(ts), slice_length)["start"],
        "_hogar": F.col(home).cast("string"),
        "_mes": F.year(ts) * 12 + F.month(ts),
        "_kwh": to_micro(F.col(kwh)),
    })
    quarters = keyed.groupBy("_hogar", "_mes", "_cuarto").agg(F.sum("_kwh").alias("_total"))
    earlier_quarters = (
        Window.partitionBy("_hogar", "_mes").orderBy("_cuarto")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = quarters.select(
        "_hogar", "_mes", "_cuarto",
        F.coalesce(F.sum("_total").over(earlier_quarters), F.lit(0)).alias("_antes"),
    )
    earlier_readings = (
        Window.partitionBy("_hogar", "_mes", "_cuarto").orderBy(ts, *tiebreak)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = keyed.withColumn(
        "_dentro", F.coalesce(F.sum("_kwh").over(earlier_readings), F.lit(0))
    )
    return (
        inside.join(starts, ["_hogar", "_mes", "_cuarto"])
        .withColumn("kwh_acumulado_mes", from_micro(F.col("_antes") + F.col("_dentro")))
        .drop("_cuarto", "_hogar", "_mes", "_kwh", "_antes", "_dentro")
        .unionByName(outside)
    )


def price_tiered(
    df: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    code: str | Column = "tarifa",
    total: str = "kwh_acumulado_mes",
    kwh: str = "kwh_intervalo",
    out: str = "costo_mxn",
    default: str = DEFAULT_TARIFF,
) -> DataFrame:
    """Price at the block where the month-to-date total falls; adds ``nivel`` and the cost.

    A reading is priced whole at the block its total starts in; it is not split over blocks.
    """
    applied = lookup_tariff(df, books, code, default).drop("precio_base")
    placed = tier_range_join(applied, tier_bounds(df.sparkSession, books), total=total)
    return placed.withColumn(out, _amount(F.col(kwh), F.col("precio"))).drop(
        "tarifa_aplicada", "precio"
    )
