"""Tariff book and meter registry as DataFrames, and the lookups into them.

The book is a Python constant, so its row count is known when the plan is built; its frames are
local relations that the planner sizes and broadcasts by itself. Registries may be large and get no
hint: adaptive execution decides by their measured size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import schemas
from meterlake.fixed_values import DEFAULT_TARIFF, METERS, TARIFFS, Meter, Tariff
from meterlake.functions.exact import to_micro
from meterlake.session import constant_frame

_BOOK = T.StructType([
    T.StructField("posicion", T.IntegerType()),
    T.StructField("tarifa", T.StringType()),
    T.StructField("ciudades", T.ArrayType(T.StringType())),
    T.StructField("bloques", T.ArrayType(T.StructType([
        T.StructField("limite_kwh", T.DoubleType()),
        T.StructField("precio", T.DoubleType()),
    ]))),
    T.StructField("dac_kwh_mes", T.DoubleType()),
    T.StructField("dac_precio", T.DoubleType()),
])


_TIER = T.StructType([
    T.StructField("tarifa", T.StringType()), T.StructField("nivel", T.StringType()),
    T.StructField("desde", T.DoubleType()), T.StructField("hasta", T.DoubleType()),
    T.StructField("precio", T.DoubleType()),
])
_CITY = T.StructType([
    T.StructField("_ciudad", T.StringType()), T.StructField("_tarifa", T.StringType()),
])


def tariff_book(spark: SparkSession, books: Sequence[Tariff] = TARIFFS) -> DataFrame:
    """The nested book, one row per tariff, in book order."""
    rows = [
        (
            i + 1, t.clave, list(t.ciudades),
            [{"limite_kwh": b.limite_kwh, "precio": b.precio} for b in t.bloques],
            float(t.dac_kwh_mes), float(t.dac_precio),
        )
        for i, t in enumerate(books)
    ]
    return constant_frame(spark, rows, _BOOK)


def meter_registry(spark: SparkSession, meters: Sequence[Meter] = METERS) -> DataFrame:
    return constant_frame(spark, [tuple(m) for m in meters], schemas.REGISTRY)


def first_block_prices(spark: SparkSession, books: Sequence[Tariff] = TARIFFS) -> DataFrame:
    return tariff_book(spark, books).select(
        "posicion", "tarifa", F.get("bloques", F.lit(0))["precio"].alias("precio_base")
    )


def tier_bounds(spark: SparkSession, books: Sequence[Tariff] = TARIFFS) -> DataFrame:
    """Month-to-date bounds of every block: running sums of the block widths.

    Blocks are cut at the high-consumption limit, above which one last row carries its price, so
    one range join finds the price of any total: the last block ends at that limit whatever its own
    width, and without any block below the limit the last row starts at 0. Columns: tarifa, nivel,
    desde, hasta (NULL = open), precio; ``nivel`` is the block number or 'DAC'.
    """
    rows: list[tuple] = []
    for tariff in books:
        start, limit, own = 0.0, float(tariff.dac_kwh_mes), []
        for number, block in enumerate(tariff.bloques, 1):
            if start >= limit:
                break
            end = limit if block.limite_kwh is None else min(start + float(block.limite_kwh), limit)
            own.append((tariff.clave, str(number), start, end, float(block.precio)))
            start += float(block.limite_kwh or 0.0)
        if own:
            own[-1] = (*own[-1][:3], limit, own[-1][4])
        rows += [*own, (tariff.clave, "DAC", limit if own else 0.0, None, float(tariff.dac_precio))]
    return constant_frame(spark, rows, _TIER)


def lookup_tariff(
    df: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    code: str | Column = "tarifa",
    default: str = DEFAULT_TARIFF,
) -> DataFrame:
    """Add ``tarifa_aplicada`` and its ``precio_base``; unknown and NULL codes take the default.

    A ``default`` that is not in the book is an error, since its readings would have no price.

    The code is replaced by the default before the join (the codes are known here), so the join is
    a plain inner equi-join on a five-row side.
    """
    if default not in {t.clave for t in books}:
        raise ValueError(f"the default tariff {default!r} is not in the book")
    code = F.col(code) if isinstance(code, str) else code
    known = F.when(code.isin(*[t.clave for t in books]), code).otherwise(F.lit(default))
    prices = first_block_prices(df.sparkSession, books).select(
        F.col("tarifa").alias("tarifa_aplicada"), "precio_base"
    )
    return df.withColumn("tarifa_aplicada", known).join(prices, "tarifa_aplicada")


def tariff_of_city(
    df: DataFrame,
    books: Sequence[Tariff] = TARIFFS,
    city: str = "ciudad",
    default: str | None = DEFAULT_TARIFF,
) -> DataFrame:
    """Add ``tarifa_ciudad``: the first tariff of the book that serves the city, else the default."""
    first: dict[str, str] = {}
    for tariff in books:
        for served in tariff.ciudades:
            first.setdefault(served, tariff.clave)
    cities = constant_frame(df.sparkSession, list(first.items()), _CITY)
    return df.join(cities, df[city] == cities["_ciudad"], "left").withColumn(
        "tarifa_ciudad", F.coalesce("_tarifa", F.lit(default))
    ).drop("_ciudad", "_tarifa")


def lookup_meter(df: DataFrame, registry: DataFrame, meter: str = "id_medidor") -> DataFrame:
    """Left lookup of a meter: adds ``hogar_registro`` and ``tarifa_registro``.

    The registry has one row per meter, as the stored one does.
    """
    entries = registry.select(
        F.col("id_medidor").alias("_medidor"),
        F.col("id_hogar").alias("hogar_registro"),
        F.col("tarifa").alias("tarifa_registro"),
    )
    return df.join(entries, df[meter] == entries["_medidor"], "left").drop("_medidor")


def tier_range_join(
    df: DataFrame,
    tiers: DataFrame,
    tariff: str = "tarifa_aplicada",
    total: str = "kwh_acumulado_mes",
) -> DataFrame:
    """Add ``nivel`` and ``precio`` of the block with desde <= total < hasta within the tariff.

    Every row stays: the block that starts at 0 also takes negative totals, and a row without total or
    with a tariff that has no bounds gets NULL. The tariff equality keeps this a hash join; bounds
    and totals are compared in millionths.
    """
    bounds = tiers.select(
        F.col("tarifa").alias("_tarifa"), "nivel", "precio",
        to_micro(F.col("desde")).alias("_desde"), to_micro(F.col("hasta")).alias("_hasta"),
    )
    position = to_micro(F.col(total))
    return df.join(
        bounds,
        (F.col(tariff) == F.col("_tarifa"))
        & ((position >= F.col("_desde")) | ((position < 0) & (F.col("_desde") <= 0)))
        & (F.col("_hasta").isNull() | (position < F.col("_hasta"))),
        "left",
    ).drop("_tarifa", "_desde", "_hasta")
