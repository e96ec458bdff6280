"""Month-to-date prices during ingestion: a ledger that late readings correct.

A reading's price depends on all earlier readings of its home in the month, so a late one changes others.
``cuartos_mes`` keeps what every batch adds to the quarter hours of a home; ``libro_mes`` keeps the priced
readings of every batch, and the corrections it makes: an entry of sign -1 takes back a price that an
earlier batch gave, one of sign 1 puts the new one in its place. Sums over the ledger are right as they
are; ``priced_readings`` nets the entries.

A batch sees the batches before it by number, whatever else is stored. So it may be repeated at any time
and replaces its own partitions by the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.fixed_values import DEFAULT_TARIFF, TARIFFS, Tariff
from meterlake.functions.exact import count_where, exact_sum, from_micro, to_micro
from meterlake.operators.tariffs import TIEBREAK, month_to_date, price_tiered
from meterlake.session import constant_frame
from meterlake.sources import files
from meterlake.sources.lake import replace_partitions

SLICES, LEDGER = "cuartos_mes", "libro_mes"
_PRICE = ("nivel", "costo_mxn")


def _month(ts: str):
    return (F.year(ts) * 100 + F.month(ts)).alias("mes")


def _before(spark: SparkSession, path: str, table: str, schema: T.StructType, months: Sequence[int], lote: int) -> DataFrame:
    """Rows of earlier batches in some months; only these months are listed."""
    folders = [f"{path}/{table}/mes={m}" for m in months if files.names(spark, f"{path}/{table}/mes={m}")]
    if not folders:
        return constant_frame(spark, [], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/{table}").parquet(*folders)
    return rows.where(F.col("lote") < lote)


def _netted(entries: DataFrame) -> DataFrame:
    """Entries that no other takes back, as often as they stand."""
    values = [c for c in entries.columns if c not in ("signo", "lote")]
    left = entries.groupBy(*values).agg(F.sum("signo").cast("int").alias("_n")).where("_n > 0")
    return left.withColumn("_n", F.explode(F.array_repeat(F.lit(1), F.col("_n")))).drop("_n")


def price_batch(
    readings: DataFrame,
    path: str,
    lote: int,
    books: Sequence[Tariff] = TARIFFS,
    home: str = "id_hogar",
    ts: str = "timestamp",
    kwh: str = "kwh_intervalo",
    code: str = "tarifa",
    tiebreak: Sequence[str] | None = None,
    default: str = DEFAULT_TARIFF,
) -> None:
    """Price the readings of batch number ``lote`` and correct earlier ones, in the ledger below ``path``.

    ``readings`` is read several times: pass a stored batch. Numbers order the batches. Where a home's
    new readings all come after its old ones of the month, one total per home is all that is looked up;
    entries are read for homes with late readings only, from the quarter hour of the first of them.
    Readings of no home are priced at a total of 0, as ``month_to_date`` says; those without timestamp have
    no month and are left out. Months come to the driver, readings don't.
    """
    spark = readings.sparkSession
    if tiebreak is None:
        tiebreak = [c for c in TIEBREAK if c in readings.columns]
    order = [c for c in tiebreak if c not in (home, ts, kwh, code)]
    columns = [home, ts, kwh, code, *order]
    new = readings.where(F.col(ts).isNotNull()).select(*columns, _month(ts))
    months = [r.mes for r in new.select("mes").distinct().collect()]
    known = F.trim(F.coalesce(F.col(home), F.lit(""))) != ""
    slices = new.where(known).groupBy(F.col(home), "mes", F.window(ts, "15 minutes")["start"].alias("cuarto")).agg(
        F.sum(to_micro(F.col(kwh))).alias("_kwh"), F.min(ts).alias("primero"), F.max(ts).alias("ultimo"),
    ).withColumn("lote", F.lit(lote).cast("long"))
    replace_partitions(slices, f"{path}/{SLICES}", "mes", "lote")

    own = spark.read.schema(slices.schema).option("basePath", f"{path}/{SLICES}").parquet(
        *[f"{path}/{SLICES}/mes={m}/lote={lote}" for m in months if files.names(spark, f"{path}/{SLICES}/mes={m}/lote={lote}")]
    ) if months and files.names(spark, f"{path}/{SLICES}") else constant_frame(spark, [], slices.schema)
    first = own.groupBy(home, "mes").agg(F.min("cuarto").alias("_c0"), F.min("primero").alias("_t0"))
    earlier = _before(spark, path, SLICES, slices.schema, months, lote).join(first, [home, "mes"])
    late = F.col("_ultimo") >= F.col("_t0")
    start = earlier.groupBy(home, "mes", "_c0", "_t0").agg(
        F.sum("_kwh").alias("_todo"), F.max("ultimo").alias("_ultimo"),
        F.coalesce(F.sum(F.when(F.col("cuarto") < F.col("_c0"), F.col("_kwh"))), F.lit(0)).alias("_antes"),
    ).select(home, "mes", "_c0", late.alias("_tarde"), F.when(late, F.col("_antes")).otherwise(F.col("_todo")).alias("_base"))

    entry = T.StructType([
        *[new.schema[c] for c in columns], T.StructField("nivel", T.StringType()), T.StructField("costo_mxn", T.DoubleType()),
        T.StructField("signo", T.IntegerType()), new.schema["mes"], T.StructField("lote", T.LongType()),
    ])
    held = new.withColumns({f"_{c}": F.lit(None).cast(entry[c].dataType) for c in _PRICE}).withColumn("_vieja", F.lit(False))
    behind = start.where("_tarde").select(home, "mes", "_c0")
    if not behind.isEmpty():
        entries = _before(spark, path, LEDGER, entry, months, lote)
        touched = entries.join(behind, [home, "mes"]).where(F.col(ts) >= F.col("_c0")).drop("_c0")
        old = _netted(touched).withColumnsRenamed({c: f"_{c}" for c in _PRICE}).withColumn("_vieja", F.lit(True))
        held = held.unionByName(old)

    running = month_to_date(held, home, ts, tiebreak, kwh).join(start.select(home, "mes", "_base"), [home, "mes"], "left")
    total = from_micro(to_micro(F.col("kwh_acumulado_mes")) + F.coalesce("_base", F.lit(0)))
    priced = price_tiered(running.withColumn("kwh_acumulado_mes", total), books, code, kwh=kwh, default=default)
    same = F.col("nivel").eqNullSafe(F.col("_nivel")) & F.col("costo_mxn").eqNullSafe(F.col("_costo_mxn"))
    put = F.struct("nivel", "costo_mxn", F.lit(1).alias("signo"))
    taken = F.struct(F.col("_nivel").alias("nivel"), F.col("_costo_mxn").alias("costo_mxn"), F.lit(-1).alias("signo"))
    lines = F.when(~F.col("_vieja"), F.array(put)).when(~same, F.array(taken, put))
    out = priced.select(*columns, "mes", F.explode(lines).alias("_l")).select(
        *columns, "_l.*", "mes", F.lit(lote).cast("long").alias("lote")
    )
    replace_partitions(out.select(*entry.names), f"{path}/{LEDGER}", "mes", "lote")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries, with sign, month and batch number."""
    return spark.read.parquet(f"{path}/{LEDGER}")


def priced_readings(spark: SparkSession, path: str) -> DataFrame:
    """Every reading with the block and cost that hold now."""
    return _netted(read_ledger(spark, path))


def month_bills(spark: SparkSession, path: str, home: str = "id_hogar", kwh: str = "kwh_intervalo") -> DataFrame:
    """kWh, cost and readings per home and month, from the entries as they stand: no netting, one aggregation."""
    sign = F.col("signo")
    return read_ledger(spark, path).groupBy(home, "mes").agg(
        exact_sum(F.col(kwh) * sign).alias("kwh"), exact_sum(F.col("costo_mxn") * sign).alias("costo"),
        F.sum(sign).alias("lecturas"), count_where(sign < 0).alias("correcciones"),
    )
