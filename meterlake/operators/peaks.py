"""Peak detection: consumption above mean + 3 sample deviations, or flagged by the meter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.fixed_values import PEAK_SIGMAS
from meterlake.functions.exact import MILLION, to_micro


def source_flag(df: DataFrame) -> Column:
    """The meter's own flag as boolean; absent or NULL means no peak."""
    if "es_pico" not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col("es_pico").cast("boolean"), F.lit(False))


def batch_moments(clean: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and sample deviation of the kWh, over everything or per group.

    One partial aggregation of exact integer sums. The squares are re-centred on the integer mean
    before any division, so a constant batch has a deviation of exactly zero, whatever the order in
    which partial sums were merged.
    """
    kwh = to_micro(F.col("kwh_intervalo"))
    sums = clean.select(*by, kwh.alias("_x")).groupBy(*by).agg(
        F.count("_x").alias("lecturas"),
        F.sum("_x").alias("_s"),
        F.sum((F.col("_x") * F.col("_x")).cast("decimal(20,0)")).alias("_ss"),
    )
    n = F.col("lecturas")
    mean, total = F.col("_q").cast("decimal(12,0)"), F.col("_s").cast("decimal(19,0)")
    rest = (F.col("_s") - F.col("_q") * n).cast("double")
    centred = (
        F.col("_ss") - mean * total * 2 + mean * mean * n.cast("decimal(13,0)")
    ).cast("double")
    variance = (centred - rest * rest / n) / F.when(n > 1, n - 1)
    return sums.withColumn("_q", F.call_function("div", F.col("_s"), F.when(n > 0, n))).select(
        *by, "lecturas",
        (F.col("_s") / F.when(n > 0, n) / F.lit(float(MILLION))).alias("media"),
        (F.sqrt(variance) / F.lit(float(MILLION))).alias("desviacion"),
    )


def _limit() -> Column:
    deviation = F.when(F.col("desviacion") > 0, F.col("desviacion")).otherwise(F.lit(1.0))
    return F.col("media") + PEAK_SIGMAS * deviation


def peak_threshold(clean: DataFrame) -> Column:
    """The limit over the whole frame, as a scalar subquery: no join, no global window."""
    return clean.transform(batch_moments).select(_limit().alias("limite")).scalar()


def flag_peaks(clean: DataFrame, scope: Sequence[str] | None = None) -> DataFrame:
    """Replace ``es_pico``: above the limit of its scope, or flagged by the meter.

    ``scope=None`` takes the statistics over the frame given (whole history in batch, one
    micro-batch in a stream). With column names, each group has its own limit: groups are reduced to
    one row before the join back, and a hot group on the reading side is left to the adaptive skew
    join.
    """
    flagged = source_flag(clean)
    if scope is None:
        above = F.col("kwh_intervalo") > peak_threshold(clean)
        return clean.withColumn("es_pico", F.coalesce(above, F.lit(False)) | flagged)
    limits = batch_moments(clean, scope).select(
        *[F.col(c).alias(f"_{c}") for c in scope], _limit().alias("_limite")
    )
    same_group = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in scope]
    )
    above = F.coalesce(F.col("kwh_intervalo") > F.col("_limite"), F.lit(False))
    return (
        clean.withColumn("_origen", flagged)
        .join(limits, same_group, "left")
        .withColumn("es_pico", above | F.col("_origen"))
        .drop("_limite", "_origen", *[f"_{c}" for c in scope])
    )
