"""Optional: the star in a relational database through Spark's JDBC source.

Needs the database's driver jar on the class path. Reads are split over executors by a numeric or
date column with known bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, page: int = 500, connections: int = 16, **options: str
) -> None:
    """Append in pages over a bounded number of connections."""
    (
        df.coalesce(connections)
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", page)
        .options(**options)
        .save()
    )
