"""Reading a warehouse table over JDBC, split into ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str = "period_start",
    lower: datetime | int | None = None,
    upper: datetime | int | None = None,
    partitions: int = 32,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """One connection per range of ``partition_column``. The bounds only set the ranges' width;
    rows beyond them are read too."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", fetch_size)
        .options(**options)
    )
    if lower is not None and upper is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", partitions)
        )
    return reader.load()
