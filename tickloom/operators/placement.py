"""Partition columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import month_number


def with_month(candles: DataFrame, name: str = "period_month") -> DataFrame:
    return candles.withColumn(name, month_number(F.col("period_start")))


def with_period_date(candles: DataFrame, name: str = "period_date") -> DataFrame:
    return candles.withColumn(name, F.to_date("period_start"))
