"""Batch job: copy candles to the serving table, partitioned by month."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.placement import with_month
from tickloom.plans.mart import PUBLISHED, read_mart, refresh_mart
from tickloom.schema import CANDLE, CANDLE_COLUMNS
from tickloom.session import fitted_shuffles
from tickloom.sinks.tables import read_note, write_note, write_partitions
from tickloom.sources.lake import partitioned, read_table

SERVING_BY = ["period_month"]
SERVING_SORT = ["symbol", "period_start"]


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, partitioned(CANDLE, "period_month", "integer"))


def publish_candles(
    spark: SparkSession, mart_path: str, serving_path: str, since: datetime | None = None
) -> None:
    """Copy whole months from the mart, by name, sorted by (symbol, period_start).

    With ``since`` (a refresh's cutoff) only the months from there on are sent again; each
    replaces its old copy, so nothing has to be collapsed afterwards. A failed write raises;
    a run without ``since`` mends it, since the mart is not touched.
    """
    candles = read_mart(spark, mart_path)
    if since is not None:
        first_day = since.date().replace(day=1)
        candles = candles.where(F.col("period_date") >= F.lit(first_day))
    monthly = with_month(candles.select(*CANDLE_COLUMNS))
    with fitted_shuffles(candles):
        write_partitions(monthly, serving_path, SERVING_BY, SERVING_SORT)


def refresh_and_publish(
    spark: SparkSession, raw_path: str, mart_path: str, staging_path: str, serving_path: str,
    bucket: str | int = "minute", late: bool = True,
) -> datetime:
    """Refresh the mart and send what changed; return the refresh's cutoff.

    A note beside the mart names the serving table that has all of it. Every refresh removes it
    first, so after a run that died, failed to publish or did not publish, all months go out.
    """
    current = read_note(spark, f"{mart_path}/{PUBLISHED}") == serving_path
    cutoff = refresh_mart(spark, raw_path, mart_path, staging_path, bucket, late=late)
    publish_candles(spark, mart_path, serving_path, cutoff if current else None)
    write_note(spark, f"{mart_path}/{PUBLISHED}", serving_path)
    return cutoff
