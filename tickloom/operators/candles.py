"""OHLCV candles: from trades, from finer candles, and for the tail of a refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ordering import BucketOrder
from tickloom.functions.times import bucket_start, seconds_of
from tickloom.operators.dedup import dedup_trades
from tickloom.schema import CANDLE_COLUMNS

REBUILD_TAIL_SECONDS = 3600
CANDLE_INPUT = ["trade_id", "symbol", "price", "quantity", "amount_usdt", "trade_time"]


def _aggregate(trades: DataFrame, order: BucketOrder, group: Column) -> DataFrame:
    # Prices compare the same as doubles, and the candle stores doubles; sums stay exact.
    price = F.col("price").cast("double")
    return (
        order.with_keys(trades)
        .groupBy(group.alias("bucket"), "symbol")
        .agg(
            *order.first(price, "open"),
            F.max(price).alias("high_price"),
            F.min(price).alias("low_price"),
            *order.last(price, "close"),
            F.sum("quantity").cast("double").alias("total_volume"),
            F.sum("amount_usdt").cast("double").alias("total_amount_usdt"),
            F.count("trade_id").cast("int").alias("trades_count"),
        )
    )


def _finish(groups: DataFrame, order: BucketOrder, start: Column) -> DataFrame:
    return groups.select(
        start.alias("period_start"),
        "symbol",
        order.pick_first("open", start).alias("open_price"),
        "high_price",
        "low_price",
        order.pick_last("close", start).alias("close_price"),
        "total_volume",
        "total_amount_usdt",
        "trades_count",
    )


def ohlcv(trades: DataFrame, bucket: str | int = "minute") -> DataFrame:
    """Candles of warehouse trades (decimal amounts, timestamp times).

    Open and close follow (trade_time, trade_id), with a NULL id after all others.
    Volume and turnover are summed as decimals and stored as doubles. One shuffle, on
    (bucket, symbol), after a partial hash aggregate.
    """
    order = BucketOrder("trade_time", "trade_id", seconds_of(bucket))
    timed = trades.select(*CANDLE_INPUT).where(F.col("trade_time").isNotNull())
    groups = _aggregate(timed, order, bucket_start(F.col("trade_time"), bucket))
    return _finish(groups, order, F.col("bucket"))


def rollup_candles(candles: DataFrame, bucket: str | int = "hour") -> DataFrame:
    """Coarser candles from finer ones."""
    return (
        candles.groupBy(
            bucket_start(F.col("period_start"), bucket).alias("bucket"), "symbol"
        )
        .agg(*_merge())
        .select(F.col("bucket").alias("period_start"), *CANDLE_COLUMNS[1:])
    )


def _merge() -> list[Column]:
    return [
        F.min_by("open_price", "period_start").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "period_start").alias("close_price"),
        total("total_volume").alias("total_volume"),
        total("total_amount_usdt").alias("total_amount_usdt"),
        F.sum("trades_count").cast("int").alias("trades_count"),
    ]


def summarize_candles(candles: DataFrame, *keys: str) -> DataFrame:
    """One candle per key out of all its candles."""
    return candles.groupBy(*keys).agg(*_merge())


def total(column: str) -> Column:
    """Sum of a stored double that does not depend on row order."""
    return F.sum(F.col(column).cast("decimal(28,8)")).cast("double")


def candles_from(
    trades: DataFrame, cutoff: Column, bucket: str | int = "minute", dedup: bool = True
) -> DataFrame:
    """Candles of all trades at or after ``cutoff``, itself a bucket start.

    The filter is on the bare time column, so it reaches the scan, and on the partition
    day where there is one. It goes before the dedup: the version that wins has the
    latest time, so if any version passes the filter, the winner does.
    """
    tail = trades.where(F.col("trade_time") >= cutoff)
    if "insert_date" in trades.columns:
        tail = tail.where(F.col("insert_date") >= F.to_date(cutoff))
    tail = tail.select(*CANDLE_INPUT)
    return ohlcv(dedup_trades(tail) if dedup else tail, bucket)
