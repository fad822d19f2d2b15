"""Dashboard questions over real-time trades and candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickloom.functions.ordering import BucketOrder
from tickloom.functions.times import bucket_start, seconds_interval, seconds_of
from tickloom.operators.candles import summarize_candles
from tickloom.operators.ingest import with_taker_side
from tickloom.operators.retention import latest
from tickloom.schema import MONEY

DAY = 86400
WHALE_LIMIT = 50


def _since(rows: DataFrame, time: str, seconds: int, as_of: Column | None) -> DataFrame:
    """Rows of the last ``seconds`` before ``as_of`` (default: the newest row)."""
    if as_of is None:
        start = latest(rows, time, -seconds)
    else:
        start = as_of - seconds_interval(seconds)
    recent = rows.where(F.col(time) > start)
    for day in ("insert_date", "period_date"):
        if day in rows.columns:
            recent = recent.where(F.col(day) >= F.to_date(start))
    return recent


def exact_sum(amount: Column) -> Column:
    """Sum in the warehouse's decimal type, as a double; the same in any row order."""
    return F.sum(amount.cast(MONEY)).cast("double")


def current_price(trades: DataFrame) -> DataFrame:
    """Last price of each symbol by (trade_time, trade_id).

    Taken per day first, where the cheap order key applies, then over the days.
    """
    order = BucketOrder("trade_time", "trade_id", DAY)
    timed = trades.where(F.col("trade_time").isNotNull())
    daily = (
        order.with_keys(timed.select("trade_id", "symbol", "price", "trade_time"))
        .groupBy(bucket_start(F.col("trade_time"), DAY).alias("bucket"), "symbol")
        .agg(
            *order.last(F.col("price").cast("double"), "close"),
            F.max("trade_time").alias("trade_time"),
        )
    )
    return daily.groupBy("symbol").agg(
        F.max_by(order.pick_last("close", F.col("bucket")), "bucket").alias("price"),
        F.max("trade_time").alias("trade_time"),
    )


def volume_by_bucket(
    trades: DataFrame,
    seconds: int = 3600,
    bucket: str | int = "minute",
    as_of: Column | None = None,
) -> DataFrame:
    """Volume, turnover and trade count per symbol and minute over the last hour."""
    recent = _since(trades, "trade_time", seconds, as_of)
    return recent.groupBy(
        bucket_start(F.col("trade_time"), bucket).alias("period_start"), "symbol"
    ).agg(
        exact_sum(F.col("quantity")).alias("total_volume"),
        exact_sum(F.col("amount_usdt")).alias("total_amount_usdt"),
        F.count("trade_id").cast("int").alias("trades_count"),
    )


def whale_trades(
    trades: DataFrame, threshold: float | str, limit: int | None = WHALE_LIMIT
) -> DataFrame:
    """Trades worth at least ``threshold``, newest first, with the taker's side."""
    # A literal of the column's own type lets the filter reach the scan.
    least = F.lit(threshold).cast(trades.schema["amount_usdt"].dataType)
    big = with_taker_side(trades.where(F.col("amount_usdt") >= least))
    feed = big.select(
        "trade_time", "symbol", "trade_id", "side", "price", "quantity", "amount_usdt"
    )
    if limit is None:
        return feed
    return feed.orderBy(F.desc("trade_time"), F.desc("trade_id"), "symbol").limit(limit)


def market_pressure(
    trades: DataFrame, seconds: int | None = None, as_of: Column | None = None
) -> DataFrame:
    """Buys against sells per symbol; ``imbalance`` is (buy - sell) / (buy + sell)."""
    if seconds is not None:
        trades = _since(trades, "trade_time", seconds, as_of)
    sold = F.coalesce(F.col("is_buyer_maker"), F.lit(False))
    sides = trades.groupBy("symbol").agg(
        *(
            c
            for name, mine in (("buy", ~sold), ("sell", sold))
            for c in (
                F.coalesce(exact_sum(F.when(mine, F.col("amount_usdt"))), F.lit(0.0)).alias(
                    f"{name}_amount_usdt"
                ),
                F.count(F.when(mine, F.lit(1))).alias(f"{name}_count"),
            )
        )
    )
    buy, sell = F.col("buy_amount_usdt"), F.col("sell_amount_usdt")
    return sides.withColumn("imbalance", F.try_divide(buy - sell, buy + sell))


def candle_spread(candles: DataFrame) -> DataFrame:
    """High minus low, and the same as a share of low (NULL when low is 0)."""
    width = F.col("high_price") - F.col("low_price")
    return candles.select(
        "period_start",
        "symbol",
        width.alias("spread"),
        F.try_divide(width, F.col("low_price")).alias("spread_ratio"),
    )


def candle_stats(candles: DataFrame, seconds: int = DAY, as_of: Column | None = None) -> DataFrame:
    """One summary row per symbol over the candles of the last ``seconds``."""
    recent = _since(candles, "period_start", seconds, as_of)
    change = F.col("close_price") - F.col("open_price")
    return summarize_candles(recent, "symbol").withColumn(
        "change_pct", F.try_divide(change * 100, F.col("open_price"))
    )


def rolling_stats(candles: DataFrame, window: str | int = DAY) -> DataFrame:
    """Per candle: volume, turnover, high and low over the trailing ``window``.

    A range frame over a symbol's whole history would sort that history in one task and
    add up a full window again for every row. Instead time is cut into blocks as long as
    the window. A trailing window that ends inside a block is a head of that block plus
    a tail of the block before it. Each candle therefore takes part in two groups, its
    own block and, as history, the next one; in a (symbol, block) group the head is a
    running aggregate upwards in time and the tail one downwards. Groups hold at most
    two windows of candles, and the work is linear.
    """
    seconds = seconds_of(window)
    micros = F.unix_micros("period_start")
    width = F.lit(seconds * 1_000_000)
    offset = F.pmod(micros, width)
    block = micros - offset
    placed = (
        candles.withColumn("offset", offset)
        .withColumn("place", F.explode(F.array(
            F.struct(block.alias("block"), F.lit(False).alias("history")),
            F.struct((block + width).alias("block"), F.lit(True).alias("history")),
        )))
        .select("*", "place.block", "place.history")
        .drop("place")
    )
    group = Window.partitionBy("symbol", "block")
    # Up: own candles to this offset. Down: history strictly past it, so own rows come first.
    head = group.orderBy("offset", "history").rowsBetween(Window.unboundedPreceding, 0)
    tail = group.orderBy(F.desc("offset"), "history").rowsBetween(Window.unboundedPreceding, 0)
    own, old = ~F.col("history"), F.col("history")

    def both(reduce, combine, column, kind=None):
        value = F.col(column).cast(kind) if kind else F.col(column)
        return combine(
            reduce(F.when(own, value)).over(head), reduce(F.when(old, value)).over(tail)
        )

    def add(a, b):
        return (F.coalesce(a + b, a, b)).cast("double")

    return (
        placed.withColumns(
            {
                "volume": both(F.sum, add, "total_volume", "decimal(28,8)"),
                "amount_usdt": both(F.sum, add, "total_amount_usdt", "decimal(28,8)"),
                "highest": both(F.max, F.greatest, "high_price"),
                "lowest": both(F.min, F.least, "low_price"),
            }
        )
        .where(own)
        .select("period_start", "symbol", "volume", "amount_usdt", "highest", "lowest")
    )
