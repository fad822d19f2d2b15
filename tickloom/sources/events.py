"""An ``events`` table seen as exchange trades.

``events(event_id, ts, user_id, event_type, value, props)`` with ``props`` = ``{"k": n}``:
the event type stands for the symbol, the value for the price, ``n``/100 for the quantity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import seconds_interval
from tickloom.operators.ingest import conform_raw, encode_trades
from tickloom.schema import TRADE_COLUMNS


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _number() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def newest_trade_time(events: DataFrame) -> Column:
    """The newest trade time, fetched from one column, as a literal."""
    newest = F.unix_millis(F.max("ts").cast("timestamp"))
    return F.timestamp_millis(F.lit(events.agg(newest).first()[0]))


def recent(events: DataFrame, newest: Column, seconds: int) -> DataFrame:
    """Events of the last ``seconds`` before ``newest`` and one second more, by the stored column.

    The time a trade shows is computed from ``ts``, so a filter on it cannot reach the scan;
    this one can. It is meant to go before the exact filter: the spare second covers the
    cut to milliseconds and the retention's whole seconds.
    """
    start = newest - seconds_interval(seconds + 1)
    return events.where(F.col("ts") >= start.cast("timestamp_ntz"))


def trades_of(events: DataFrame) -> DataFrame:
    """Events as lake trades (doubles, Unix milliseconds)."""
    quantity = F.col("k").cast("double") / 100
    trade_time = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.withColumn("k", _number()).select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        quantity.alias("quantity"),
        (F.col("value") * quantity).alias("amount_usdt"),
        trade_time.alias("trade_time"),
        (trade_time + F.col("k")).alias("event_time"),
        (F.col("k") % 2 == 1).alias("is_buyer_maker"),
    )


def raw_trades_of(events: DataFrame) -> DataFrame:
    """Events as warehouse trades (decimals, timestamps)."""
    return conform_raw(trades_of(events))


def exchange_messages_of(events: DataFrame) -> DataFrame:
    """Events as raw exchange messages: one JSON text per trade, prices as strings."""
    trades = trades_of(events)
    return trades.select(
        F.to_json(
            F.struct(
                F.lit("trade").alias("e"),
                F.col("event_time").alias("E"),
                F.col("symbol").alias("s"),
                F.col("trade_id").alias("t"),
                F.col("price").cast("string").alias("p"),
                F.col("quantity").cast("string").alias("q"),
                F.col("trade_time").alias("T"),
                F.col("is_buyer_maker").alias("m"),
                F.lit(True).alias("M"),
            )
        ).alias("value")
    )


def faulty_exchange_messages_of(events: DataFrame) -> DataFrame:
    """Raw exchange messages of which some are damaged, by the last two digits of the id.

    0 and 50: no JSON; 1: no id; 2: an unreadable price (which alone does not disqualify a row); 3: a
    symbol longer than a candle can hold.
    """
    part = F.col("trade_id") % 100
    trades = trades_of(events)
    body = F.to_json(
        F.struct(
            F.lit("trade").alias("e"),
            F.col("event_time").alias("E"),
            F.when(part == 3, F.concat("symbol", F.repeat(F.lit("x"), 20))).otherwise(F.col("symbol")).alias("s"),
            F.when(part != 1, F.col("trade_id")).alias("t"),
            F.when(part == 2, "abc").otherwise(F.col("price").cast("string")).alias("p"),
            F.col("quantity").cast("string").alias("q"),
            F.col("trade_time").alias("T"),
            F.col("is_buyer_maker").alias("m"),
        )
    )
    return trades.select(F.when(part % 50 == 0, "nope").otherwise(body).alias("value"))


def messages_of(events: DataFrame) -> DataFrame:
    """Events as canonical bus records."""
    return encode_trades(trades_of(events))


def faulty_messages_of(events: DataFrame) -> DataFrame:
    """Bus records of which some are damaged, by the number each event carries.

    0: no JSON at all; 1: no id; 2: a text where the time should be; 3: an unreadable
    price (which alone does not disqualify a row); 4: a price beyond the warehouse type;
    5: a symbol longer than a candle can hold; 6: JSON cut short; 7: id as ``"n.7"``.
    """
    k = F.col("k")
    damaged = trades_of(events).withColumn("k", F.round(F.col("quantity") * 100).cast("int"))
    fields = {
        "trade_id": F.when(k == 7, F.concat(F.col("trade_id").cast("string"), F.lit(".7")))
        .when(k != 1, F.col("trade_id").cast("string")),
        "symbol": F.when(k == 5, F.concat(F.col("symbol"), F.repeat(F.lit("x"), 20)))
        .otherwise(F.col("symbol")),
        "price": F.when(k == 3, "abc").when(k == 4, "1e15").otherwise(F.col("price").cast("string")),
        "trade_time": F.when(k == 2, "soon").otherwise(F.col("trade_time").cast("string")),
    }
    body = F.to_json(F.struct(*(fields.get(c, F.col(c)).alias(c) for c in TRADE_COLUMNS)))
    value = (
        F.when(k == 0, "nope").when(k == 6, F.substr(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    )
    return damaged.select(F.col("trade_id").alias("source_id"), value.cast("binary").alias("value"))
