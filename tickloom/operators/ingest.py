"""Message parsing, normalisation and validation. Same functions for tables and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.casts import fits_money, lenient_boolean, lenient_double, lenient_long
from tickloom.functions.text import float_text
from tickloom.functions.times import (
    epoch_ms_to_timestamp,
    epoch_ms_to_timestamp_seconds,
    is_calendar_ms,
)
from tickloom.schema import (
    CANDLE_SYMBOL_WIDTH,
    LAKE_TRADE,
    MONEY,
    MONEY_COLUMNS,
    TIME_COLUMNS,
    TRADE_COLUMNS,
)

# Keys of the raw exchange message and the labels of the trade tape.
EXCHANGE_KEYS = ["t", "s", "p", "q", "T", "E", "m"]
TAPE_SELL = "SELL 🔴"
TAPE_BUY = "BUY 🟢"

DAY_CLOSED = "day_closed"

_READERS = {"bigint": lenient_long, "double": lenient_double, "boolean": lenient_boolean}


def normalize_raw_trades(
    messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Raw exchange JSON (``t s p q T E m``, prices as text) to the eight trade columns.

    ``json_tuple`` reads all keys in one parse and tells ``t`` from ``T`` whatever the
    session's case sensitivity. ``keep`` names message columns to carry along.
    """
    keys = F.json_tuple(F.col(value).cast("string"), *EXCHANGE_KEYS)
    raw = messages.select(*keep, keys.alias("id", "sym", "price", "qty", "traded", "sent", "maker"))
    price, quantity = lenient_double(F.col("price")), lenient_double(F.col("qty"))
    return raw.select(
        *keep,
        lenient_long(F.col("id")).alias("trade_id"),
        F.col("sym").alias("symbol"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).alias("amount_usdt"),
        lenient_long(F.col("traded")).alias("trade_time"),
        lenient_long(F.col("sent")).alias("event_time"),
        lenient_boolean(F.col("maker")).alias("is_buyer_maker"),
    )


def encode_trades(trades: DataFrame, topic: str = "trades") -> DataFrame:
    """Trades to bus records: JSON in UTF-8 as ``value``. No key, so that the bus spreads one busy
    symbol over all its partitions."""
    body = F.to_json(F.struct(*TRADE_COLUMNS), {"ignoreNullFields": "false"})
    return trades.select(
        F.lit(None).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def parse_trades(
    messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Bus records to typed trades, field by field: a bad field is NULL, the row stays.

    One JSON parse per message. ``keep`` names message columns to carry along.
    """
    fields = F.json_tuple(F.col(value).cast("string"), *TRADE_COLUMNS)
    texts = messages.select(*keep, fields.alias(*(f"{c}_text" for c in TRADE_COLUMNS)))
    typed = [
        _READERS.get(f.dataType.simpleString(), lambda c: c)(F.col(f"{f.name}_text")).alias(f.name)
        for f in LAKE_TRADE
    ]
    return texts.select(*keep, *typed)


def parse_trades_struct(messages: DataFrame, value: str = "value") -> DataFrame:
    """Bus records to typed trades by one declared row type (strict JSON types)."""
    row = F.from_json(F.col(value).cast("string"), LAKE_TRADE, {"mode": "PERMISSIVE"})
    return messages.select(row.alias("row")).select("row.*")


def taker_side(is_buyer_maker: Column) -> Column:
    """SELL when the buyer was the maker, else BUY (also when unknown)."""
    return F.when(is_buyer_maker, "SELL").otherwise("BUY")


def with_taker_side(trades: DataFrame) -> DataFrame:
    return trades.withColumn("side", taker_side(F.col("is_buyer_maker")))


def trade_tape(trades: DataFrame) -> DataFrame:
    """One line of text per trade."""
    line = F.concat_ws(
        " | ",
        F.when(F.col("is_buyer_maker"), TAPE_SELL).otherwise(TAPE_BUY),
        F.concat(F.lit("P: "), float_text(F.col("price"))),
        F.concat(F.lit("Q: "), float_text(F.col("quantity"))),
        F.concat(F.lit("Time: "), F.col("trade_time").cast("string")),
    )
    return trades.select("trade_id", line.alias("line"))


def reject_reason() -> Column:
    """Why the warehouse cannot use a parsed trade; NULL for a good one."""
    bad_number = ~(
        fits_money(F.col("price")) & fits_money(F.col("quantity")) & fits_money(F.col("amount_usdt"))
    )
    return (
        F.when(F.col("trade_id").isNull(), "no_trade_id")
        .when(F.col("trade_time").isNull(), "no_trade_time")
        .when(~is_calendar_ms(F.col("trade_time")), "time_out_of_range")
        .when(~is_calendar_ms(F.col("event_time")), "time_out_of_range")
        .when(bad_number, "number_out_of_range")
        .when(F.length("symbol") > CANDLE_SYMBOL_WIDTH, "symbol_too_long")
    )


def realtime_reject_reason(arrived: Column, ahead_seconds: int) -> Column:
    """Why the real-time table cannot show a parsed trade; NULL for a good one.

    That table holds doubles and text of any length, so only an id and a possible time are asked
    for. A time more than ``ahead_seconds`` after the message's arrival comes from a wrong clock.
    """
    impossible = (
        F.when(F.col("trade_id").isNull(), "no_trade_id")
        .when(F.col("trade_time").isNull(), "no_trade_time")
        .when(~is_calendar_ms(F.col("trade_time")), "time_out_of_range")
        .when(~is_calendar_ms(F.col("event_time")), "time_out_of_range")
    )
    return F.coalesce(impossible, in_future(arrived, ahead_seconds))


def in_future(arrived: Column, ahead_seconds: int) -> Column:
    """The reason for a trade time too far after the message's arrival, else NULL."""
    latest = F.unix_millis(arrived) + ahead_seconds * 1000
    return F.when(F.col("trade_time") > latest, "time_in_future")


def with_closed_days(checked: DataFrame, closed: date | None, time: Column | None = None) -> DataFrame:
    """Checked trades, those of days before ``closed`` with the reason for being too late."""
    if closed is None:
        return checked
    time = F.timestamp_millis("trade_time") if time is None else time
    late = F.when(F.to_date(time) < F.lit(closed), DAY_CLOSED)
    return checked.withColumn("reject_reason", F.coalesce("reject_reason", late))


def check_trades(trades: DataFrame) -> DataFrame:
    """Add ``reject_reason``, NULL for rows that may go on."""
    return trades.withColumn("reject_reason", reject_reason())


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reject_reason").isNotNull())


def conform_raw(trades: DataFrame, keep_millis: bool = True) -> DataFrame:
    """Lake trades to warehouse types: exact decimals, timestamps.

    ``keep_millis=False`` cuts times to whole seconds, as the older warehouse load did.
    A number beyond decimal(20,8) fails the job; :func:`check_trades` finds it earlier.
    """
    to_time = epoch_ms_to_timestamp if keep_millis else epoch_ms_to_timestamp_seconds
    changed = {c: F.col(c).cast(MONEY) for c in MONEY_COLUMNS}
    return trades.withColumns(changed | {c: to_time(F.col(c)) for c in TIME_COLUMNS})


def realtime_trades(trades: DataFrame) -> DataFrame:
    """Lake trades to the real-time table: millisecond timestamps and the partition day."""
    times = {c: epoch_ms_to_timestamp(F.col(c)) for c in TIME_COLUMNS}
    return trades.withColumns(times).withColumn("insert_date", F.to_date("trade_time"))
