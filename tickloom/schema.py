"""Table shapes shared by the batch and the streaming jobs."""

from pyspark.sql import types as T

# One trade as it travels on the message bus and rests in the lake (times in Unix ms).
LAKE_TRADE = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("amount_usdt", T.DoubleType()),
        T.StructField("trade_time", T.LongType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)

TRADE_COLUMNS = LAKE_TRADE.fieldNames()

MONEY = T.DecimalType(20, 8)
MONEY_COLUMNS = ["price", "quantity", "amount_usdt"]
TIME_COLUMNS = ["trade_time", "event_time"]

# One trade in the warehouse: exact decimals, real timestamps.
RAW_TRADE = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", MONEY),
        T.StructField("amount_usdt", MONEY),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)

# The real-time table keeps doubles and millisecond timestamps; insert_date partitions it.
REALTIME_TRADE = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("amount_usdt", T.DoubleType()),
        T.StructField("trade_time", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)

CANDLE = T.StructType(
    [
        T.StructField("period_start", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("open_price", T.DoubleType()),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        T.StructField("close_price", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("total_amount_usdt", T.DoubleType()),
        T.StructField("trades_count", T.IntegerType()),
    ]
)

CANDLE_COLUMNS = CANDLE.fieldNames()

# A message-bus record, with the columns a Kafka source delivers.
BUS_MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Bitmaps of trade ids (see functions/bitmaps.py), partitioned by the day of the trades.
TRADE_IDS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)

# Width the warehouse declares for the symbol of a candle.
CANDLE_SYMBOL_WIDTH = 20
