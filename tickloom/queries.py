"""Every operator as a query over the driver's tables: ``name -> f(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import (
    bucket_start,
    epoch_ms_to_timestamp,
    epoch_ms_to_timestamp_seconds,
)
from tickloom.operators import analytics, candles, dedup, ingest, placement
from tickloom.operators.retention import KEEP_DAYS, retain
from tickloom.plans import publish
from tickloom.plans.mart import mart_cutoff, read_mart, refresh_mart
from tickloom.plans.upkeep import compact_days
from tickloom.schema import LAKE_TRADE, RAW_TRADE, TRADE_COLUMNS
from tickloom.session import configure, scratch_path
from tickloom.sinks.tables import write_partitions
from tickloom.sources import events as ev
from tickloom.sources.bus import file_stream, text_stream
from tickloom.sources.lake import read_lake, read_table
from tickloom.streaming.archive import load_and_archive
from tickloom.streaming.ingest import ingest_realtime, ingest_to_lake, normalize_to_lake, read_realtime
from tickloom.streaming.live import LiveTables, live_candles, read_live_candles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WHALE_USDT = 100
SLICES = 3
FAR_AHEAD_MS = 200_000_000_000_000


def query(f: Query) -> Query:
    """Register ``f``; its result shows UTC wall-clock times."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return wall_clock(f(configure(spark), folder))

    QUERIES[f.__name__] = run
    return f


def wall_clock(rows: DataFrame) -> DataFrame:
    times = [f.name for f in rows.schema if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return ev.read_events(spark, folder)


def _trades(spark: SparkSession, folder: str) -> DataFrame:
    return ev.trades_of(_events(spark, folder))


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return ev.raw_trades_of(_events(spark, folder))


def _recent_raw(spark: SparkSession, folder: str, seconds: int) -> tuple[DataFrame, Column]:
    """Trades of about the last ``seconds``, and the newest trade's time."""
    events = _events(spark, folder)
    newest = ev.newest_trade_time(events)
    return ev.raw_trades_of(ev.recent(events, newest, seconds)), newest


def _candles(spark: SparkSession, folder: str, bucket: str = "minute") -> DataFrame:
    return candles.ohlcv(_raw(spark, folder), bucket)


# Parsing and projection


@query
def normalize_raw_trades(spark, folder):
    return ingest.normalize_raw_trades(ev.exchange_messages_of(_events(spark, folder)))


@query
def encode_trades(spark, folder):
    sent = ingest.encode_trades(_trades(spark, folder))
    row = F.from_json(F.col("value").cast("string"), LAKE_TRADE)
    return sent.select(F.col("key").cast("string"), "topic", row.alias("row")).select(
        "key", "topic", "row.*"
    )


@query
def parse_trades(spark, folder):
    return ingest.parse_trades(ev.messages_of(_events(spark, folder)))


@query
def parse_trades_struct(spark, folder):
    return ingest.parse_trades_struct(ev.messages_of(_events(spark, folder)))


@query
def parse_faulty_trades(spark, folder):
    return ingest.parse_trades(ev.faulty_messages_of(_events(spark, folder)), keep=("source_id",))


def _checked(spark, folder):
    faulty = ev.faulty_messages_of(_events(spark, folder))
    return ingest.check_trades(ingest.parse_trades(faulty, keep=("source_id",)))


@query
def quarantine_trades(spark, folder):
    return ingest.quarantined(_checked(spark, folder)).select("source_id", "reject_reason")


@query
def accepted_trades(spark, folder):
    return ingest.accepted(_checked(spark, folder)).drop("source_id")


@query
def taker_side(spark, folder):
    return ingest.with_taker_side(_trades(spark, folder)).select("trade_id", "side")


@query
def trade_tape(spark, folder):
    return ingest.trade_tape(_trades(spark, folder))


@query
def epoch_to_ts(spark, folder):
    return _trades(spark, folder).select(
        "trade_id",
        *(epoch_ms_to_timestamp(F.col(c)).alias(c) for c in ("trade_time", "event_time")),
    )


@query
def epoch_to_ts_seconds(spark, folder):
    return _trades(spark, folder).select(
        "trade_id",
        *(epoch_ms_to_timestamp_seconds(F.col(c)).alias(c) for c in ("trade_time", "event_time")),
    )


@query
def lake_scan(spark, folder):
    """A lake of two writers: files in its root, and files in batch folders."""
    lake, trades = scratch_path(spark, "lake"), _trades(spark, folder)
    odd = F.col("trade_id") % 2 == 1
    trades.where(odd).write.parquet(lake)
    trades.where(~odd).withColumn("batch", F.lit("b0")).write.mode("append").partitionBy("batch").parquet(lake)
    return read_lake(spark, lake)


@query
def raw_trades(spark, folder):
    return _raw(spark, folder)


@query
def raw_trades_seconds(spark, folder):
    return ingest.conform_raw(_trades(spark, folder), keep_millis=False)


@query
def rt_trades(spark, folder):
    return ingest.realtime_trades(_trades(spark, folder))


@query
def retain_3d(spark, folder):
    events = _events(spark, folder)
    newest = ev.newest_trade_time(events)
    recent = ev.recent(events, newest, KEEP_DAYS * analytics.DAY)
    return retain(ingest.realtime_trades(ev.trades_of(recent)), newest)


# One row per key


def _with_replays(trades: DataFrame) -> DataFrame:
    """Every trade twice, and a newer version of those the buyer made."""
    newer = trades.where("is_buyer_maker").withColumns(
        {
            "trade_time": F.col("trade_time") + F.expr("interval 1 second"),
            "quantity": (F.col("quantity") + 1).cast("decimal(20,8)"),
        }
    )
    return trades.unionByName(trades).unionByName(newer)


@query
def dedup_trades(spark, folder):
    return dedup.dedup_trades(_with_replays(_raw(spark, folder)))


@query
def dedup_trades_by_day(spark, folder):
    dated = _with_replays(_raw(spark, folder)).withColumn("insert_date", F.to_date("trade_time"))
    return dedup.dedup_trades(dated, within_day=True)


@query
def dedup_lineitem(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return dedup.latest_per_key(
        lines,
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate"],
        ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    )


@query
def dedup_candles(spark, folder):
    raw = _raw(spark, folder)
    first = candles.ohlcv(raw).withColumn("load_id", F.lit(1))
    second = candles.ohlcv(raw.where("is_buyer_maker")).withColumn("load_id", F.lit(2))
    return dedup.dedup_candles(first.unionByName(second))


# Candles


@query
def ohlcv_1m(spark, folder):
    return _candles(spark, folder, "minute")


@query
def ohlcv_1h(spark, folder):
    return _candles(spark, folder, "hour")


@query
def ohlcv_1d(spark, folder):
    return _candles(spark, folder, "day")


@query
def rollup_candles(spark, folder):
    return candles.rollup_candles(_candles(spark, folder), "hour")


def _first_load(raw: DataFrame):
    """Condition for trades of a first load that ends two hours early, one symbol a day early."""
    newest = raw.agg(F.max("trade_time")).scalar()
    lag = F.when(F.col("symbol") == "error", F.expr("interval 24 hours"))
    return F.col("trade_time") < newest - lag.otherwise(F.expr("interval 2 hours"))


@query
def refresh_cutoff(spark, folder):
    raw = _raw(spark, folder)
    mart = scratch_path(spark, "mart")
    first = placement.with_period_date(candles.ohlcv(raw.where(_first_load(raw))))
    write_partitions(first, mart, ["period_date"])
    return spark.createDataFrame([(mart_cutoff(spark, mart),)], "cutoff timestamp")


def _refreshed(spark: SparkSession, loads: list[DataFrame], late: bool = True) -> DataFrame:
    """The mart after some loads of raw trades, a refresh after each, and one more that must change nothing."""
    table, mart, staging = (scratch_path(spark, n) for n in ("raw", "mart", "staging"))
    for load in loads:
        dated = load.withColumn("insert_date", F.to_date("trade_time"))
        dated.write.mode("append").partitionBy("insert_date").parquet(table)
        refresh_mart(spark, table, mart, staging, late=late)
    refresh_mart(spark, table, mart, staging, late=late)
    return read_mart(spark, mart).drop("period_date")


def _two_loads(raw: DataFrame) -> list[DataFrame]:
    early = F.coalesce(_first_load(raw), F.lit(False))
    return [raw.where(early), raw.where(~early)]


@query
def refresh_candles(spark, folder):
    """Two loads; one symbol of the second is a day behind, and nothing of it is lost."""
    return _refreshed(spark, _two_loads(_raw(spark, folder)))


@query
def refresh_candles_tail(spark, folder):
    """The same loads, only the tail rebuilt: what is more than an hour behind the newest candle is left out."""
    return _refreshed(spark, _two_loads(_raw(spark, folder)), late=False)


@query
def refresh_candles_late(spark, folder):
    """Some trades first come with a time two days early and another price; the true version, a load
    later, must empty the old candle as well as fill its own."""
    raw = _raw(spark, folder)
    first, second = _two_loads(raw)
    wrong = raw.where("trade_id % 50 = 7").withColumns(
        {
            "trade_time": F.col("trade_time") - F.expr("interval 2 days"),
            "price": (F.col("price") + 1).cast("decimal(20,8)"),
        }
    )
    return _refreshed(spark, [first.where("trade_id % 50 <> 7").unionByName(wrong), second, raw.where("trade_id % 50 = 7")])


@query
def publish_candles(spark, folder):
    mart, serving = scratch_path(spark, "mart"), scratch_path(spark, "serving")
    write_partitions(
        placement.with_period_date(_candles(spark, folder)), mart, ["period_date"]
    )
    publish.publish_candles(spark, mart, serving)
    return publish.read_serving(spark, serving)


# Dashboards


@query
def current_price(spark, folder):
    return analytics.current_price(_raw(spark, folder))


@query
def volume_last_hour(spark, folder):
    recent, newest = _recent_raw(spark, folder, 3600)
    return analytics.volume_by_bucket(recent, as_of=newest)


@query
def whale_trades(spark, folder):
    return analytics.whale_trades(_raw(spark, folder), WHALE_USDT)


@query
def market_pressure(spark, folder):
    return _rounded(analytics.market_pressure(_raw(spark, folder)), "imbalance")


@query
def market_pressure_24h(spark, folder):
    recent, newest = _recent_raw(spark, folder, analytics.DAY)
    pressure = analytics.market_pressure(recent, analytics.DAY, newest)
    return _rounded(pressure, "imbalance")


@query
def candle_spread(spark, folder):
    return _rounded(analytics.candle_spread(_candles(spark, folder)), "spread", "spread_ratio")


def _stats(spark, folder, seconds):
    # A minute more than asked for, as the window ends with the newest candle's start.
    raw, newest = _recent_raw(spark, folder, seconds + 60)
    recent = analytics.candle_stats(candles.ohlcv(raw), seconds, bucket_start(newest, "minute"))
    return _rounded(recent, "change_pct")


@query
def stats_24h(spark, folder):
    return _stats(spark, folder, analytics.DAY)


@query
def stats_7d(spark, folder):
    return _stats(spark, folder, 7 * analytics.DAY)


@query
def rolling_24h(spark, folder):
    return analytics.rolling_stats(_candles(spark, folder))


def _rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.round(c, 9) for c in columns})


# Streams: the table is sent as bus records in slices of time, each drained on its own


def _slices(spark, folder):
    events = _events(spark, folder)
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    width = (last - first) / SLICES
    for n in range(SLICES):
        part = events if n == 0 else events.where(F.col("ts") >= first + n * width)
        yield part if n == SLICES - 1 else part.where(F.col("ts") < first + (n + 1) * width)


def _send(messages: DataFrame, bus: str) -> None:
    messages.select(
        F.col("key") if "key" in messages.columns else F.lit(None).cast("binary").alias("key"),
        "value",
        F.lit("trades").alias("topic"),
        F.spark_partition_id().alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    ).write.mode("append").parquet(bus)


def _drained(spark, folder, start, encode=ev.messages_of, copies=1):
    """Send each slice (``copies`` times), and run ``start`` on what has arrived."""
    bus = scratch_path(spark, "bus")
    for part in _slices(spark, folder):
        for _ in range(copies):
            _send(encode(part), bus)
        start(file_stream(spark, bus)).awaitTermination()


def _drain_to_lake(spark, folder, encode):
    lake, bad, state = (scratch_path(spark, n) for n in ("lake", "quarantine", "checkpoint"))
    _drained(spark, folder, lambda m: ingest_to_lake(m, lake, bad, state), encode)
    return lake, bad


@query
def stream_lake(spark, folder):
    lake, _ = _drain_to_lake(spark, folder, ev.faulty_messages_of)
    return read_lake(spark, lake)


@query
def stream_normalized(spark, folder):
    """Raw exchange messages, some damaged, through the lake and its quarantine; a second run finds nothing new."""
    texts, lake, bad, state = (scratch_path(spark, n) for n in ("texts", "lake", "quarantine", "checkpoint"))
    ev.faulty_exchange_messages_of(_events(spark, folder)).write.text(texts)
    for _ in range(2):
        normalize_to_lake(text_stream(spark, texts, 1), lake, bad, state).awaitTermination()
    rejected = spark.read.parquet(bad).select(*TRADE_COLUMNS, "reject_reason")
    return read_lake(spark, lake).withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected)


@query
def stream_quarantine(spark, folder):
    _, bad = _drain_to_lake(spark, folder, ev.faulty_messages_of)
    return spark.read.parquet(bad).select(*TRADE_COLUMNS, "reject_reason")


@query
def stream_rt_trades(spark, folder):
    table, state = scratch_path(spark, "rt"), scratch_path(spark, "checkpoint")
    _drained(spark, folder, lambda m: ingest_realtime(m, table, state), copies=2)
    return read_realtime(spark, table)


def _hard_messages(events: DataFrame) -> DataFrame:
    """Trades as messages, some with a clock far ahead, some with numbers and names that a
    warehouse could not hold."""
    trades = ev.trades_of(events)
    ahead = trades.where("trade_id % 100 = 1").withColumns(
        {"trade_id": F.col("trade_id") + 10_000_000, "trade_time": F.col("trade_time") + FAR_AHEAD_MS}
    )
    large = trades.where("trade_id % 100 = 2").withColumns(
        {"trade_id": F.col("trade_id") + 20_000_000, "symbol": F.repeat("symbol", F.lit(10)), "price": F.lit(1e15)}
    )
    return ingest.encode_trades(trades.unionByName(ahead).unionByName(large))


@query
def stream_rt_hard(spark, folder):
    """The newest days are sent first, every message twice; those far ahead are in quarantine."""
    table, bad, state = (scratch_path(spark, n) for n in ("rt", "quarantine", "checkpoint"))
    bus = scratch_path(spark, "bus")
    for part in reversed(list(_slices(spark, folder))):
        for _ in range(2):
            _send(_hard_messages(part), bus)
        ingest_realtime(file_stream(spark, bus), table, state, quarantine=bad).awaitTermination()
    good = read_realtime(spark, table).select("trade_id", "symbol", "price", "trade_time").withColumn("reason", F.lit(None).cast("string"))
    rejected = spark.read.parquet(bad).select("trade_id", "symbol", "price", F.timestamp_millis("trade_time").alias("trade_time"), F.col("reject_reason").alias("reason"))
    return good.unionByName(rejected.distinct())


@query
def stream_live_candles(spark, folder):
    table, state = scratch_path(spark, "live"), scratch_path(spark, "checkpoint")
    _drained(spark, folder, lambda m: live_candles(m, table, state), copies=2)
    return read_live_candles(spark, table)


def _out_of_order(events: DataFrame, first: bool) -> DataFrame:
    """A slice's messages: first some trades with an early wrong version and some with a clock far
    ahead, later the true versions."""
    trades = ev.trades_of(events)
    if not first:
        return ingest.encode_trades(trades.where("trade_id % 100 = 3"))
    wrong = trades.where("trade_id % 100 = 3").withColumns(
        {"trade_time": F.col("trade_time") - 90_000_000, "price": F.col("price") * 2}
    )
    ahead = trades.where("trade_id % 100 = 1").withColumns(
        {"trade_id": F.col("trade_id") + 10_000_000, "trade_time": F.col("trade_time") + FAR_AHEAD_MS}
    )
    return ingest.encode_trades(trades.where("trade_id % 100 <> 3").unionByName(wrong).unionByName(ahead))


@query
def stream_live_late(spark, folder):
    """The newest days are sent first, every message twice, some in a wrong version that is put right
    at the end; those far ahead are in quarantine."""
    tables, state, bus = LiveTables(scratch_path(spark, "live")), scratch_path(spark, "checkpoint"), scratch_path(spark, "bus")
    slices = list(reversed(list(_slices(spark, folder))))
    for first in (True, False):
        for part in slices:
            for _ in range(2):
                _send(_out_of_order(part, first), bus)
            live_candles(file_stream(spark, bus), tables.candles, state).awaitTermination()
    shown = read_live_candles(spark, tables.candles).withColumn("reason", F.lit(None).cast("string"))
    rejected = spark.read.parquet(tables.quarantine).select(
        F.timestamp_millis("trade_time").alias("period_start"), "symbol", F.col("price").alias("open_price"), F.col("reject_reason").alias("reason")
    )
    return shown.unionByName(rejected.distinct(), allowMissingColumns=True)


def _drain_to_raw(spark, folder):
    """Bus to lake to raw table; loaded lake files are moved to the archive on the way."""
    lake, bad, raw, archive = (
        scratch_path(spark, n) for n in ("lake", "quarantine", "raw", "archive")
    )
    to_lake, to_raw = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")

    def step(messages):
        ingest_to_lake(messages, lake, bad, to_lake).awaitTermination()
        return load_and_archive(spark, lake, raw, to_raw, archive)

    _drained(spark, folder, step)
    return raw


@query
def stream_archive_load(spark, folder):
    return spark.read.parquet(_drain_to_raw(spark, folder)).select(*TRADE_COLUMNS)


@query
def compact_raw(spark, folder):
    raw = _drain_to_raw(spark, folder)
    compact_days(spark, raw, scratch_path(spark, "staging"), RAW_TRADE, sort=["symbol", "trade_id"])
    return spark.read.parquet(raw).select(*TRADE_COLUMNS, "batch")
