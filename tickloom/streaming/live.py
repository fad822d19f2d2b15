"""Streaming job: live candles that lose no trade, without watermark and without state.

A batch stores its trades, finds out which of them change anything, and rebuilds only the
candles they touch from the stored trades. Bitmaps of trade ids per day tell which days hold other
versions of a trade, so nothing else is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickloom.functions.bitmaps import holders, id_bitmaps, merge_bitmaps
from tickloom.functions.times import bucket_start, check_day_bucket, seconds_interval, seconds_of
from tickloom.operators.candles import CANDLE_INPUT, ohlcv
from tickloom.operators.dedup import CANDLE_KEY, TRADE_KEY, dedup_candles, latest_per_key, trade_order
from tickloom.operators.ingest import (
    accepted,
    conform_raw,
    in_future,
    parse_trades,
    quarantined,
    reject_reason,
    with_closed_days,
)
from tickloom.operators.placement import with_period_date
from tickloom.plans.changes import closed_before
from tickloom.schema import CANDLE, CANDLE_COLUMNS, RAW_TRADE, TRADE_IDS
from tickloom.sinks.tables import batch_name, with_batch, write_batch
from tickloom.sources.lake import read_days, read_table
from tickloom.streaming.ingest import AHEAD_SECONDS, start

LIVE_CANDLE = StructType(list(CANDLE.fields)).add("version", "long")
LIVE_TABLE = StructType(list(LIVE_CANDLE.fields)).add("period_date", "date").add("batch", "string")
LIVE_TRADE = StructType(list(RAW_TRADE.fields)).add("insert_date", "date").add("batch", "string")
LIVE_IDS = StructType(list(TRADE_IDS.fields)).add("insert_date", "date").add("batch", "string")


class LiveTables:
    """The tables of one stream: candles, the trades behind them, their ids, and what was refused."""

    def __init__(self, table: str, trades: str | None = None, quarantine: str | None = None):
        self.candles = table.rstrip("/")
        self.trades = trades or f"{self.candles}_trades"
        self.ids = f"{self.trades}_ids"
        self.quarantine = quarantine or f"{self.candles}_quarantine"


def _same_key(keys: DataFrame) -> tuple[DataFrame, Column]:
    """``keys`` (trade_id, symbol) renamed, and the null-safe condition that joins rows to them."""
    renamed = keys.select(*(F.col(c).alias(f"_{c}") for c in keys.columns))
    return renamed, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys.columns))


def _only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key columns are among ``keys``."""
    renamed, same = _same_key(keys)
    return rows.join(renamed, same, "left_semi")


def winners_of(old: DataFrame, mine: DataFrame) -> DataFrame:
    """The last version of every trade of a batch (``CANDLE_INPUT``), the time of the version it
    beats (``before``), and whether the batch changed it.

    ``old`` has the stored versions of the batch's trades.
    """
    order = trade_order(CANDLE_INPUT)
    rows = old.select(*CANDLE_INPUT, F.lit(False).alias("new")).unionByName(mine.select(*CANDLE_INPUT, F.lit(True).alias("new")))
    version = F.struct(*order)
    known = F.max(F.when(~F.col("new"), version))
    both = rows.groupBy(*TRADE_KEY).agg(known.alias("before"), F.max(version).alias("after"))
    changed = ~F.col("before").eqNullSafe(F.col("after"))
    return both.select(*TRADE_KEY, "after.*", F.col("before.trade_time").alias("before"), changed.alias("changed"))


def touched_candles(winners: DataFrame, bucket: str | int) -> DataFrame:
    """period_start and symbol of the candles a batch changes.

    A copy changes no winner and touches nothing; a newer version touches its own candle and
    that of the version it beats.
    """
    times = winners.where("changed").select("symbol", F.explode(F.array("before", "trade_time")).alias("time")).where("time IS NOT NULL")
    return times.select(bucket_start(F.col("time"), bucket).alias("period_start"), "symbol").distinct()


def _rebuilt(
    spark: SparkSession, tables: LiveTables, name: str, winners: DataFrame, touched: DataFrame, bucket: str | int, span
) -> DataFrame:
    """The touched candles from the batch's winners and all other trades; one without a trade left has the count 0.

    Every version of the batch's trades went into ``winners``, so only the trades it does not have are looked
    up in what other batches stored. ``span`` has the first and last period touched and the days they are in.
    """
    first, last, days = span["first"], span["last"], span["days"]
    start_of = bucket_start(F.col("trade_time"), bucket)
    end = F.lit(last) + seconds_interval(seconds_of(bucket))
    other = F.col("batch") != name
    near = read_days(spark, tables.trades, LIVE_TRADE, days).where(other & (F.col("trade_time") >= F.lit(first)) & (F.col("trade_time") < end))
    keys, same = _same_key(winners.select(*TRADE_KEY))
    inside = _only(near.withColumn("period_start", start_of), touched).join(keys, same, "left_anti").select(*CANDLE_INPUT).persist()
    try:
        index = read_table(spark, tables.ids, LIVE_IDS).where(other)
        elsewhere = {str(r[0]) for r in holders(index, id_bitmaps(inside), "insert_date").collect()}
        made = winners.select(*CANDLE_INPUT)
        if elsewhere:
            stored = read_days(spark, tables.trades, LIVE_TRADE, sorted(elsewhere | set(days))).where(other)
            versions = _only(stored, inside.select(*TRADE_KEY)).select(*CANDLE_INPUT)
            order = trade_order(CANDLE_INPUT)
            made = made.unionByName(latest_per_key(versions, TRADE_KEY, order[:1], order[1:]))
    finally:
        inside.unpersist()
    made = ohlcv(_only(made.withColumn("period_start", start_of), touched).drop("period_start"), bucket)
    renamed, same = _same_key(touched)
    whole = renamed.join(made, same, "left")
    nothing = F.coalesce("trades_count", F.lit(0).cast("int"))
    return whole.select(
        F.col("_period_start").alias("period_start"), F.col("_symbol").alias("symbol"), *CANDLE_COLUMNS[2:-1], nothing.alias("trades_count")
    )


def _found_days(column) -> Column:
    """The different days as texts, as many as a table has at most."""
    return F.sort_array(F.collect_set(column.cast("string")))


def _last_version(spark: SparkSession, table: str) -> int:
    return read_table(spark, table, LIVE_TABLE).agg(F.max("version")).first()[0] or 0


def live_candles(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    bucket: str | int = "minute",
    trades: str | None = None,
    quarantine: str | None = None,
    ahead_seconds: int = AHEAD_SECONDS,
) -> StreamingQuery:
    """Keep candles up to date while trades arrive, in whatever order and however late.

    Each batch appends its trades to ``trades``, adds their ids to the index beside them, and
    writes a new version of every candle it changed; a batch of known copies writes none. What a
    candle cannot be made of, and what belongs to a closed day, goes to ``quarantine`` with the
    reason. Versions are numbered by batch, so clocks play no part; a batch that is run again replaces all it wrote.
    """
    check_day_bucket(bucket)
    spark, tables = messages.sparkSession, LiveTables(table, trades, quarantine)
    base = _last_version(spark, tables.candles) + 1
    arrived = F.coalesce("timestamp", F.current_timestamp())
    parsed = parse_trades(messages.withColumn("arrived", arrived), keep=("value", "arrived"))
    reason = F.coalesce(reject_reason(), in_future(F.col("arrived"), ahead_seconds))
    checked = parsed.withColumn("reject_reason", reason).drop("arrived")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = batch_name(session, batch_id)
        named = with_batch(with_closed_days(batch, closed_before(session, tables.trades)), batch_id)
        # only what is refused is stored with its message
        named = named.withColumn("value", F.when(F.col("reject_reason").isNotNull(), F.col("value"))).persist()
        try:
            good = conform_raw(accepted(named).drop("value")).withColumn("insert_date", F.to_date("trade_time"))
            write_batch(good, tables.trades, ["insert_date", "batch"])
            write_batch(quarantined(named), tables.quarantine, ["batch"])
            days = good.agg(_found_days(F.col("insert_date")).alias("days")).first()["days"]
        finally:
            named.unpersist()
        if not days:
            return
        mine = read_days(session, tables.trades, LIVE_TRADE, days).where(F.col("batch") == name)
        write_batch(id_bitmaps(mine, "insert_date", "batch").hint("rebalance", "insert_date"), tables.ids, ["insert_date", "batch"])
        ids = read_days(session, tables.ids, LIVE_IDS, days).where(F.col("batch") == name)
        others = read_table(session, tables.ids, LIVE_IDS).where(F.col("batch") != name)
        known_days = sorted(str(r[0]) for r in holders(others, ids, "insert_date").collect())
        known = read_days(session, tables.trades, LIVE_TRADE, known_days).where(F.col("batch") != name)
        winners = winners_of(_only(known, mine.select(*TRADE_KEY)), mine).persist()
        touched = touched_candles(winners, bucket).persist()
        try:
            period = F.col("period_start")
            span = touched.agg(F.min(period).alias("first"), F.max(period).alias("last"), _found_days(F.to_date(period)).alias("days")).first()
            if span["days"]:
                made = with_period_date(_rebuilt(session, tables, name, winners, touched, bucket, span))
                rows = with_batch(made, batch_id).withColumn("version", F.lit(base + batch_id).cast("long"))
                write_batch(rows.hint("rebalance", "period_date"), tables.candles, ["period_date", "batch"])
        finally:
            touched.unpersist()
            winners.unpersist()

    return start(checked, write, checkpoint, every, "append")


def read_live_candles(spark: SparkSession, table: str) -> DataFrame:
    """The last version of every live candle that has a trade."""
    versions = read_table(spark, table, LIVE_TABLE)
    last = dedup_candles(versions, ["version", "batch"]).select(*CANDLE_COLUMNS)
    return last.where("trades_count > 0")


def merge_live_candles(versions: DataFrame) -> DataFrame:
    """One row per candle, still with its version: the merge for ``compact_days``."""
    return latest_per_key(versions, CANDLE_KEY, ["version"])


def merge_live_ids(index: DataFrame) -> DataFrame:
    """One bitmap per day, symbol and bucket: the merge for ``compact_days``."""
    return merge_bitmaps(index, "insert_date")
