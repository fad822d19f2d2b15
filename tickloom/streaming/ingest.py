"""Streaming jobs: bus or raw exchange messages to lake, bus to real-time table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.dedup import dedup_trades
from tickloom.operators.ingest import (
    accepted,
    check_trades,
    normalize_raw_trades,
    parse_trades,
    quarantined,
    realtime_reject_reason,
    realtime_trades,
    with_closed_days,
)
from tickloom.plans.changes import closed_before
from tickloom.schema import REALTIME_TRADE
from tickloom.sinks.tables import with_batch, write_batch
from tickloom.sources.lake import partitioned, read_table

AHEAD_SECONDS = 86_400


def start(stream: DataFrame, write, checkpoint: str, every: str | None, mode: str) -> StreamingQuery:
    """Drain what is there and stop, or go on with a fixed pause if ``every`` is given."""
    writer = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_to_lake(
    messages: DataFrame,
    lake: str,
    quarantine: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Parse bus records and append them to the lake, each exactly once.

    Rows the warehouse cannot use go to ``quarantine`` with their original message and
    the reason. A batch is written in the tasks that read it, under its own ``batch=``
    folder; replaying it after a crash replaces that folder.
    """
    return _to_lake(check_trades(parse_trades(messages, keep=("value",))), lake, quarantine, checkpoint, every)


def normalize_to_lake(
    messages: DataFrame,
    lake: str,
    quarantine: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """The same for raw exchange messages (``value``, JSON with the exchange's short keys)."""
    checked = check_trades(normalize_raw_trades(messages, keep=("value",)))
    return _to_lake(checked, lake, quarantine, checkpoint, every)


def _to_lake(checked: DataFrame, lake: str, quarantine: str, checkpoint: str, every: str | None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = with_batch(batch, batch_id).persist()
        try:
            write_batch(accepted(batch).drop("value"), lake, ["batch"])
            write_batch(quarantined(batch), quarantine, ["batch"])
        finally:
            batch.unpersist()

    return start(checked, write, checkpoint, every, "append")


def ingest_realtime(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = None,
    quarantine: str | None = None,
    ahead_seconds: int = AHEAD_SECONDS,
) -> StreamingQuery:
    """Continuous projection of bus records into the real-time table, without state.

    Every trade with an id and a possible time is appended, however late it is; copies and older
    versions are resolved by :func:`read_realtime` and by compaction. All others go to
    ``quarantine`` (by default a folder beside the table) with their message and the reason, so
    a wrong clock harms no other trade. Trades of days that :func:`expire_days` has closed go there too.
    """
    quarantine = quarantine or table.rstrip("/") + "_quarantine"
    arrived = F.coalesce("timestamp", F.current_timestamp())
    parsed = parse_trades(messages.withColumn("arrived", arrived), keep=("value", "arrived"))
    reason = realtime_reject_reason(F.col("arrived"), ahead_seconds)
    checked = parsed.withColumn("reject_reason", reason).drop("arrived")

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = closed_before(batch.sparkSession, table)
        batch = with_batch(with_closed_days(batch, closed), batch_id).persist()
        try:
            good = realtime_trades(accepted(batch).drop("value"))
            write_batch(good, table, ["insert_date", "batch"])
            write_batch(quarantined(batch), quarantine, ["batch"])
        finally:
            batch.unpersist()

    return start(checked, write, checkpoint, every, "append")


def read_realtime(spark: SparkSession, table: str) -> DataFrame:
    """The real-time trades, with only the last version of each."""
    return dedup_trades(read_table(spark, table, partitioned(REALTIME_TRADE, "insert_date")))
