"""Streaming jobs: load new lake files into the raw table (and archive them) or a warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.ingest import DAY_CLOSED, conform_raw
from tickloom.plans.changes import closed_before
from tickloom.schema import LAKE_TRADE
from tickloom.sinks.jdbc import MAX_CONNECTIONS, append_jdbc
from tickloom.sinks.tables import with_batch, write_batch
from tickloom.sources.bus import ANY_AGE


def _lake_files(
    spark: SparkSession, lake: str, max_files: int | None, archive: str | None = None
) -> DataFrame | None:
    """New files of the lake as a stream; None where there is no lake yet."""
    reader = spark.readStream.schema(LAKE_TRADE).option("recursiveFileLookup", "true")
    reader = reader.option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    try:
        return reader.parquet(lake)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_and_archive(
    spark: SparkSession,
    lake: str,
    raw: str,
    checkpoint: str,
    archive: str | None = None,
    max_files: int | None = None,
    keep_millis: bool = True,
    quarantine: str | None = None,
) -> StreamingQuery | None:
    """Load every lake file once, then stop. None where there is no lake yet.

    The checkpoint remembers which files were loaded, so load and move need not be one
    step: a file that was loaded but not yet moved is not loaded again, and one that
    arrives meanwhile waits for the next run. With ``archive`` the source moves consumed
    files there (below their full source path); the newest batch's files follow on the next
    run. ``lake`` may be a glob and must not lie above ``archive``. Trades of days that
    :func:`expire_days` has closed go to ``quarantine`` (by default a folder beside the raw table)
    with the reason: their candles stand, and one late trade must not replace them.
    """
    quarantine = quarantine or raw.rstrip("/") + "_quarantine"
    found = _lake_files(spark, lake, max_files, archive)
    if found is None:
        return None
    trades = conform_raw(found, keep_millis).withColumn("insert_date", F.to_date("trade_time"))

    def write(batch: DataFrame, batch_id: int) -> None:
        named, closed = with_batch(batch, batch_id), closed_before(batch.sparkSession, raw)
        if closed is not None:
            late = F.col("insert_date") < F.lit(closed)
            write_batch(named.where(late).withColumn("reject_reason", F.lit(DAY_CLOSED)), quarantine, ["batch"])
            named = named.where(~late | F.col("insert_date").isNull())
        write_batch(named, raw, ["insert_date", "batch"])

    return (
        trades.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_to_jdbc(
    spark: SparkSession,
    lake: str,
    url: str,
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    connections: int = MAX_CONNECTIONS,
    append: Callable[..., None] = append_jdbc,
    **options: str,
) -> StreamingQuery | None:
    """Append every lake file once to a warehouse table, then stop. None where there is no lake yet.

    The checkpoint remembers what was sent; ``load_id`` carries the batch number. A batch that
    dies midway is sent again whole under the same number, so a reader keeps one row per (trade, load_id) and
    the highest load of each trade.
    """
    found = _lake_files(spark, lake, max_files)
    if found is None:
        return None

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, url, table, batch_id, connections, **options)

    return (
        conform_raw(found).writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
