"""Batch jobs: merge the small files and versions of a day, drop expired days."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators.dedup import dedup_trades
from tickloom.operators.ingest import DAY_CLOSED
from tickloom.operators.retention import KEEP_DAYS
from tickloom.plans.changes import close_before, closed_before, files_of_days, log_merges
from tickloom.session import fitted_shuffles
from tickloom.sinks.tables import apply_staged, delete, exists, partition_values, stage, write_batch

MERGED = "merged"
GROUP_NAMES = 10_000  # batches merged by one job


def merge_trades(trades: DataFrame) -> DataFrame:
    """The last version of each trade within its day."""
    return dedup_trades(trades, within_day=True)


def compact_days(
    spark: SparkSession,
    path: str,
    staging: str,
    schema: StructType,
    before: date | None = None,
    by: str = "insert_date",
    merge: Callable[[DataFrame], DataFrame] = merge_trades,
    sort: list[str] | None = None,
) -> list[str]:
    """Merge all batches of each day (of the days ``before`` one) into sorted files.

    The table is laid out as ``by``/``batch``. Days are merged in groups, so the driver knows ``GROUP_NAMES``
    batches at a time or those of one day. Batches that arrive meanwhile are left alone: only those read here are dropped, and
    only after the merged rows are in place. Days that hold nothing but merged rows are skipped.
    What was put in place of what is logged, so that a refresh does not take it for new trades.
    Returns the days merged.
    """
    apply_staged(spark, staging, path, [by, "batch"], sort)
    done = []
    for found in _groups(spark, path, by, before):
        _compact(spark, path, staging, schema, found, by, merge, sort)
        done += found
    return done


def _groups(spark: SparkSession, path: str, by: str, before: date | None) -> Iterator[dict[str, list[str]]]:
    """Days with something to merge and their batches, ``GROUP_NAMES`` or one day's at a time."""
    found, names = {}, 0
    for day in partition_values(spark, path, by):
        if before is None or date.fromisoformat(day) < before:
            batches = partition_values(spark, f"{path}/{by}={day}", "batch")
            if batches in ([], [MERGED]):
                continue
            if found and names + len(batches) > GROUP_NAMES:
                yield found
                found, names = {}, 0
            found[day] = batches
            names += len(batches)
    if found:
        yield found


def _compact(spark, path, staging, schema, found, by, merge, sort) -> None:
    layout = [by, "batch"]
    # Name the folders to read; a filter on the table could take in a batch not listed here.
    folders = [f"{path}/{by}={day}/batch={b}" for day, batches in found.items() for b in batches]
    old = files_of_days(spark, folders, by)
    table = StructType([f for f in schema.fields if f.name != by]).add(by, "date")
    rows = spark.read.schema(table).option("basePath", path).parquet(*folders)
    merged = merge(rows).withColumn("batch", F.lit(MERGED))
    drop = [f"{by}={day}/batch={b}" for day, batches in found.items() for b in batches if b != MERGED]
    with fitted_shuffles(rows):
        stage(merged, staging, path, layout, drop)
    apply_staged(spark, staging, path, layout, sort)
    places = [f"{path}/{by}={day}/batch={MERGED}" for day in found]
    log_merges(spark, path, old, files_of_days(spark, [p for p in places if exists(spark, p)], by))


def expire_days(
    spark: SparkSession, path: str, as_of: datetime, days: int = KEEP_DAYS, by: str = "insert_date"
) -> list[str]:
    """Close and delete the days in which every row is older than the retention; return those deleted.

    The days are closed first, for good: what comes for them later goes to quarantine, and candles
    made of them are not replaced. Rows that got into a closed day all the same are kept in the
    quarantine beside the table.
    """
    start = as_of.replace(microsecond=0) - timedelta(days=days) + timedelta(seconds=1)
    closed = closed_before(spark, path)
    expired = [
        v for v in partition_values(spark, path, by) if date.fromisoformat(v) < start.date()
    ]
    if expired and (closed is None or closed < start.date()):
        close_before(spark, path, start.date())
    for value in expired:
        if closed is not None and date.fromisoformat(value) < closed:
            late = spark.read.parquet(f"{path}/{by}={value}").drop("batch")
            late = late.withColumns({"reject_reason": F.lit(DAY_CLOSED), "batch": F.lit(f"expired-{value}-{uuid.uuid4().hex}")})
            write_batch(late, f"{path.rstrip('/')}_quarantine", ["batch"])
        delete(spark, f"{path}/{by}={value}")
    return expired
