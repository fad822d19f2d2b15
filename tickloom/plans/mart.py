"""Batch job: bring the candle mart up to date with the raw trades."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.bitmaps import ID_KEY, holders, id_bitmaps
from tickloom.functions.times import check_day_bucket
from tickloom.operators.candles import CANDLE_INPUT, REBUILD_TAIL_SECONDS, candles_from, ohlcv
from tickloom.operators.dedup import dedup_trades
from tickloom.operators.placement import with_period_date
from tickloom.plans.changes import closed_before, day_contents, read_contents, write_contents
from tickloom.schema import CANDLE, CANDLE_COLUMNS, RAW_TRADE, TRADE_IDS
from tickloom.session import fitted_shuffles, scratch_path
from tickloom.sinks.tables import apply_staged, delete, partition_values, stage, write_partitions
from tickloom.sources.lake import partitioned, read_days, read_table

MART_BY = ["period_date"]
MART_SORT = ["symbol", "period_start"]
FOLDED = "_FOLDED"  # the content of each raw day that the mart's candles were made of
IDS = "_IDS"  # the trade ids of each of those days, as bitmaps
PUBLISHED = "_PUBLISHED"  # names the serving table that has the whole mart; a refresh removes it
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, partitioned(RAW_TRADE, "insert_date"))


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, partitioned(CANDLE, "period_date"))


def _newest_before(mart: DataFrame, days: list[str], limit: datetime | None) -> datetime | None:
    """Newest candle time below ``limit``, looking at the youngest partitions first.

    Reads one or two days of one column, not the mart.
    """
    for day in reversed(days):
        if limit is not None and date.fromisoformat(day) > limit.date():
            continue
        rows = mart.where(F.col("period_date") == F.lit(day).cast("date"))
        if limit is not None:
            rows = rows.where(F.col("period_start") < F.lit(limit))
        micros = rows.agg(F.unix_micros(F.max("period_start"))).first()[0]
        if micros is not None:
            return EPOCH + timedelta(microseconds=micros)
    return None


def mart_cutoff(
    spark: SparkSession, path: str, tail_seconds: int = REBUILD_TAIL_SECONDS
) -> datetime:
    """Where to rebuild from: the newest candle left when the tail is cut off, or 1970."""
    days = partition_values(spark, path, "period_date")
    if not days:
        return EPOCH
    mart = read_mart(spark, path)
    newest = _newest_before(mart, days, None)
    if newest is None:
        return EPOCH
    tail = newest - timedelta(seconds=tail_seconds)
    return _newest_before(mart, days, tail) or EPOCH


def _on_days(rows: DataFrame, column: str, days: list[str]) -> DataFrame:
    return rows.where(F.col(column).isin([date.fromisoformat(d) for d in days]))


@dataclass
class Work:
    """What a refresh has to do: days whose content is new, days to rebuild, days to read for that."""

    contents: dict[str, int]
    changed: list[str]
    rebuild: list[str]
    read: list[str]
    ids: DataFrame | None = None


def _index(spark: SparkSession, mart_path: str) -> DataFrame:
    return read_table(spark, f"{mart_path}/{IDS}", partitioned(TRADE_IDS, "insert_date"))


def _named(days: DataFrame) -> set[str]:
    return {str(r[0]) for r in days.collect()}


def plan_refresh(spark: SparkSession, raw_path: str, mart_path: str, dedup: bool = True) -> Work:
    """Find the days to rebuild and the days to read, from contents and bitmaps of ids.

    A changed day is read once for its ids. Their bitmaps, and those the day had before, show which
    other days hold versions of its trades: earlier ones are rebuilt too, as their version may have lost. Whatever
    day shares an id with a day to rebuild is read beside it, and no other day is. Closed days
    are neither rebuilt nor read.
    """
    closed = closed_before(spark, raw_path)
    contents = day_contents(spark, raw_path)
    there = {d for d in contents if closed is None or date.fromisoformat(d) >= closed}
    before = read_contents(spark, f"{mart_path}/{FOLDED}")
    changed = sorted(d for d in there if contents[d] != before.get(d))
    if not changed or not dedup:
        return Work(contents, changed, changed, changed)
    path = scratch_path(spark, "ids")
    days = read_days(spark, raw_path, partitioned(RAW_TRADE, "insert_date"), changed)
    with fitted_shuffles(days):
        id_bitmaps(days, "insert_date").write.parquet(path)
    fresh = spark.read.schema(partitioned(TRADE_IDS, "insert_date")).parquet(path)
    if len(changed) == len(there):
        return Work(contents, changed, changed, changed, fresh)
    index = _index(spark, mart_path)
    others = index.where(~F.col("insert_date").isin([date.fromisoformat(d) for d in changed]))
    asked = fresh.unionByName(_on_days(index, "insert_date", changed))
    shared = _named(holders(others, asked, "insert_date")) & there
    rebuild = sorted({*changed, *(d for d in shared if d < max(changed))})
    known = others.unionByName(fresh)
    versions = holders(known, _on_days(known, "insert_date", rebuild), "insert_date")
    return Work(contents, changed, rebuild, sorted({*rebuild, *(_named(versions) & there)}), fresh)


def _refresh_days(spark: SparkSession, raw_path: str, mart_path: str, staging_path: str, bucket: str | int, dedup: bool):
    """Rebuild every day whose content is not that of the last refresh, however old it is."""
    check_day_bucket(bucket)
    work = plan_refresh(spark, raw_path, mart_path, dedup)
    if not work.changed:
        return mart_cutoff(spark, mart_path)
    trades = read_days(spark, raw_path, partitioned(RAW_TRADE, "insert_date"), work.read)
    rows = trades.select(*CANDLE_INPUT)
    fresh = with_period_date(ohlcv(dedup_trades(rows) if dedup else rows, bucket))
    if work.read != work.rebuild:
        fresh = _on_days(fresh, "period_date", work.rebuild)
    with fitted_shuffles(trades):
        stage(fresh, staging_path, mart_path, MART_BY, replaced=work.rebuild)
    apply_staged(spark, staging_path, mart_path, MART_BY, MART_SORT)
    # A run that dies before the note is in place is made good by the next one, which rebuilds the same days.
    if work.ids is not None:
        write_partitions(work.ids, f"{mart_path}/{IDS}", ["insert_date"], ID_KEY)
    write_contents(spark, f"{mart_path}/{FOLDED}", work.contents)
    return datetime.combine(date.fromisoformat(work.rebuild[0]), time.min, timezone.utc)


def refresh_mart(
    spark: SparkSession,
    raw_path: str,
    mart_path: str,
    staging_path: str,
    bucket: str | int = "minute",
    dedup: bool = True,
    late: bool = True,
) -> datetime:
    """Bring the mart up to date with the raw trades and return from where on it changed.

    All days are rebuilt that got trades since the last refresh or whose trades were superseded, so the mart
    has the candles of all raw trades of its open days; candles of days that ``expire_days`` has closed stay as they are.
    With ``late=False`` only the tail after a cutoff is rebuilt: the cutoff travels as a literal,
    prunes raw partitions and reaches the scan, and trades before it are not looked at.
    """
    delete(spark, f"{mart_path}/{PUBLISHED}")
    apply_staged(spark, staging_path, mart_path, MART_BY, MART_SORT)
    if late:
        return _refresh_days(spark, raw_path, mart_path, staging_path, bucket, dedup)
    cutoff = mart_cutoff(spark, mart_path)
    start = F.lit(cutoff)
    raw = read_raw(spark, raw_path)
    fresh = candles_from(raw, start, bucket, dedup)
    if cutoff > EPOCH:
        same_day = read_mart(spark, mart_path).where(
            (F.col("period_date") == F.lit(cutoff.date())) & (F.col("period_start") < start)
        )
        fresh = fresh.unionByName(same_day.select(*CANDLE_COLUMNS))
    with fitted_shuffles(raw.where(F.col("insert_date") >= F.lit(cutoff.date()))):
        stage(with_period_date(fresh), staging_path, mart_path, MART_BY)
    apply_staged(spark, staging_path, mart_path, MART_BY, MART_SORT)
    return cutoff
