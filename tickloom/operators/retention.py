"""Time-to-live as a filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import seconds_interval

KEEP_DAYS = 3


def latest(rows: DataFrame, time: str, shift_seconds: int = 0) -> Column:
    """Newest value of ``time``, moved by ``shift_seconds``, as a scalar subquery.

    The shift sits inside the subquery, so what the outer filter sees is one literal.
    """
    return rows.agg(F.max(time) + seconds_interval(shift_seconds)).scalar()


def retention_start(as_of: Column, days: int = KEEP_DAYS) -> Column:
    """First trade time still kept at ``as_of``.

    A row expires once its time, cut to whole seconds, plus the retention is reached.
    """
    return F.date_trunc("second", as_of) + seconds_interval(1 - days * 86400)


def retain(
    trades: DataFrame,
    as_of: Column | None = None,
    days: int = KEEP_DAYS,
    time: str = "trade_time",
    partition: str | None = "insert_date",
) -> DataFrame:
    """Rows not older than ``days`` at ``as_of`` (default: the newest row).

    Where the table has the partition column, a date predicate next to the time
    predicate prunes whole partitions.
    """
    if as_of is None:
        start = trades.agg(retention_start(F.max(time), days)).scalar()
    else:
        start = retention_start(as_of, days)
    kept = trades.where(F.col(time) >= start)
    if partition in trades.columns:
        kept = kept.where(F.col(partition) >= F.to_date(start))
    return kept
