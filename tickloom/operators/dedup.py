"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The more selective, fixed-width column goes first: sorts then compare 8-byte prefixes
# that nearly always differ, instead of walking through whole rows of one symbol.
TRADE_KEY = ["trade_id", "symbol"]
CANDLE_KEY = ["period_start", "symbol"]

# Version first, then the columns candles need, so that a narrower selection of
# trades still keeps the same winner.
_TRADE_ORDER = ["trade_time", "price", "quantity", "amount_usdt", "event_time", "is_buyer_maker"]


def latest_per_key(
    rows: DataFrame, keys: list[str], version: list[str], tie_break: list[str] | None = None
) -> DataFrame:
    """The row with the highest ``version`` for each key.

    Ties fall to ``tie_break`` and then to the other columns, so the result does not
    depend on row order. Written as a max of structs: copies of a key are merged
    before the shuffle, so a key that holds a large share of all rows crosses it once
    per task and never gathers in one task. Filters on the keys reach the scan.
    """
    order = version + (tie_break or [])
    rest = [c for c in rows.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def trade_order(columns: list[str]) -> list[str]:
    """The columns that decide between versions of a trade, of those that are there."""
    return [c for c in _TRADE_ORDER if c in columns]


def dedup_trades(trades: DataFrame, within_day: bool = False) -> DataFrame:
    """Latest version (by trade time) of each ``(symbol, trade_id)``.

    ``within_day=True`` keeps versions on different days apart, as a table partitioned
    by ``insert_date`` that merges only inside a partition would. A trade without an id
    has no key to be compared by and stays as it is; such rows take a branch of their own, so that the keys of the
    others are plain columns and filters on them are pushed down.
    """
    keys = [*TRADE_KEY, *(["insert_date"] if within_day else [])]
    order = trade_order(trades.columns)
    known = latest_per_key(trades.where("trade_id IS NOT NULL"), keys, order[:1], order[1:])
    return known.unionByName(trades.where("trade_id IS NULL"))


def dedup_candles(candles: DataFrame, load_order: list[str] | None = None) -> DataFrame:
    """The last loaded row of each ``(symbol, period_start)``; drops the load columns."""
    load_order = load_order or ["load_id"]
    return latest_per_key(candles, CANDLE_KEY, load_order).drop(*load_order)
