"""The same queries in plain SQL, for checking results with another engine."""

from __future__ import annotations

from tickloom.queries import FAR_AHEAD_MS, WHALE_USDT

# t: events as lake trades; r: as warehouse trades.
_TRADES = """
t AS (
  SELECT event_id AS trade_id, event_type AS symbol, value AS price,
         CAST(k AS DOUBLE) / 100 AS quantity, value * (CAST(k AS DOUBLE) / 100) AS amount_usdt,
         epoch_us(ts) // 1000 AS trade_time, epoch_us(ts) // 1000 + k AS event_time,
         k % 2 = 1 AS is_buyer_maker, k
  FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)
),
r AS (
  SELECT trade_id, symbol, CAST(price AS DECIMAL(20,8)) AS price,
         CAST(quantity AS DECIMAL(20,8)) AS quantity,
         CAST(amount_usdt AS DECIMAL(20,8)) AS amount_usdt,
         make_timestamp(trade_time * 1000) AS trade_time,
         make_timestamp(event_time * 1000) AS event_time, is_buyer_maker
  FROM t
)"""

_LAKE = (
    "trade_id, symbol, price, quantity, amount_usdt, trade_time, event_time, is_buyer_maker"
)


def _candles(source: str, unit: str = "minute") -> str:
    return f"""
  SELECT date_trunc('{unit}', trade_time) AS period_start, symbol,
         CAST(arg_min(price, (trade_time, trade_id)) AS DOUBLE) AS open_price,
         CAST(max(price) AS DOUBLE) AS high_price, CAST(min(price) AS DOUBLE) AS low_price,
         CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS close_price,
         CAST(sum(quantity) AS DOUBLE) AS total_volume,
         CAST(sum(amount_usdt) AS DOUBLE) AS total_amount_usdt,
         CAST(count(trade_id) AS INTEGER) AS trades_count
  FROM {source} GROUP BY ALL"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_TRADES, *ctes]) + "\n" + select


_C = f"c AS ({_candles('r')})"
_AS_OF = "(SELECT max(trade_time) FROM r)"

_MERGED = """CAST(arg_min(open_price, period_start) AS DOUBLE) AS open_price,
         max(high_price) AS high_price, min(low_price) AS low_price,
         CAST(arg_max(close_price, period_start) AS DOUBLE) AS close_price,
         CAST(sum(CAST(total_volume AS DECIMAL(28,8))) AS DOUBLE) AS total_volume,
         CAST(sum(CAST(total_amount_usdt AS DECIMAL(28,8))) AS DOUBLE) AS total_amount_usdt,
         CAST(sum(trades_count) AS INTEGER) AS trades_count"""

# Damaged messages, as their fields should be read.
_FAULTY = """f AS (
  SELECT trade_id AS source_id,
         CASE WHEN k NOT IN (0, 1, 6) THEN trade_id END AS trade_id,
         CASE WHEN k IN (0, 6) THEN NULL WHEN k = 5 THEN symbol || repeat('x', 20)
              ELSE symbol END AS symbol,
         CASE WHEN k IN (0, 3, 6) THEN NULL WHEN k = 4 THEN 1e15 ELSE price END AS price,
         CASE WHEN k NOT IN (0, 6) THEN quantity END AS quantity,
         CASE WHEN k NOT IN (0, 6) THEN amount_usdt END AS amount_usdt,
         CASE WHEN k NOT IN (0, 2, 6) THEN trade_time END AS trade_time,
         CASE WHEN k NOT IN (0, 6) THEN event_time END AS event_time,
         CASE WHEN k NOT IN (0, 6) THEN is_buyer_maker END AS is_buyer_maker,
         CASE WHEN k IN (0, 1, 6) THEN 'no_trade_id' WHEN k = 2 THEN 'no_trade_time'
              WHEN k = 4 THEN 'number_out_of_range' WHEN k = 5 THEN 'symbol_too_long'
         END AS reject_reason
  FROM t
)"""

_REPLAYED = """d AS (
  SELECT * FROM r UNION ALL SELECT * FROM r UNION ALL
  SELECT trade_id, symbol, price, CAST(quantity + 1 AS DECIMAL(20,8)), amount_usdt,
         trade_time + INTERVAL 1 SECOND, event_time, is_buyer_maker
  FROM r WHERE is_buyer_maker
)"""


def _latest(source: str, keys: str, order: str, extra: str = "") -> str:
    return f"""SELECT * EXCLUDE (n{extra}) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS n FROM {source}
) WHERE n = 1"""


_FIRST_LOAD = f"""early AS (
  SELECT * FROM r
  WHERE trade_time < {_AS_OF} - CASE WHEN symbol = 'error' THEN INTERVAL 24 HOUR
                                     ELSE INTERVAL 2 HOUR END
),
m AS ({_candles('early')}),
cut AS (
  SELECT coalesce(max(period_start), TIMESTAMP '1970-01-01') AS cutoff FROM m
  WHERE period_start < (SELECT max(period_start) - INTERVAL 1 HOUR FROM m)
)"""

_PRESSURE = """SELECT *, round((buy_amount_usdt - sell_amount_usdt)
                / nullif(buy_amount_usdt + sell_amount_usdt, 0), 9) AS imbalance
FROM (
  SELECT symbol,
         CAST(coalesce(sum(amount_usdt) FILTER (WHERE NOT is_buyer_maker), 0) AS DOUBLE)
           AS buy_amount_usdt,
         count(*) FILTER (WHERE NOT is_buyer_maker) AS buy_count,
         CAST(coalesce(sum(amount_usdt) FILTER (WHERE is_buyer_maker), 0) AS DOUBLE)
           AS sell_amount_usdt,
         count(*) FILTER (WHERE is_buyer_maker) AS sell_count
  FROM r {where} GROUP BY symbol
)"""


def _stats(days: int) -> str:
    return _with(
        f"""SELECT *, round((close_price - open_price) * 100 / nullif(open_price, 0), 9) AS change_pct
FROM (
  SELECT symbol, {_MERGED} FROM c
  WHERE period_start > (SELECT max(period_start) FROM c) - INTERVAL {days} DAY
  GROUP BY symbol
)""",
        _C,
    )


def _rolling(kind: str, column: str) -> str:
    return f"CAST({kind}(CAST({column} AS DECIMAL(28,8))) OVER w AS DOUBLE)"


_LAKE_ROWS = _with(f"SELECT {_LAKE} FROM t")
_RAW_ROWS = _with("SELECT * FROM r")
_GOOD_ROWS = _with(f"SELECT {_LAKE} FROM f WHERE reject_reason IS NULL", _FAULTY)
_RT_ROWS = _with(
    """SELECT trade_id, symbol, price, quantity, amount_usdt,
       make_timestamp(trade_time * 1000) AS trade_time,
       make_timestamp(event_time * 1000) AS event_time, is_buyer_maker,
       CAST(make_timestamp(trade_time * 1000) AS DATE) AS insert_date
FROM t"""
)

ORACLE: dict[str, str] = {
    "normalize_raw_trades": _LAKE_ROWS,
    "encode_trades": _with(f"SELECT CAST(NULL AS VARCHAR) AS key, 'trades' AS topic, {_LAKE} FROM t"),
    "parse_trades": _LAKE_ROWS,
    "parse_trades_struct": _LAKE_ROWS,
    "parse_faulty_trades": _with(f"SELECT source_id, {_LAKE} FROM f", _FAULTY),
    "quarantine_trades": _with(
        "SELECT source_id, reject_reason FROM f WHERE reject_reason IS NOT NULL", _FAULTY
    ),
    "accepted_trades": _GOOD_ROWS,
    "taker_side": _with(
        "SELECT trade_id, CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS side FROM t"
    ),
    "trade_tape": _with(
        """SELECT trade_id, CASE WHEN is_buyer_maker THEN 'SELL 🔴' ELSE 'BUY 🟢' END
       || ' | P: ' || CAST(price AS VARCHAR) || ' | Q: ' || CAST(quantity AS VARCHAR)
       || ' | Time: ' || CAST(trade_time AS VARCHAR) AS line
FROM t"""
    ),
    "epoch_to_ts": _with("SELECT trade_id, trade_time, event_time FROM r"),
    "epoch_to_ts_seconds": _with(
        """SELECT trade_id, date_trunc('second', trade_time) AS trade_time,
       date_trunc('second', event_time) AS event_time FROM r"""
    ),
    "lake_scan": _LAKE_ROWS,
    "raw_trades": _RAW_ROWS,
    "raw_trades_seconds": _with(
        """SELECT * REPLACE (date_trunc('second', trade_time) AS trade_time,
                  date_trunc('second', event_time) AS event_time) FROM r"""
    ),
    "rt_trades": _RT_ROWS,
    "retain_3d": _with(
        """SELECT trade_id, symbol, price, quantity, amount_usdt, trade_time, event_time,
       is_buyer_maker, CAST(trade_time AS DATE) AS insert_date
FROM (SELECT * REPLACE (make_timestamp(trade_time * 1000) AS trade_time,
                        make_timestamp(event_time * 1000) AS event_time) FROM t)
WHERE date_trunc('second', trade_time) + INTERVAL 3 DAY
      > date_trunc('second', (SELECT max(trade_time) FROM r))"""
    ),
    "dedup_trades": _with(_latest("d", "symbol, trade_id", "trade_time DESC"), _REPLAYED),
    "dedup_trades_by_day": _with(
        _latest(
            "(SELECT *, CAST(trade_time AS DATE) AS insert_date FROM d)",
            "symbol, trade_id, insert_date",
            "trade_time DESC",
        ),
        _REPLAYED,
    ),
    "dedup_lineitem": _latest(
        "lineitem",
        "l_orderkey, l_linenumber",
        "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,"
        " l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC",
    ),
    "dedup_candles": _with(
        _latest(
            f"(SELECT *, 1 AS load_id FROM c UNION ALL SELECT *, 2 FROM ("
            f"{_candles('(SELECT * FROM r WHERE is_buyer_maker)')}))",
            "symbol, period_start",
            "load_id DESC",
            ", load_id",
        ),
        _C,
    ),
    "ohlcv_1m": _with(_candles("r")),
    "ohlcv_1h": _with(_candles("r", "hour")),
    "ohlcv_1d": _with(_candles("r", "day")),
    "rollup_candles": _with(
        f"""SELECT date_trunc('hour', period_start) AS period_start, symbol, {_MERGED.replace(
            'arg_min(open_price, period_start)', 'arg_min(open_price, c.period_start)'
        ).replace('arg_max(close_price, period_start)', 'arg_max(close_price, c.period_start)')}
FROM c GROUP BY date_trunc('hour', c.period_start), symbol""",
        _C,
    ),
    "refresh_cutoff": _with("SELECT cutoff FROM cut", _FIRST_LOAD),
    "refresh_candles": _with(_candles("r")),
    "refresh_candles_tail": _with(
        f"""SELECT * FROM m WHERE period_start < (SELECT cutoff FROM cut)
UNION ALL {_candles('(SELECT * FROM r WHERE trade_time >= (SELECT cutoff FROM cut))')}""",
        _FIRST_LOAD,
    ),
    "refresh_candles_late": _with(_candles("r")),
    "publish_candles": _with(
        "SELECT *, CAST(strftime(period_start, '%Y%m') AS INTEGER) AS period_month FROM c", _C
    ),
    "current_price": _with(
        """SELECT symbol, CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS price,
       max(trade_time) AS trade_time FROM r GROUP BY symbol"""
    ),
    "volume_last_hour": _with(
        f"""SELECT date_trunc('minute', trade_time) AS period_start, symbol,
       CAST(sum(quantity) AS DOUBLE) AS total_volume,
       CAST(sum(amount_usdt) AS DOUBLE) AS total_amount_usdt,
       CAST(count(trade_id) AS INTEGER) AS trades_count
FROM r WHERE trade_time > {_AS_OF} - INTERVAL 1 HOUR GROUP BY ALL"""
    ),
    "whale_trades": _with(
        f"""SELECT trade_time, symbol, trade_id,
       CASE WHEN is_buyer_maker THEN 'SELL' ELSE 'BUY' END AS side,
       price, quantity, amount_usdt
FROM r WHERE amount_usdt >= {WHALE_USDT}
ORDER BY trade_time DESC, trade_id DESC, symbol LIMIT 50"""
    ),
    "market_pressure": _with(_PRESSURE.format(where="")),
    "market_pressure_24h": _with(
        _PRESSURE.format(where=f"WHERE trade_time > {_AS_OF} - INTERVAL 24 HOUR")
    ),
    "candle_spread": _with(
        """SELECT period_start, symbol, round(high_price - low_price, 9) AS spread,
       round((high_price - low_price) / nullif(low_price, 0), 9) AS spread_ratio FROM c""",
        _C,
    ),
    "stats_24h": _stats(1),
    "stats_7d": _stats(7),
    "rolling_24h": _with(
        f"""SELECT period_start, symbol, {_rolling('sum', 'total_volume')} AS volume,
       {_rolling('sum', 'total_amount_usdt')} AS amount_usdt,
       max(high_price) OVER w AS highest, min(low_price) OVER w AS lowest
FROM c WINDOW w AS (PARTITION BY symbol ORDER BY period_start
                    RANGE BETWEEN INTERVAL 86399 SECOND PRECEDING AND CURRENT ROW)""",
        _C,
    ),
    "stream_lake": _GOOD_ROWS,
    "stream_quarantine": _with(
        f"SELECT {_LAKE}, reject_reason FROM f WHERE reject_reason IS NOT NULL", _FAULTY
    ),
    "stream_rt_trades": _RT_ROWS,
    "stream_rt_hard": _with(
        f"""SELECT trade_id, symbol, price, make_timestamp(trade_time * 1000) AS trade_time,
       CAST(NULL AS VARCHAR) AS reason FROM t
UNION ALL SELECT trade_id + 10000000, symbol, price,
       make_timestamp((trade_time + {FAR_AHEAD_MS}) * 1000), 'time_in_future'
FROM t WHERE trade_id % 100 = 1
UNION ALL SELECT trade_id + 20000000, repeat(symbol, 10), 1e15, make_timestamp(trade_time * 1000), NULL
FROM t WHERE trade_id % 100 = 2"""
    ),
    "stream_normalized": _with(
        """SELECT CASE WHEN part <> 1 THEN trade_id END AS trade_id, CASE WHEN part = 3 THEN symbol || repeat('x', 20) ELSE symbol END AS symbol,
       CASE WHEN part <> 2 THEN price END AS price, quantity, CASE WHEN part <> 2 THEN amount_usdt END AS amount_usdt,
       trade_time, event_time, is_buyer_maker,
       CASE part WHEN 1 THEN 'no_trade_id' WHEN 3 THEN 'symbol_too_long' END AS reject_reason
FROM (SELECT *, trade_id % 100 AS part FROM t) WHERE part NOT IN (0, 50)
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no_trade_id' FROM t WHERE trade_id % 50 = 0"""
    ),
    "stream_live_candles": _with(_candles("r")),
    "stream_live_late": _with(
        f"""SELECT *, CAST(NULL AS VARCHAR) AS reason FROM ({_candles('r')})
UNION ALL SELECT DISTINCT make_timestamp((trade_time + {FAR_AHEAD_MS}) * 1000), symbol, price, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE,
       NULL::DOUBLE, NULL::DOUBLE, NULL::INTEGER, 'time_in_future' FROM t WHERE trade_id % 100 = 1"""
    ),
    "stream_archive_load": _RAW_ROWS,
    "compact_raw": _with("SELECT *, 'merged' AS batch FROM r"),
}
