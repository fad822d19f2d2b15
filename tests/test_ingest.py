"""Parsing, casting and validation on hand-made messages."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.functions.casts import lenient_boolean, lenient_double, lenient_long
from tickloom.functions.text import float_text
from tickloom.functions.times import (
    bucket_start,
    epoch_ms_to_timestamp,
    epoch_ms_to_timestamp_seconds,
    month_number,
)
from tickloom.operators import ingest
from tickloom.schema import LAKE_TRADE, TRADE_COLUMNS

GOOD = {
    "trade_id": 7,
    "symbol": "BTCUSDT",
    "price": 64000.5,
    "quantity": 0.25,
    "amount_usdt": 16000.125,
    "trade_time": 1700000000123,
    "event_time": 1700000000125,
    "is_buyer_maker": True,
}


def messages(spark, *values):
    return spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "value binary")


def parsed(spark, *values, parse=ingest.parse_trades):
    return [tuple(r) for r in parse(messages(spark, *values)).collect()]


def test_good_message(spark):
    want = [tuple(GOOD.values())]
    assert parsed(spark, json.dumps(GOOD)) == want
    assert parsed(spark, json.dumps(GOOD), parse=ingest.parse_trades_struct) == want


@pytest.mark.parametrize("value", ["nope", "null", "", "[1]", '{"trade_id": 1', None])
def test_broken_message_is_a_row_of_nulls(spark, value):
    assert parsed(spark, value) == [(None,) * 8]


def test_bad_field_is_null_and_the_rest_stays(spark):
    for field, text in [("price", "abc"), ("trade_id", "x"), ("is_buyer_maker", "maybe")]:
        row = dict(zip(TRADE_COLUMNS, parsed(spark, json.dumps(GOOD | {field: text}))[0]))
        assert row == GOOD | {field: None}


def test_missing_field_is_null(spark):
    short = {k: v for k, v in GOOD.items() if k != "quantity"}
    assert dict(zip(TRADE_COLUMNS, parsed(spark, json.dumps(short))[0])) == GOOD | {"quantity": None}


def test_lenient_casts(spark):
    texts = ["1", "1.7", "-1.7", " 12 ", "1e3", "abc", "", "99999999999999999999", "yes", "0"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        lenient_long(F.col("t")), lenient_double(F.col("t")), lenient_boolean(F.col("t"))
    )
    longs, doubles, booleans = zip(*rows.collect())
    assert longs == (1, 1, -1, 12, None, None, None, None, None, 0)
    assert doubles == (1.0, 1.7, -1.7, 12.0, 1000.0, None, None, 1e20, None, 0.0)
    assert booleans == (True, None, None, None, None, None, None, None, True, False)


def test_exchange_message_tells_t_from_T(spark):
    raw = {"e": "trade", "t": 5, "s": "X", "p": "2.50", "q": "0.4", "T": 1000, "E": 1002, "m": False}
    for sensitive in ("true", "false"):
        spark.conf.set("spark.sql.caseSensitive", sensitive)
        try:
            got = ingest.normalize_raw_trades(messages(spark, json.dumps(raw))).first()
        finally:
            spark.conf.unset("spark.sql.caseSensitive")
        assert tuple(got) == (5, "X", 2.5, 0.4, 1.0, 1000, 1002, False)


def test_encode_and_parse_are_inverse(spark):
    rows = [tuple(GOOD.values()), (1, None, 1e-7, 1e22, None, 5, None, None)]
    trades = spark.createDataFrame(rows, LAKE_TRADE)
    sent = ingest.encode_trades(trades)
    assert sent.schema["value"].dataType.typeName() == "binary"
    for parse in (ingest.parse_trades, ingest.parse_trades_struct):
        assert [tuple(r) for r in parse(sent).collect()] == rows
    assert set(json.loads(sent.first().value)) == set(TRADE_COLUMNS)


def test_float_text_is_shortest_plain(spark):
    numbers = [
        0.0, 1.0, 64000.5, 0.00012, 0.0001, 1.2e-4, 1e-5, 1.5e-7, 12345678.9, 1e7, 1e15,
        123456789012345.6, 1e16, 1.5e22, 0.001, -0.00012, -2.5e-9, 29.27,
    ]
    rows = spark.createDataFrame([(n,) for n in numbers], "n double").select(float_text(F.col("n")))
    assert [r[0] for r in rows.collect()] == [repr(n) for n in numbers]


def test_tape_and_side(spark):
    rows = [(1, 2.5, 0.00012, 9, True), (2, 2.5, 1.0, 9, False), (3, 2.5, 1.0, 9, None)]
    trades = spark.createDataFrame(
        rows, "trade_id long, price double, quantity double, trade_time long, is_buyer_maker boolean"
    )
    assert [r.line for r in ingest.trade_tape(trades).collect()] == [
        "SELL 🔴 | P: 2.5 | Q: 0.00012 | Time: 9",
        "BUY 🟢 | P: 2.5 | Q: 1.0 | Time: 9",
        "BUY 🟢 | P: 2.5 | Q: 1.0 | Time: 9",
    ]
    assert [r.side for r in ingest.with_taker_side(trades).collect()] == ["SELL", "BUY", "BUY"]


def test_epoch_conversions(spark):
    rows = spark.createDataFrame([(1700000000123,), (-1,), (-1001,)], "ms long").select(
        *(F.date_format(f(F.col("ms")), "yyyy-MM-dd HH:mm:ss.SSS")
          for f in (epoch_ms_to_timestamp, epoch_ms_to_timestamp_seconds))
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("2023-11-14 22:13:20.123", "2023-11-14 22:13:20.000"),
        ("1969-12-31 23:59:59.999", "1970-01-01 00:00:00.000"),
        ("1969-12-31 23:59:58.999", "1969-12-31 23:59:59.000"),
    ]


def test_buckets_before_and_after_1970(spark):
    times = ["2024-02-29 13:59:59.999", "1969-12-31 23:59:59.999", "2024-03-01 00:00:00"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(
        F.col("t").cast("timestamp").alias("t")
    )
    for unit in ("minute", "hour", "day"):
        assert rows.where(bucket_start(F.col("t"), unit) != F.date_trunc(unit, "t")).count() == 0
    assert [r[0] for r in rows.select(month_number(F.col("t"))).collect()] == [202402, 196912, 202403]
    with pytest.raises(ValueError):
        bucket_start(F.col("t"), 0)


def test_check_splits_without_loss(spark):
    cases = {
        "good": {},
        "no_trade_id": {"trade_id": None},
        "no_trade_time": {"trade_time": None},
        "time_out_of_range": {"trade_time": 9 * 10**17},
        "number_out_of_range": {"amount_usdt": 1e12},
        "symbol_too_long": {"symbol": "S" * 21},
    }
    rows = [tuple((GOOD | change).values()) for change in cases.values()]
    rows.append(tuple((GOOD | {"event_time": 9 * 10**17}).values()))
    rows.append(tuple((GOOD | {"price": None, "event_time": None}).values()))
    checked = ingest.check_trades(spark.createDataFrame(rows, LAKE_TRADE))
    reasons = [r.reject_reason for r in checked.collect()]
    assert reasons == [None, *list(cases)[1:], "time_out_of_range", None]
    assert ingest.accepted(checked).count() == 2
    assert ingest.quarantined(checked).count() == 6
    assert ingest.conform_raw(ingest.accepted(checked)).count() == 2


def test_conform_rounds_half_up_and_refuses_overflow(spark):
    row = GOOD | {"price": 0.123456785, "quantity": None}
    trades = spark.createDataFrame([tuple(row.values())], LAKE_TRADE)
    raw = ingest.conform_raw(trades).first()
    assert (raw.price, raw.quantity) == (Decimal("0.12345679"), None)
    assert raw.trade_time == datetime.fromtimestamp(1700000000.123)
    huge = trades.withColumn("price", F.lit(1e13))
    with pytest.raises(PySparkException):
        ingest.conform_raw(huge).collect()


def test_realtime_day(spark):
    trades = spark.createDataFrame([tuple(GOOD.values())], LAKE_TRADE)
    assert str(ingest.realtime_trades(trades).first().insert_date) == "2023-11-14"
