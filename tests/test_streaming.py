"""Streams against batch: replays, restarts, late rows, file lifecycle."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import DATA
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tickloom.operators import candles, dedup, ingest
from tickloom.plans.changes import closed_before
from tickloom.plans.upkeep import compact_days, expire_days
from tickloom.schema import BUS_MESSAGE, LAKE_TRADE, RAW_TRADE, TRADE_COLUMNS
from tickloom.sinks.tables import MARKER, partition_values
from tickloom.sources import events as ev
from tickloom.sources.bus import file_stream, text_stream
from tickloom.sources.lake import read_lake, read_table
from tickloom.streaming import live as live_module
from tickloom.streaming.archive import load_and_archive, load_to_jdbc
from tickloom.streaming.ingest import ingest_realtime, ingest_to_lake, normalize_to_lake, read_realtime
from tickloom.streaming.live import (
    LIVE_CANDLE,
    LIVE_IDS,
    LIVE_TABLE,
    LiveTables,
    live_candles,
    merge_live_candles,
    merge_live_ids,
    read_live_candles,
)

START = datetime(2024, 1, 1)
START_MS = 1704067200000


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def message(trade_id, minute, price=1.0, symbol="a"):
    at = START_MS + int(minute * 60000)
    values = (trade_id, symbol, price, 1.0, price, at, at, False)
    return json.dumps(dict(zip(TRADE_COLUMNS, values)))


@pytest.fixture
def bus(spark, tmp_path):
    """A folder of bus records, and a function that adds texts to it as one file."""
    folder = tmp_path / "bus"
    folder.mkdir()

    def send(*texts):
        rows = [(None, t.encode(), "trades", 0, n, None) for n, t in enumerate(texts)]
        spark.createDataFrame(rows, BUS_MESSAGE).coalesce(1).write.mode("append").parquet(str(folder))

    send.path = str(folder)
    return send


def drain(query):
    query.awaitTermination()
    return query


def test_lake_gets_each_message_once(spark, bus, tmp_path):
    lake, bad, state = (str(tmp_path / n) for n in ("lake", "bad", "state"))

    def run(max_files=None):
        return drain(ingest_to_lake(file_stream(spark, bus.path, max_files), lake, bad, state))

    bus(message(1, 0), "nope", message(2, 1))
    run()
    bus(message(3, 2))
    bus(message(4, 3), message(None, 3))
    run(max_files=1)
    run()
    got = read_table(spark, lake, LAKE_TRADE)
    assert sorted(r.trade_id for r in got.collect()) == [1, 2, 3, 4]
    rejected = spark.read.parquet(bad)
    assert {r.reject_reason for r in rejected.collect()} == {"no_trade_id"}
    assert "nope" in [bytes(r.value).decode() for r in rejected.collect()]
    assert len(partition_values(spark, lake, "batch")) == 3  # one, then two of one file each


def test_replayed_batch_replaces_itself(spark, bus, tmp_path):
    """A crash after the write but before the commit: the batch runs again."""
    lake, bad, state = (str(tmp_path / n) for n in ("lake", "bad", "state"))
    bus(message(1, 0), message(2, 1))
    drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, state))
    for file in Path(state, "commits").iterdir():
        if file.name.strip(".").startswith("0"):
            file.unlink()
    drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, state))
    assert read_table(spark, lake, LAKE_TRADE).count() == 2


def test_realtime_shows_each_trade_once_however_late(spark, bus, tmp_path):
    table, state, bad = (str(tmp_path / n) for n in ("rt", "state", "bad"))

    def run():
        return drain(ingest_realtime(file_stream(spark, bus.path, 1), table, state, quarantine=bad))

    far = 6000 * 365 * 24 * 60
    bus(message(1, 0), message(1, 0), message(2, 1), message(9, far), message(None, 0), "nope")
    run()
    bus(message(2, 1), message(3, 2), message(4, -3 * 24 * 60), message(5, 3, 1e15, "s" * 30))
    bus(message(1, 0), message(1, 0, symbol="b"))
    run()
    rows = read_realtime(spark, table).collect()
    assert sorted((r.symbol, r.trade_id) for r in rows) == [
        ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1), ("s" * 30, 5),
    ]
    assert {str(r.insert_date) for r in rows} == {"2024-01-01", "2023-12-29"}
    reasons = sorted(r.reject_reason for r in spark.read.parquet(bad).collect())
    assert reasons == ["no_trade_id", "no_trade_id", "time_in_future"]


@pytest.fixture
def live(spark, bus, tmp_path):
    """Tables of a live stream with functions to drain the bus into them and to show the candles."""
    tables = LiveTables(str(tmp_path / "live"))
    tables.state = str(tmp_path / "state")
    tables.run = lambda: drain(live_candles(file_stream(spark, bus.path, 1), tables.candles, tables.state))

    def shown():
        rows = read_live_candles(spark, tables.candles).withColumn("at", F.col("period_start").cast("timestamp_ntz"))
        return {
            int((r["at"] - START) / timedelta(minutes=1)): (r.open_price, r.close_price, r.trades_count)
            for r in rows.collect()
        }

    tables.shown = shown
    tables.versions = lambda: read_table(spark, tables.candles, LIVE_TABLE).count()
    return tables


def test_live_candles_follow_trades_however_late(spark, bus, live, tmp_path):
    assert live.shown() == {}
    bus(message(2, 0.5, 20.0), message(3, 5, 30.0))
    live.run()
    assert live.shown() == {0: (20.0, 20.0, 1), 5: (30.0, 30.0, 1)}
    # an older trade of a candle: open price changes, that candle alone is written again
    bus(message(1, 0.1, 10.0), message(4, 100, 40.0))
    live.run()
    assert live.shown() == {0: (10.0, 20.0, 2), 5: (30.0, 30.0, 1), 100: (40.0, 40.0, 1)}
    assert live.versions() == 4
    # hours and days behind the newest: all count
    bus(message(5, 50, 50.0), message(6, 20, 60.0), message(7, -3000, 5.0))
    live.run()
    want = {
        -3000: (5.0, 5.0, 1), 0: (10.0, 20.0, 2), 5: (30.0, 30.0, 1), 20: (60.0, 60.0, 1),
        50: (50.0, 50.0, 1), 100: (40.0, 40.0, 1),
    }
    assert live.shown() == want
    merged = compact_days(
        spark, live.candles, str(tmp_path / "staging"), LIVE_CANDLE, by="period_date", merge=merge_live_candles
    )
    assert merged == ["2023-12-29", "2024-01-01"]
    assert live.versions() == 6 and live.shown() == want
    # trades and ids are merged too, and newer states still win over merged ones
    assert compact_days(spark, live.trades, str(tmp_path / "staging"), RAW_TRADE) == ["2023-12-29", "2024-01-01"]
    assert compact_days(spark, live.ids, str(tmp_path / "staging"), LIVE_IDS, merge=merge_live_ids) == ["2023-12-29", "2024-01-01"]
    bus(message(8, 100.5, 70.0), message(2, 0.5, 20.0))
    live.run()
    assert live.shown() == want | {100: (40.0, 70.0, 2)}


def test_live_replays_touch_nothing_and_versions_touch_both_candles(spark, bus, live):
    sent = [message(i, i, float(i)) for i in range(1, 6)]
    bus(*sent, *sent)
    live.run()
    assert live.versions() == 5
    bus(*sent)
    live.run()
    assert live.versions() == 5
    # a newer version moves a trade to another candle; the old one is left without a trade
    bus(message(3, 9, 33.0))
    live.run()
    assert live.shown() == {1: (1.0, 1.0, 1), 2: (2.0, 2.0, 1), 4: (4.0, 4.0, 1), 5: (5.0, 5.0, 1), 9: (33.0, 33.0, 1)}
    assert live.versions() == 7
    # an older one loses and changes nothing, also days later and on another day
    bus(message(3, 8, 1.0), message(3, -5000, 1.0))
    live.run()
    assert live.versions() == 7 and 8 not in live.shown()
    # a version a day later takes the trade there; another symbol's trade of the same id is another trade
    bus(message(3, 1500, 3.5), message(3, 8, 7.0, symbol="b"))
    live.run()
    assert live.shown() == {1: (1.0, 1.0, 1), 2: (2.0, 2.0, 1), 4: (4.0, 4.0, 1), 5: (5.0, 5.0, 1), 8: (7.0, 7.0, 1), 1500: (3.5, 3.5, 1)}


def test_a_live_batch_resolves_its_own_trades_once(spark, bus, live, monkeypatch):
    """Only the trades of other batches are looked up again for the candles a batch touches."""
    looked = []

    def latest(rows, *order):
        looked.append(sorted(r.trade_id for r in rows.select("trade_id").distinct().collect()))
        return dedup.latest_per_key(rows, *order)

    monkeypatch.setattr(live_module, "latest_per_key", latest)
    bus(message(1, 0, 1.0), message(2, 0.5, 2.0), message(1, 0, 1.0), message(3, 3, 3.0))
    live.run()
    assert live.shown() == {0: (1.0, 2.0, 2), 3: (3.0, 3.0, 1)} and looked == []
    bus(message(4, 0.7, 4.0), message(2, 0.5, 2.0))
    live.run()
    assert live.shown() == {0: (1.0, 4.0, 3), 3: (3.0, 3.0, 1)} and looked == [[1]]
    # a version that moves a trade takes it out of a candle that holds trades of both batches
    bus(message(2, 5, 2.5))
    live.run()
    assert live.shown() == {0: (1.0, 4.0, 2), 3: (3.0, 3.0, 1), 5: (2.5, 2.5, 1)} and looked[1:] == [[1, 4]]


def test_live_stream_keeps_what_it_cannot_show(spark, bus, live):
    far = 6000 * 365 * 24 * 60
    bus(message(1, 0), message(9, far), message(None, 0), "nope", message(5, 3, 1e15), message(6, 3, symbol="s" * 30))
    live.run()
    assert live.shown() == {0: (1.0, 1.0, 1)}
    rows = spark.read.parquet(live.quarantine).collect()
    assert sorted(r.reject_reason for r in rows) == [
        "no_trade_id", "no_trade_id", "number_out_of_range", "symbol_too_long", "time_in_future",
    ]
    assert {bytes(r.value).decode() for r in rows} >= {"nope"}
    bus(message(2, 0.5, 4.0))
    live.run()
    assert live.shown() == {0: (1.0, 4.0, 2)}


def test_a_live_batch_that_is_run_again_changes_nothing(spark, bus, live):
    bus(message(1, 0, 5.0), message(2, 1, 6.0))
    live.run()
    bus(message(1, 7, 8.0), message(3, 0.5, 9.0))
    live.run()
    want = {0: (9.0, 9.0, 1), 1: (6.0, 6.0, 1), 7: (8.0, 8.0, 1)}
    assert live.shown() == want
    for file in Path(live.state, "commits").iterdir():
        if file.name.strip(".").startswith("1"):
            file.unlink()
    versions = live.versions()
    live.run()
    assert live.shown() == want and live.versions() == versions
    # a stream that starts anew over the same tables still has the last word
    live.state += "2"
    bus(message(4, 7.5, 1.0))
    live.run()
    assert live.shown() == want | {7: (8.0, 1.0, 2)}


def test_live_trades_of_closed_days_are_kept_aside(spark, bus, live):
    day = 24 * 60
    bus(*(message(n, n * day) for n in range(6)))
    live.run()
    assert expire_days(spark, live.trades, datetime(2024, 1, 6)) == ["2024-01-01", "2024-01-02"]
    bus(message(10, 3), message(11, 4 * day + 1))
    live.run()
    assert live.shown()[0] == (1.0, 1.0, 1) and 3 not in live.shown() and 4 * day + 1 in live.shown()
    assert [(r.trade_id, r.reject_reason) for r in spark.read.parquet(live.quarantine).collect()] == [(10, "day_closed")]


def test_stream_equals_batch_in_time_order(spark, tmp_path):
    """Many small batches, restarts between them, over a real table."""
    events = ev.read_events(spark, DATA).where(F.col("ts") < F.lit(datetime(2024, 1, 4)))
    bus, table, state = (str(tmp_path / n) for n in ("bus", "live", "state"))
    for day in range(1, 4):
        part = events.where(F.dayofmonth("ts") == day)
        sent = ev.messages_of(part.unionByName(part)).select(
            "key", "value", "topic",
            F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"),
        )
        sent.write.mode("append").parquet(bus)
        drain(live_candles(file_stream(spark, bus), table, state, bucket="hour"))
    same(read_live_candles(spark, table), candles.ohlcv(ev.raw_trades_of(events), "hour"))


def test_lake_files_are_loaded_once_and_archived(spark, bus, tmp_path):
    lake, bad, raw, archive = (str(tmp_path / n) for n in ("lake", "bad", "raw", "archive"))
    to_lake, to_raw = str(tmp_path / "s1"), str(tmp_path / "s2")

    def load():
        return drain(load_and_archive(spark, lake, raw, to_raw, archive, max_files=2))

    for n in range(4):
        bus(message(n, n * 600))
        drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, to_lake))
        load()
    for _ in range(3):
        load()
    assert sorted(r.trade_id for r in spark.read.parquet(raw).collect()) == [0, 1, 2, 3]
    left = {f.name for f in Path(lake).rglob("*.parquet")}
    moved = {f.name for f in Path(archive).rglob("*.parquet")}
    assert len(left) + len(moved) == 4 and len(moved) >= 3 and not left & moved
    assert partition_values(spark, raw, "insert_date") == ["2024-01-01", "2024-01-02"]
    # the archived file is still a readable trade
    kept = spark.read.option("recursiveFileLookup", "true").schema(LAKE_TRADE).parquet(archive)
    assert kept.where("trade_id IS NOT NULL").count() == len(moved)


def raw_batches(spark, path, *batches):
    """A raw table laid out as the load job leaves it; a batch is a list of (id, minute, price)."""
    for n, rows in enumerate(batches):
        texts = [(message(i, m, p).encode(),) for i, m, p in rows]
        trades = ingest.conform_raw(ingest.parse_trades(spark.createDataFrame(texts, "value binary")))
        (
            trades.withColumn("insert_date", F.to_date("trade_time"))
            .withColumn("batch", F.lit(f"b{n}"))
            .write.mode("append").partitionBy("insert_date", "batch").parquet(path)
        )


def test_compaction_merges_days_and_can_be_repeated(spark, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    day = 24 * 60
    raw_batches(
        spark, raw,
        [(1, 0, 1.0), (2, 1, 1.0), (3, day, 1.0)],
        [(1, 0, 1.0), (2, 5, 2.0), (4, 2 * day, 1.0)],
    )
    before = datetime(2024, 1, 3).date()
    assert compact_days(spark, raw, staging, RAW_TRADE, before) == ["2024-01-01", "2024-01-02"]
    rows = {(r.trade_id, float(r.price), r.batch) for r in spark.read.parquet(raw).collect()}
    assert rows == {(1, 1.0, "merged"), (2, 2.0, "merged"), (3, 1.0, "merged"), (4, 1.0, "b1")}
    assert compact_days(spark, raw, staging, RAW_TRADE, before) == []
    # a day that gets more rows is merged again
    raw_batches(spark, raw, [(9, 3, 1.0)])
    assert compact_days(spark, raw, staging, RAW_TRADE, before) == ["2024-01-01"]
    assert spark.read.parquet(raw).where("insert_date = '2024-01-01'").count() == 3
    assert not Path(staging, MARKER).exists()


def test_expiry_drops_whole_days_only(spark, tmp_path):
    raw = str(tmp_path / "raw")
    day = 24 * 60
    raw_batches(spark, raw, [(n, n * day + 60, 1.0) for n in range(6)])
    assert expire_days(spark, raw, datetime(2024, 1, 6, 0, 30)) == ["2024-01-01", "2024-01-02"]
    assert partition_values(spark, raw, "insert_date")[0] == "2024-01-03"
    assert expire_days(spark, str(tmp_path / "none"), datetime(2024, 1, 6)) == []


def test_late_trades_of_closed_days_do_not_get_into_the_raw_table(spark, bus, tmp_path):
    lake, bad, raw, s1, s2 = (str(tmp_path / n) for n in ("lake", "bad", "raw", "s1", "s2"))
    day = 24 * 60

    def load():
        drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, s1))
        drain(load_and_archive(spark, lake, raw, s2))

    bus(*(message(n, n * day + 60) for n in range(6)))
    load()
    expire_days(spark, raw, datetime(2024, 1, 6, 0, 30))
    bus(message(7, 61), message(8, 4 * day))
    load()
    assert partition_values(spark, raw, "insert_date")[0] == "2024-01-03"
    late = spark.read.parquet(f"{raw}_quarantine").collect()
    assert [(r.trade_id, r.reject_reason) for r in late] == [(7, "day_closed")]
    assert sorted(r.trade_id for r in spark.read.parquet(raw).collect()) == [2, 3, 4, 5, 8]
    # the horizon does not move back
    assert expire_days(spark, raw, datetime(2024, 1, 4)) == []
    assert str(closed_before(spark, raw)) == "2024-01-03"


def exchange_message(trade_id, minute, price="1.0", symbol="a"):
    at = START_MS + minute * 60000
    return json.dumps({"e": "trade", "E": at, "s": symbol, "t": trade_id, "p": price, "q": "2.0", "T": at, "m": True, "M": True})


def test_raw_messages_go_to_lake_or_quarantine_once(spark, tmp_path):
    lake, bad, state, texts = (str(tmp_path / n) for n in ("lake", "bad", "state", "texts"))

    def send(name, *lines):
        Path(texts).mkdir(exist_ok=True)
        Path(texts, name).write_text("\n".join(lines) + "\n")

    def run():
        drain(normalize_to_lake(text_stream(spark, texts, 1), lake, bad, state))

    send("1.txt", exchange_message(1, 0), "nope", exchange_message(None, 0), exchange_message(2, 0, "abc"))
    run()
    run()
    send("2.txt", exchange_message(3, 1, "1e15"), exchange_message(4, 1, symbol="s" * 21), exchange_message(5, 2, "0.5"))
    run()
    good = {r.trade_id: (r.price, r.amount_usdt) for r in read_lake(spark, lake).collect()}
    assert good == {1: (1.0, 2.0), 2: (None, None), 5: (0.5, 1.0)}
    rejected = spark.read.parquet(bad).collect()
    assert sorted(r.reject_reason for r in rejected) == ["no_trade_id", "no_trade_id", "number_out_of_range", "symbol_too_long"]
    assert len(good) + len(rejected) == 7
    # the lake goes on to the raw table like any other
    drain(load_and_archive(spark, lake, str(tmp_path / "raw"), str(tmp_path / "s2")))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3


def test_lake_goes_to_a_warehouse_once(spark, bus, tmp_path):
    lake, bad, s1, s2 = (str(tmp_path / n) for n in ("lake", "bad", "s1", "s2"))
    sent, broken = [], []

    def append(rows, url, table, load_id, connections, **options):
        if broken:
            raise OSError(broken.pop())
        assert (url, table, options) == ("jdbc:x", "t", {"user": "u"})
        sent.append((load_id, sorted(r.trade_id for r in rows.collect()), rows.schema["price"].dataType.simpleString()))

    def load():
        return load_to_jdbc(spark, lake, "jdbc:x", "t", s2, 1, append=append, user="u")

    assert load() is None
    for n in range(2):
        bus(message(n, n), message(n + 10, n))
        drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, s1))
    drain(load())
    drain(load())
    assert [x[0] for x in sent] == [0, 1] and sorted(x[1] for x in sent) == [[0, 10], [1, 11]] and sent[0][2] == "decimal(20,8)"
    # a batch that fails is sent again under its number
    bus(message(5, 5))
    drain(ingest_to_lake(file_stream(spark, bus.path), lake, bad, s1))
    broken.append("no connection")
    with pytest.raises(StreamingQueryException):
        drain(load())
    drain(load())
    assert sent[2:] == [(2, [5], "decimal(20,8)")]
