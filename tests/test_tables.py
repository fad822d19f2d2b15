"""Tables, publishing, retention, dedup and dashboard edge cases."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import DATA
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickloom.functions import bitmaps
from tickloom.operators import analytics, candles, dedup
from tickloom.operators.placement import with_period_date
from tickloom.operators.retention import retain
from tickloom.plans.mart import read_mart, refresh_mart
from tickloom.plans.publish import publish_candles, read_serving, refresh_and_publish
from tickloom.schema import CANDLE, LAKE_TRADE
from tickloom.session import scratch_path
from tickloom.sinks.jdbc import append_jdbc
from tickloom.sinks.tables import apply_staged, partition_values, stage, write_partitions
from tickloom.sources import events as ev
from tickloom.sources.bus import kafka_stream
from tickloom.sources.jdbc import read_jdbc
from tickloom.sources.lake import read_lake, read_table

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def raw(spark):
    return ev.raw_trades_of(ev.read_events(spark, DATA)).persist()


def same(a, b):
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    assert b.select(*a.columns).exceptAll(a).count() == 0


def test_missing_lake_is_empty_but_damage_is_an_error(spark, tmp_path):
    empty = read_table(spark, str(tmp_path / "none"), LAKE_TRADE)
    assert empty.count() == 0 and empty.schema.names == LAKE_TRADE.names
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet")
    with pytest.raises(Py4JJavaError):
        read_table(spark, str(tmp_path / "bad"), LAKE_TRADE).count()


def test_publish_replaces_only_the_months_sent(spark, tmp_path):
    mart, serving = str(tmp_path / "mart"), str(tmp_path / "serving")

    def candle(day, price):
        return (day, "a", *[price] * 6, 1)

    rows = [candle(START, 1.0), candle(START + timedelta(days=40), 2.0)]
    mart_rows = spark.createDataFrame(rows, CANDLE)
    write_partitions(with_period_date(mart_rows), mart, ["period_date"])
    publish_candles(spark, mart, serving)
    publish_candles(spark, mart, serving)
    assert read_serving(spark, serving).count() == 2
    assert partition_values(spark, serving, "period_month") == ["202401", "202402"]
    # the mart's February changes; January of the serving copy must not be touched
    changed = spark.createDataFrame([candle(START + timedelta(days=40), 9.0)], CANDLE)
    write_partitions(with_period_date(changed), mart, ["period_date"])
    before = {f for f in read_serving(spark, serving).inputFiles() if "202401" in f}
    publish_candles(spark, mart, serving, since=START + timedelta(days=39))
    got = {r.period_month: r.close_price for r in read_serving(spark, serving).collect()}
    assert got == {202401: 1.0, 202402: 9.0}
    assert before <= set(read_serving(spark, serving).inputFiles())


def test_publishing_catches_up(spark, raw, tmp_path):
    at = lambda name: str(tmp_path / name)
    early = raw.where(F.col("trade_time") < F.lit(START + timedelta(days=20)))
    later = raw.withColumns(
        {"trade_id": F.col("trade_id") + 10_000_000, "trade_time": F.col("trade_time") + F.expr("interval 60 days")}
    )

    def load(rows):
        dated = rows.withColumn("insert_date", F.to_date("trade_time"))
        dated.withColumn("batch", F.lit("b")).write.partitionBy("insert_date", "batch").mode("append").parquet(at("raw"))

    def whole():
        same(read_serving(spark, at("serving")).select(*CANDLE.names), read_mart(spark, at("mart")).select(*CANDLE.names))

    load(early)
    refresh_mart(spark, at("raw"), at("mart"), at("stage"))  # its publish is lost
    load(later)
    refresh_and_publish(spark, at("raw"), at("mart"), at("stage"), at("serving"))
    whole()
    assert len(partition_values(spark, at("serving"), "period_month")) > 1
    before = {f for f in read_serving(spark, at("serving")).inputFiles() if "202401" in f}
    refresh_and_publish(spark, at("raw"), at("mart"), at("stage"), at("serving"))
    whole()
    assert before and before <= set(read_serving(spark, at("serving")).inputFiles())


def test_rows_staged_for_another_table_are_refused(spark, tmp_path):
    rows = with_period_date(spark.createDataFrame([(START, "a", *[1.0] * 6, 1)], CANDLE))
    staging, mart, other = (str(tmp_path / name) for name in ("staging", "mart", "other"))
    stage(rows, staging, mart, ["period_date"])
    with pytest.raises(ValueError):
        apply_staged(spark, staging, other, ["period_date"])
    assert apply_staged(spark, staging, mart, ["period_date"])
    assert partition_values(spark, mart, "period_date") == ["2024-01-01"]


def test_failed_publish_raises(spark, tmp_path):
    (tmp_path / "serving").write_text("in the way")
    mart = str(tmp_path / "mart")
    rows = spark.createDataFrame([(START, "a", *[1.0] * 6, 1)], CANDLE)
    write_partitions(with_period_date(rows), mart, ["period_date"])
    with pytest.raises(Py4JJavaError):
        publish_candles(spark, mart, str(tmp_path / "serving"))


def test_retention_counts_whole_seconds(spark):
    as_of = datetime(2024, 1, 4, 0, 0, 0, 700000)
    times = [START + timedelta(milliseconds=ms) for ms in (-1, 0, 500, 999, 1000, 5000)]
    rows = spark.createDataFrame([(t,) for t in times], "trade_time timestamp")
    dated = rows.withColumn("insert_date", F.to_date("trade_time"))
    # floor(time) + 3 days must lie after floor(as_of)
    for frame in (rows, dated):
        assert retain(frame, F.lit(as_of)).count() == 2
    assert retain(rows, F.lit(START), days=1).count() == 6
    # without a time of its own it counts from the newest row
    assert retain(dated, days=1).count() == retain(rows, days=1).count() == 6
    next_day = rows.selectExpr("trade_time + interval 1 day AS trade_time")
    assert retain(rows.unionByName(next_day), days=1).count() == 6


def test_retention_prunes_partitions(spark, raw, tmp_path):
    path = str(tmp_path / "rt")
    raw.withColumn("insert_date", F.to_date("trade_time")).write.partitionBy("insert_date").parquet(path)
    kept = retain(spark.read.parquet(path), F.lit(datetime(2024, 1, 30)))
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(insert_date" in plan and "PushedFilters: [IsNotNull(trade_time)" in plan


def test_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (rng.randrange(30), rng.choice("ab"), Decimal(rng.randrange(3)), START + timedelta(seconds=rng.randrange(4)))
        for _ in range(500)
    ] + [(1, "a", Decimal(7), START)] * 300  # one key holds a third of all rows
    best = {}
    for i, s, p, t in rows:
        best[i, s] = max(best.get((i, s), (t, p)), (t, p))
    table = spark.createDataFrame(rows, "trade_id long, symbol string, price decimal(20,8), trade_time timestamp")
    got = {
        (r.trade_id, r.symbol): (r["at"], r.price)
        for r in dedup.dedup_trades(table)
        .withColumn("at", F.col("trade_time").cast("timestamp_ntz")).collect()
    }
    assert got == best


def test_dedup_merges_copies_before_the_shuffle(raw):
    plan = dedup.dedup_trades(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning") > 0


def test_key_filters_reach_the_scan_of_a_dedup(raw, tmp_path, spark):
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    found = dedup.dedup_trades(spark.read.parquet(path)).where("trade_id = 17 AND symbol = 'view'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(trade_id,17), EqualTo(symbol,view)" in plan
    assert found.count() == raw.where("trade_id = 17 AND symbol = 'view'").count()


def test_dedup_with_hot_keys_nulls_and_all_kinds_of_versions(spark):
    """One key holds a third of all rows as copies, another as versions; nulls change places."""
    at = lambda s: START + timedelta(seconds=s)
    rows = [(1, "a", Decimal(7), Decimal(1), at(0), "x")] * 400
    rows += [(2, "a", Decimal(i % 50), Decimal(1), at(i % 3), "x") for i in range(400)]
    rows += [(i, "b", Decimal(i), None, at(i), "y") for i in range(10, 400)]
    rows += [(5, None, None, Decimal(5), at(1), "n"), (5, None, Decimal(5), None, at(1), "n")]
    rows += [(6, "c", Decimal(1), Decimal(1), None, "p"), (6, "c", Decimal(1), Decimal(1), None, None)]
    rows += [(None, "a", Decimal(1), None, at(1), "x")] * 3
    table = spark.createDataFrame(rows, "trade_id long, symbol string, price decimal(20,8), quantity decimal(20,8), trade_time timestamp, note string")
    low = lambda v: (v is not None, v if v is not None else 0)
    best = {}
    for r in rows:
        order = (low(r[4]) if r[4] else (False, START), low(r[2]), low(r[3]), (r[5] is not None, r[5] or ""))
        if r[0] is not None and (r[:2] not in best or order > best[r[:2]][0]):
            best[r[:2]] = (order, r)
    got = dedup.dedup_trades(table).withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))
    want = [r for _, r in best.values()] + rows[-3:]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_bitmaps_know_their_ids(spark):
    ids = [-40_000, -1, 0, 1, 7, 8, 9, 32_767, 32_768, 32_769, 2**62, 5 * 32_768]
    table = spark.createDataFrame([(i, "a" if i % 2 else None, "d1" if i < 9 else "d2") for i in ids], "trade_id long, symbol string, day string")
    index = bitmaps.id_bitmaps(table, "day")
    asked = [*ids, -2, 2, 10, 32_766, 2**62 + 1]
    places = spark.createDataFrame([(i, "a" if i % 2 else None) for i in asked], "asked long, of string").select(
        "asked", "of", F.bitmap_bucket_number("asked").alias("b"), F.bitmap_bit_position("asked").alias("p")
    )
    met = index.join(places, index["symbol"].eqNullSafe(places["of"]) & (index["bucket"] == places["b"]))
    held = {r[0] for r in met.where(bitmaps.has_bit(F.col("bits"), F.col("p"))).select("asked").collect()}
    assert held == set(ids)

    def days(*rows):
        probe = spark.createDataFrame(list(rows), "trade_id long, symbol string")
        return sorted(r[0] for r in bitmaps.holders(index, bitmaps.id_bitmaps(probe), "day").collect())

    assert days((7, "a")) == ["d1"] and days((7, None)) == [] and days((6, "a")) == []
    assert days((0, None), (9, "a"), (3, "a")) == ["d1", "d2"] and days((None, "a")) == []


def test_lake_of_both_layouts_is_read_whole(spark, tmp_path):
    lake = str(tmp_path / "lake")
    rows = ev.trades_of(ev.read_events(spark, DATA)).limit(90).persist()
    rows.where("trade_id % 3 = 0").write.parquet(lake)
    for n in (1, 2):
        part = rows.where(F.col("trade_id") % 3 == n).withColumn("batch", F.lit(f"b{n}"))
        part.write.mode("append").partitionBy("batch").parquet(lake)
    same(read_lake(spark, lake), rows)
    assert read_lake(spark, str(tmp_path / "none")).count() == 0


def test_narrow_dedup_keeps_the_same_winner(raw):
    doubled = raw.unionByName(raw.withColumn("price", F.col("price") + F.lit(Decimal(1)).cast("decimal(18,8)")))
    doubled = doubled.withColumn("price", F.col("price").cast("decimal(20,8)"))
    narrow = dedup.dedup_trades(doubled.select(*candles.CANDLE_INPUT))
    same(narrow, dedup.dedup_trades(doubled).select(*candles.CANDLE_INPUT))


def test_last_load_wins(spark):
    def load(n, price, *minutes):
        rows = [(START + timedelta(minutes=m), "a", *[price] * 6, 1) for m in minutes]
        return spark.createDataFrame(rows, CANDLE).withColumn("load_id", F.lit(n))

    loads = load(1, 5.0, 0, 1).unionByName(load(2, 3.0, 1, 2))
    got = dedup.dedup_candles(loads)
    assert "load_id" not in got.columns
    assert [r.close_price for r in got.orderBy("period_start").collect()] == [5.0, 3.0, 3.0]


def test_zero_prices_give_null_ratios(spark):
    flat = spark.createDataFrame([(START, "a", *[0.0] * 6, 1)], CANDLE)
    assert analytics.candle_spread(flat).first().spread_ratio is None
    assert analytics.candle_stats(flat).first().change_pct is None
    nothing = spark.createDataFrame(
        [("a", Decimal(0), None)], "symbol string, amount_usdt decimal(20,8), is_buyer_maker boolean"
    )
    got = analytics.market_pressure(nothing).first()
    assert (got.buy_count, got.sell_count, got.imbalance) == (1, 0, None)


def test_as_of_can_be_given(raw):
    as_of = raw.agg(F.max("trade_time")).first()[0]
    same(analytics.volume_by_bucket(raw), analytics.volume_by_bucket(raw, as_of=F.lit(as_of)))
    base = candles.ohlcv(raw).persist()
    newest = base.agg(F.max("period_start")).first()[0]
    same(analytics.candle_stats(base), analytics.candle_stats(base, as_of=F.lit(newest)))


def test_whales_without_limit_and_pushdown(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    assert analytics.whale_trades(stored, 100, None).count() == raw.where("amount_usdt >= 100").count()
    plan = analytics.whale_trades(stored, 100)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(amount_usdt,100.00000000)" in plan and "TakeOrderedAndProject" in plan



def test_hot_day_is_split_when_written(spark, tmp_path):
    """One day far above the advised partition size ends up in several files."""
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    try:
        rows = spark.range(0, 300000, 1, 8).select(
            F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") < 290000, 0).otherwise(F.col("id") % 3 + 1).alias("day"),
        )
        write_partitions(rows, path, ["day"], ["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(list((tmp_path / "hot" / "day=0").glob("*.parquet"))) > 3
    assert spark.read.parquet(path).count() == 300000


def test_scratch_follows_the_clusters_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{base}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# Connectors that need a service: only what can be seen without one


class Recorder:
    """Stands in for a reader or writer and notes its options."""

    def __init__(self):
        self.seen = {}
        self.write = self

    def repartition(self, tasks):
        self.seen["tasks"] = tasks
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def save(self):
        self.seen["saved"] = True

    def load(self):
        return self.seen


def test_jdbc_options(monkeypatch):
    rows = Recorder()
    append_jdbc(rows, "jdbc:x", "t", user="u")
    assert rows.seen["saved"] and rows.seen["mode"] == "append"
    assert {"url", "dbtable", "batchsize", "numPartitions", "user"} <= set(rows.seen)
    assert rows.seen["tasks"] == rows.seen["numPartitions"]  # dealt by a shuffle, not by narrowing the plan

    class Session:
        read = Recorder()

    seen = read_jdbc(Session, "jdbc:x", "t", lower=START, upper=START + timedelta(days=1), partitions=4)
    assert seen["numPartitions"] == 4 and seen["lowerBound"] == "2024-01-01 00:00:00"


def test_kafka_options():
    class Session:
        readStream = Recorder()

    seen = kafka_stream(Session, "host:1", "trades")
    assert seen["subscribe"] == "trades" and seen["startingOffsets"] == "earliest"
    assert seen["maxOffsetsPerTrigger"] == 50000


def test_kafka_connector_is_absent_here(spark):
    with pytest.raises(AnalysisException):
        kafka_stream(spark, "host:1", "trades")
