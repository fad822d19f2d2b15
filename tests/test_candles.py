"""Candles, their order rules, roll-up, refresh and rolling windows."""

import random
import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickloom.operators import analytics, candles, dedup
from tickloom.operators.placement import with_period_date
from tickloom.plans.mart import EPOCH, FOLDED, mart_cutoff, plan_refresh, read_mart, read_raw, refresh_mart
from tickloom.plans.upkeep import compact_days, expire_days
from tickloom.schema import CANDLE, RAW_TRADE
from tickloom.sinks.tables import MARKER, exists, stage, write_partitions
from tickloom.sources import events as ev
from tickloom.sources.lake import partitioned, read_days

START = datetime(2024, 1, 1)


def trades(spark, rows):
    """Rows of (id, symbol, price, seconds after START or None)."""
    full = [
        (
            i,
            s,
            None if p is None else Decimal(str(p)),
            Decimal("1"),
            Decimal("2"),
            None if at is None else START + timedelta(seconds=at),
            None,
            False,
        )
        for i, s, p, at in rows
    ]
    return spark.createDataFrame(full, RAW_TRADE)


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0]


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def raw(spark):
    return ev.raw_trades_of(ev.read_events(spark, DATA)).persist()


def test_equal_times_are_ordered_by_id(spark):
    got = one(candles.ohlcv(trades(spark, [(3, "a", 30, 1), (1, "a", 10, 1), (2, "a", 20, 1)])))
    assert (got.open_price, got.close_price) == (10.0, 30.0)
    assert (got.high_price, got.low_price) == (30.0, 10.0)
    assert (got.total_volume, got.total_amount_usdt, got.trades_count) == (3.0, 6.0, 3)


def test_null_id_comes_after_all_ids(spark):
    got = one(candles.ohlcv(trades(spark, [(None, "a", 9, 1), (5, "a", 1, 1), (-5, "a", 2, 1)])))
    assert (got.open_price, got.close_price, got.trades_count) == (2.0, 9.0, 2)


def test_null_price_can_open_and_null_time_is_left_out(spark):
    got = one(candles.ohlcv(trades(spark, [(1, "a", None, 1), (2, "a", 4, 2), (3, "a", 99, None)])))
    assert (got.open_price, got.close_price, got.high_price) == (None, 4.0, 4.0)
    assert got.trades_count == 2


def test_empty_input(spark):
    assert candles.ohlcv(trades(spark, [])).count() == 0


def test_open_and_close_for_any_id_and_time(spark):
    """The two order keys together agree with a sort by (time, id, NULL last)."""
    rng = random.Random(7)
    ids = [None, 0, 1, -1, 2**63 - 1, -(2**63), 2**47 - 1, 2**47 - 2, 2**36, 2**41, 12345]
    spots = [0, 0.001, 0.000001, 59.999, 59.999999, 3599.5, 86399.999999, 40000, -86400, -0.001]
    rows = [
        (rng.choice(ids), rng.choice("ab"), n, rng.choice(spots) + rng.choice([0, 0, 60, 86400]))
        for n in range(400)
    ]
    # one price per (id, symbol, time): exact ties have no defined winner
    rows = list({(i, s, at): (i, s, p, at) for i, s, p, at in rows}.values())
    table = trades(spark, rows).persist()
    order = F.struct("trade_time", F.col("trade_id").isNull(), "trade_id")
    for unit in ("minute", "hour", "day", 7 * 86400):
        want = table.groupBy(
            F.window("trade_time", f"{candles.seconds_of(unit)} seconds")["start"].alias("period_start"),
            "symbol",
        ).agg(
            F.min_by("price", order).cast("double").alias("open_price"),
            F.max_by("price", order).cast("double").alias("close_price"),
        )
        got = candles.ohlcv(table, unit)
        same(got.select("period_start", "symbol", "open_price", "close_price"), want)
    price = analytics.current_price(table).select("symbol", "price")
    same(price, table.groupBy("symbol").agg(F.max_by("price", order).cast("double").alias("price")))


def test_candle_aggregation_needs_no_sort(raw):
    plan = candles.ohlcv(raw)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_rollup_equals_candles_from_trades(raw):
    for unit in ("hour", "day"):
        up = candles.rollup_candles(candles.ohlcv(raw), unit)
        sums = ("total_volume", "total_amount_usdt")
        flat = [f.withColumns({c: F.round(c, 6) for c in sums}) for f in (up, candles.ohlcv(raw, unit))]
        same(*flat)


# Refresh


def mart_of(spark, minutes, symbol="a"):
    rows = [(START + timedelta(minutes=m), symbol, *[float(m)] * 6, 1) for m in minutes]
    return spark.createDataFrame(rows, CANDLE)


def test_cutoff(spark, tmp_path):
    for n, (minutes, want) in enumerate(
        [
            ([], None),
            ([0, 30, 60], None),  # span of one hour: nothing is left
            ([0, 30, 61], 0),
            ([0, 50, 200, 259, 260], 50),
            ([0, 5 * 24 * 60], 0),  # days apart: found partition by partition
        ]
    ):
        mart = str(tmp_path / f"mart{n}")
        write_partitions(with_period_date(mart_of(spark, minutes)), mart, ["period_date"])
        expected = EPOCH if want is None else (START + timedelta(minutes=want)).replace(tzinfo=EPOCH.tzinfo)
        assert mart_cutoff(spark, mart) == expected


@pytest.mark.parametrize("late", [True, False])
def test_refresh_without_news_changes_nothing_and_keeps_keys_unique(spark, raw, tmp_path, late):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    raw.withColumn("insert_date", F.to_date("trade_time")).write.partitionBy("insert_date").parquet(table)
    full = candles.ohlcv(raw)
    for _ in range(2):
        refresh_mart(spark, table, mart, staging, late=late)
        got = read_mart(spark, mart)
        assert got.count() == got.select("symbol", "period_start").distinct().count()
        same(got.select(*full.columns), full)


def test_filter_before_dedup_keeps_the_winner(spark):
    rows = [(1, "a", 1, 10), (1, "a", 2, 200), (2, "a", 3, 130), (2, "a", 4, 20), (3, "a", 5, 5)]
    table = trades(spark, rows)
    cutoff = F.lit(START + timedelta(seconds=120))
    late = dedup.dedup_trades(table).where(F.col("trade_time") >= cutoff)
    same(candles.candles_from(table, cutoff), candles.ohlcv(late))


def test_replays_do_not_inflate_candles(raw):
    same(
        candles.candles_from(raw.unionByName(raw), F.lit(EPOCH)),
        candles.ohlcv(raw),
    )


def test_trades_without_id_survive_dedup(spark):
    rows = [(None, "a", 1, 1), (None, "a", 2, 1), (None, "a", 2, 1), (4, "a", 1, 1), (4, "a", 1, 1)]
    assert dedup.dedup_trades(trades(spark, rows)).count() == 4


def test_mart_job(spark, raw, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    assert refresh_mart(spark, table, mart, staging) == EPOCH  # nothing there yet
    assert read_mart(spark, mart).count() == 0
    dated = raw.withColumn("insert_date", F.to_date("trade_time"))
    newest = raw.agg(F.max("trade_time")).first()[0]
    early = F.col("trade_time") < newest - timedelta(hours=30)
    dated.where(early).write.partitionBy("insert_date").parquet(table)
    refresh_mart(spark, table, mart, staging, late=False)
    dated.where(~early).write.mode("append").partitionBy("insert_date").parquet(table)
    cutoff = mart_cutoff(spark, mart)
    assert refresh_mart(spark, table, mart, staging, late=False) == cutoff
    full = candles.ohlcv(raw)
    same(read_mart(spark, mart).select(*full.columns), full)
    refresh_mart(spark, table, mart, staging, late=False)
    same(read_mart(spark, mart).select(*full.columns), full)
    assert not exists(spark, staging)


def test_late_trades_and_superseded_versions_reach_the_mart(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    day, loaded = 86_400, []
    loads = (
        [(1, "a", 1, 10), (2, "a", 2, 3 * day), (3, "b", 3, 20), (4, "c", 4, day)],
        [(5, "a", 5, 11), (6, "d", 6, 2 * day)],  # days behind the newest candle
        [(3, "b", 7, 3 * day + 5), (4, "c", 8, 2 * day)],  # take trades from older days; one is left empty
        [],
    )
    for rows in loads:
        loaded += rows
        new = trades(spark, rows).withColumn("insert_date", F.to_date("trade_time"))
        new.write.mode("append").partitionBy("insert_date").parquet(table)
        refresh_mart(spark, table, mart, staging)
        full = candles.ohlcv(dedup.dedup_trades(trades(spark, loaded)))
        same(read_mart(spark, mart).select(*full.columns), full)


def loaded(spark, table, rows, batch="b"):
    dated = trades(spark, rows).withColumns({"insert_date": F.to_date("trade_time"), "batch": F.lit(batch)})
    dated.write.mode("append").partitionBy("insert_date", "batch").parquet(table)


def test_a_late_trade_reads_its_own_days_only(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    day = 86_400
    loaded(spark, table, [(d * 40_000 + i, "a", 1, d * day + i) for d in range(9) for i in range(5)])
    refresh_mart(spark, table, mart, staging)
    assert plan_refresh(spark, table, mart).changed == []
    loaded(spark, table, [(4 * 40_000 + 7, "a", 1, 4 * day + 7)])
    work = plan_refresh(spark, table, mart)
    assert work.changed == work.rebuild == work.read == ["2024-01-05"]
    read = read_days(spark, table, partitioned(RAW_TRADE, "insert_date"), work.read).inputFiles()
    assert read and all("insert_date=2024-01-05" in f for f in read)
    refresh_mart(spark, table, mart, staging)
    # a version of a trade of the third day arrives for the seventh; an old one of the eighth for the first
    loaded(spark, table, [(2 * 40_000 + 1, "a", 9, 6 * day), (7 * 40_000 + 1, "a", 9, 0)])
    work = plan_refresh(spark, table, mart)
    assert work.changed == ["2024-01-01", "2024-01-07"]
    assert work.rebuild == ["2024-01-01", "2024-01-03", "2024-01-07"]
    assert work.read == ["2024-01-01", "2024-01-03", "2024-01-07", "2024-01-08"]
    refresh_mart(spark, table, mart, staging)
    full = candles.ohlcv(dedup.dedup_trades(read_raw(spark, table)))
    same(read_mart(spark, mart).select(*full.columns), full)


def test_a_trade_that_is_taken_back_gives_its_older_version_the_place(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    loaded(spark, table, [(1, "a", 5, 10), (2, "a", 6, 20)])
    loaded(spark, table, [(1, "a", 7, 86_410), (3, "a", 8, 86_420)], "wrong")
    refresh_mart(spark, table, mart, staging)
    shutil.rmtree(tmp_path / "raw" / "insert_date=2024-01-02")
    loaded(spark, table, [(3, "a", 8, 86_420)], "right")
    refresh_mart(spark, table, mart, staging)
    full = candles.ohlcv(read_raw(spark, table))
    same(read_mart(spark, mart).select(*full.columns), full)


def test_candles_of_expired_days_stay(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    day = 86_400
    loaded(spark, table, [(i, "a", i + 1, 60 * i) for i in range(30)] + [(90 + d, "a", 1, d * day) for d in range(1, 6)])
    refresh_mart(spark, table, mart, staging)
    assert expire_days(spark, table, datetime(2024, 1, 6)) == ["2024-01-01", "2024-01-02"]
    before = read_mart(spark, mart).collect()
    refresh_mart(spark, table, mart, staging)
    assert sorted(read_mart(spark, mart).collect()) == sorted(before)
    # late trades that got into closed days, one of them a newer version of nothing that is left
    loaded(spark, table, [(500, "a", 1, 30), (501, "a", 1, day + 30), (502, "a", 1, 4 * day + 120)], "late")
    refresh_mart(spark, table, mart, staging)
    after = {(r.period_start, r.symbol): r for r in read_mart(spark, mart).collect()}
    assert len(after) == len(before) + 1
    assert all(after[r.period_start, r.symbol] == r for r in before)
    # the next expiry keeps them aside
    assert expire_days(spark, table, datetime(2024, 1, 6)) == ["2024-01-01", "2024-01-02"]
    kept = spark.read.parquet(f"{table}_quarantine").collect()
    assert sorted((r.trade_id, r.reject_reason) for r in kept) == [(500, "day_closed"), (501, "day_closed")]


def test_a_note_that_was_not_finished_locks_nothing_out(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    loaded(spark, table, [(1, "a", 5, 10)])
    (tmp_path / "mart" / FOLDED).mkdir(parents=True)  # emptied, then died
    refresh_mart(spark, table, mart, staging)
    assert plan_refresh(spark, table, mart).changed == []
    (tmp_path / "mart" / FOLDED / "000000000009").mkdir()  # begun, not finished: the older one counts
    assert plan_refresh(spark, table, mart).changed == []
    loaded(spark, table, [(2, "a", 6, 90_000)])
    refresh_mart(spark, table, mart, staging)
    assert plan_refresh(spark, table, mart).changed == []
    assert read_mart(spark, mart).count() == 2
    assert len(list((tmp_path / "mart" / FOLDED).glob("0*"))) == 1


def test_compaction_is_no_news(spark, tmp_path):
    table, mart, staging = (str(tmp_path / n) for n in ("raw", "mart", "staging"))
    for n in range(3):
        loaded(spark, table, [(n, "a", 5, 10 + n), (50 + n, "a", 5, 86_400 + n)], f"b{n}")
    refresh_mart(spark, table, mart, staging)
    assert compact_days(spark, table, staging, RAW_TRADE) == ["2024-01-01", "2024-01-02"]
    assert plan_refresh(spark, table, mart).changed == []
    # merged again with more rows: only the day that got them is news
    loaded(spark, table, [(7, "a", 5, 17)], "b7")
    assert compact_days(spark, table, staging, RAW_TRADE) == ["2024-01-01"]
    assert plan_refresh(spark, table, mart).changed == ["2024-01-01"]
    refresh_mart(spark, table, mart, staging)
    assert compact_days(spark, table, staging, RAW_TRADE) == []
    full = candles.ohlcv(read_raw(spark, table))
    same(read_mart(spark, mart).select(*full.columns), full)


def test_buckets_must_not_cross_midnight(spark, tmp_path):
    with pytest.raises(ValueError):
        refresh_mart(spark, *(str(tmp_path / n) for n in ("raw", "mart", "staging")), bucket=7 * 3600)


def test_mart_job_finishes_what_a_dead_run_staged(spark, raw, tmp_path):
    mart, staging = str(tmp_path / "mart"), str(tmp_path / "staging")
    full = with_period_date(candles.ohlcv(raw))
    days = [r[0] for r in full.select("period_date").distinct().orderBy("period_date").collect()]
    write_partitions(full.where(F.col("period_date") != F.lit(days[3])), mart, ["period_date"])
    # a complete stage is applied by the next run, although its own cutoff lies days later
    stage(full.where(F.col("period_date") == F.lit(days[3])), staging, mart, ["period_date"])
    table = str(tmp_path / "raw")
    raw.withColumn("insert_date", F.to_date("trade_time")).write.partitionBy("insert_date").parquet(table)
    refresh_mart(spark, table, mart, staging)
    same(read_mart(spark, mart).select(*CANDLE.fieldNames()), full.drop("period_date"))
    # an incomplete one is thrown away
    stage(full.where("symbol = 'view'"), staging, mart, ["period_date"])
    (tmp_path / "staging" / MARKER).unlink()
    refresh_mart(spark, table, mart, staging)
    same(read_mart(spark, mart).select(*CANDLE.fieldNames()), full.drop("period_date"))


def test_mart_reads_only_the_tail(spark, raw, tmp_path):
    table = str(tmp_path / "raw")
    raw.withColumn("insert_date", F.to_date("trade_time")).write.partitionBy("insert_date").parquet(table)
    cutoff = F.lit(datetime(2024, 1, 30, 5))
    plan = candles.candles_from(read_raw(spark, table), cutoff)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(insert_date" in plan
    assert "GreaterThanOrEqual(trade_time," in plan
    assert "event_time" not in plan.split("ReadSchema: ")[1].split("\n")[0]


# Windows over candles


@pytest.mark.parametrize("seconds", [86400, 3600, 7 * 86400])
def test_rolling_equals_a_range_frame(raw, seconds):
    base = candles.ohlcv(raw).persist()
    w = (
        Window.partitionBy("symbol")
        .orderBy(F.col("period_start").cast("long"))
        .rangeBetween(-(seconds - 1), 0)
    )

    def exact(c):
        return F.sum(F.col(c).cast("decimal(28,8)")).over(w).cast("double")

    want = base.select(
        "period_start",
        "symbol",
        exact("total_volume").alias("volume"),
        exact("total_amount_usdt").alias("amount_usdt"),
        F.max("high_price").over(w).alias("highest"),
        F.min("low_price").over(w).alias("lowest"),
    )
    same(analytics.rolling_stats(base, seconds), want)


def test_rolling_edges(spark):
    """A candle exactly one window back is out; gaps of whole blocks are fine."""
    day = 24 * 60
    got = analytics.rolling_stats(mart_of(spark, [0, 1, day, day + 1, 5 * day]))
    by_minute = {
        int((r.t - START).total_seconds() // 60): (r.volume, r.lowest)
        for r in got.withColumn("t", F.col("period_start").cast("timestamp_ntz")).collect()
    }
    assert by_minute == {
        0: (0.0, 0.0),
        1: (1.0, 0.0),
        day: (day + 1.0, 1.0),
        day + 1: (2 * day + 1.0, float(day)),
        5 * day: (5.0 * day, 5.0 * day),
    }
