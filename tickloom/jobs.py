"""The pipeline's jobs on the command line: ``spark-submit`` this file or ``python -m tickloom.jobs``."""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone

from tickloom.operators.ingest import conform_raw
from tickloom.plans.mart import read_mart, refresh_mart
from tickloom.plans.publish import publish_candles, refresh_and_publish
from tickloom.plans.upkeep import compact_days, expire_days
from tickloom.schema import CANDLE_COLUMNS, RAW_TRADE, REALTIME_TRADE
from tickloom.session import build_session
from tickloom.sinks.jdbc import append_jdbc
from tickloom.sources.bus import MAX_OFFSETS, file_stream, kafka_stream, text_stream
from tickloom.sources.lake import read_lake
from tickloom.streaming.archive import load_and_archive, load_to_jdbc
from tickloom.streaming.ingest import ingest_realtime, ingest_to_lake, normalize_to_lake
from tickloom.streaming.live import LIVE_CANDLE, LIVE_IDS, live_candles, merge_live_candles, merge_live_ids


def _bus(spark, args):
    if args.files:
        return file_stream(spark, args.files, args.max_files)
    return kafka_stream(spark, args.servers, args.topic, args.max_offsets)


def _lake(spark, args):
    messages = _bus(spark, args)
    ingest_to_lake(messages, args.lake, args.quarantine, args.checkpoint, args.every).awaitTermination()


def _realtime(spark, args):
    messages = _bus(spark, args)
    ingest_realtime(messages, args.table, args.checkpoint, args.every, args.quarantine).awaitTermination()


def _live(spark, args):
    query = live_candles(
        _bus(spark, args), args.table, args.checkpoint, args.every, args.bucket, args.trades, args.quarantine
    )
    query.awaitTermination()


def _load(spark, args):
    query = load_and_archive(
        spark, args.lake, args.raw, args.checkpoint, args.archive, args.max_files, quarantine=args.quarantine
    )
    _finish(query)


def _load_jdbc(spark, args):
    _finish(
        load_to_jdbc(
            spark, args.lake, args.url, args.table, args.checkpoint, args.max_files, args.connections,
            **dict(pair.split("=", 1) for pair in args.option),
        )
    )


def _finish(query):
    if query is None:
        print("no lake yet, nothing to load")
    else:
        query.awaitTermination()


def _refresh(spark, args):
    if args.serving:
        cutoff = refresh_and_publish(spark, args.raw, args.mart, args.staging, args.serving, args.bucket)
    else:
        cutoff = refresh_mart(spark, args.raw, args.mart, args.staging, args.bucket)
    print(f"rebuilt from {cutoff.isoformat()}")


def _publish(spark, args):
    publish_candles(spark, args.mart, args.serving)


def _export(spark, args):
    if args.mart:
        rows = read_mart(spark, args.mart).select(*CANDLE_COLUMNS)
    else:
        rows = conform_raw(read_lake(spark, args.lake))
    append_jdbc(
        rows, args.url, args.table, args.load_id, args.connections,
        **dict(pair.split("=", 1) for pair in args.option),
    )


def _compact(spark, args):
    kinds = {
        "raw": {"schema": RAW_TRADE, "sort": ["symbol", "trade_id"]},
        "realtime": {"schema": REALTIME_TRADE, "sort": ["symbol", "trade_id"]},
        "live-candles": {
            "schema": LIVE_CANDLE, "by": "period_date", "merge": merge_live_candles,
            "sort": ["symbol", "period_start"],
        },
        "live-ids": {"schema": LIVE_IDS, "merge": merge_live_ids, "sort": ["symbol", "bucket"]},
    }
    days = compact_days(spark, args.table, args.staging, before=args.before, **kinds[args.kind])
    print(f"merged {len(days)} days")


def _expire(spark, args):
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    print(f"dropped {len(expire_days(spark, args.table, as_of, args.days))} days")


def _normalize(spark, args):
    messages = text_stream(spark, args.messages, args.max_files)
    normalize_to_lake(messages, args.lake, args.quarantine, args.checkpoint, args.every).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *needed, help, **optional):
        sub = jobs.add_parser(name, help=help)
        sub.set_defaults(run=run)
        for option in needed:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            kind = type(default) if default is not None and default != [] else str
            sub.add_argument(f"--{option.replace('_', '-')}", default=default, type=kind)
        return sub

    def from_bus(sub):
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--topic")
        sub.add_argument("--max-offsets", type=int, default=MAX_OFFSETS)
        sub.add_argument("--files", help="folder of bus records, instead of Kafka")
        sub.add_argument("--max-files", type=int)
        sub.add_argument("--every", help="pause between batches; without it the job drains and stops")

    from_bus(job("ingest", _lake, "lake", "quarantine", "checkpoint", help="bus to lake"))
    from_bus(job("realtime", _realtime, "table", "checkpoint", help="bus to real-time trades", quarantine=None))
    from_bus(
        job("live-candles", _live, "table", "checkpoint", help="bus to live candles", bucket="minute",
            trades=None, quarantine=None)
    )
    load = job("load", _load, "lake", "raw", "checkpoint", help="lake to raw table", archive=None, quarantine=None)
    load.add_argument("--max-files", type=int)
    remote = job("load-jdbc", _load_jdbc, "lake", "url", "table", "checkpoint", help="lake to a JDBC table, each file once", connections=32)
    remote.add_argument("--max-files", type=int)
    remote.add_argument("--option", action="append", default=[], help="key=value for the connector")
    job("refresh", _refresh, "raw", "mart", "staging", help="raw table to candle mart",
        serving=None, bucket="minute")
    job("publish", _publish, "mart", "serving", help="whole mart to serving table")
    export = job("export", _export, "url", "table", help="candles or trades to a JDBC table",
                 mart=None, lake=None, connections=32)
    export.add_argument("--load-id", type=int)
    export.add_argument("--option", action="append", default=[], help="key=value for the connector")
    compact = job("compact", _compact, "table", "staging", help="merge small files and versions")
    compact.add_argument("--kind", choices=["raw", "realtime", "live-candles", "live-ids"], default="raw")
    compact.add_argument("--before", type=date.fromisoformat)
    expire = job("expire", _expire, "table", help="drop expired days", days=3)
    expire.add_argument("--as-of", type=datetime.fromisoformat)
    texts = job("normalize", _normalize, "messages", "lake", "quarantine", "checkpoint", help="raw exchange messages (text) to lake")
    texts.add_argument("--max-files", type=int)
    texts.add_argument("--every", help="pause between batches; without it the job drains and stops")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(f"tickloom-{args.job}"), args)


if __name__ == "__main__":
    main()
