"""What a table's days hold and which of them are closed, kept beside the table.

A day's *content* is one number: the exclusive or of a hash of every file's name and length, and of what
compactions have put in place of what. Tasks compute it, the driver sees a number per day. A
compaction changes the files and logs the difference, so the content stays the same.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sinks.tables import child_names, create_empty, delete, exists
from tickloom.sources.lake import read_table

MERGES = "_MERGES"  # what compactions exchanged, beside the table's days
CLOSED = "_CLOSED"  # one empty file per horizon: days before it take no more trades
_MERGE = "day string, exchanged long"
_NOTE = "day string, content long"


def _files(spark: SparkSession, paths: list[str], by: str) -> DataFrame:
    """day and hash of every Parquet file below ``paths``, from names and lengths alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    name = F.regexp_extract("path", rf"/({by}=[^/]+/.*)$", 1)
    files = listed.load(paths).select(name.alias("name"), "length")
    return files.select(
        F.regexp_extract("name", rf"^{by}=(\d{{4}}-\d\d-\d\d)/", 1).alias("day"), F.xxhash64("name", "length").alias("hash")
    ).where("day <> ''")


def files_of_days(spark: SparkSession, paths: list[str], by: str) -> dict[str, int]:
    """One number per day for its files below ``paths``."""
    return _by_day(_files(spark, paths, by)) if paths else {}


def _by_day(files: DataFrame) -> dict[str, int]:
    return {r["day"]: r["content"] for r in files.groupBy("day").agg(F.bit_xor("hash").alias("content")).collect()}


def log_merges(spark: SparkSession, path: str, before: dict[str, int], after: dict[str, int]) -> None:
    """Note that files ``before`` of some days were replaced by ``after`` without a change of content."""
    entries = spark.createDataFrame([(d, before[d] ^ after[d]) for d in sorted(before.keys() & after.keys())], _MERGE)
    entries.coalesce(1).write.mode("append").parquet(f"{path}/{MERGES}")


def day_contents(spark: SparkSession, path: str, by: str = "insert_date") -> dict[str, int]:
    """The content of every day of the table. Call it before the table itself is listed."""
    if not any(name.startswith(f"{by}=") for name in child_names(spark, path)):
        return {}
    files = _files(spark, [path], by)
    if exists(spark, f"{path}/{MERGES}"):
        merged = spark.read.schema(_MERGE).parquet(f"{path}/{MERGES}")
        days = files.select("day").distinct()
        files = files.unionByName(merged.withColumnRenamed("exchanged", "hash").join(days, "day", "left_semi"))
    return _by_day(files)


def read_contents(spark: SparkSession, note: str) -> dict[str, int]:
    """The contents last written to ``note``; none if that never ended well."""
    for version in sorted(child_names(spark, note), reverse=True):
        if exists(spark, f"{note}/{version}/_SUCCESS"):
            return {r["day"]: r["content"] for r in read_table(spark, f"{note}/{version}", _schema(spark, _NOTE)).collect()}
    return {}


def write_contents(spark: SparkSession, note: str, contents: dict[str, int]) -> None:
    """Write a new version of the note, then drop the older ones. A write that dies leaves them in force."""
    found = child_names(spark, note)
    last = max((int(v) for v in found if v.isdigit()), default=0)
    rows = spark.createDataFrame(sorted(contents.items()), _NOTE)
    rows.coalesce(1).write.mode("overwrite").parquet(f"{note}/{last + 1:012d}")
    for version in found:
        delete(spark, f"{note}/{version}")


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


def close_before(spark: SparkSession, path: str, day: date) -> None:
    """Take no more trades for days before ``day``."""
    create_empty(spark, f"{path}/{CLOSED}/{day.isoformat()}")


def closed_before(spark: SparkSession, path: str) -> date | None:
    """The first day of the table that still takes trades; None if all do."""
    horizons = child_names(spark, f"{path}/{CLOSED}")
    return date.fromisoformat(max(horizons)) if horizons else None
