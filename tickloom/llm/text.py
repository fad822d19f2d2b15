"""Column expressions shared by the operators on documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id's digits falls into the part left out of training; never null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the shared folder and read back, so that later steps do not
    depend on the tasks (or executors) that made them."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def even_keys(spark: SparkSession, parts: int) -> list[int]:
    """One key for each of ``parts`` shuffle partitions, in their order, so that data dealt out by
    these keys is spread evenly, one key to a partition."""
    tries = 32 * parts
    while True:
        place = F.pmod(F.hash("id"), F.lit(parts))
        rows = spark.range(tries).groupBy(place.alias("place")).agg(F.min("id").alias("key")).collect()
        if len(rows) == parts:
            return [r["key"] for r in sorted(rows, key=lambda r: r["place"])]
        tries *= 2
