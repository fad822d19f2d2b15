"""Streams of bus records: from Kafka, or from files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import BUS_MESSAGE

MAX_OFFSETS = 50_000
# By default the file source skips files a week older than the newest it has seen.
ANY_AGE = "36500d"


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_offsets: int | None = MAX_OFFSETS,
    starting: str = "earliest",
    **options: str,
) -> DataFrame:
    """One topic. ``starting`` counts for the first run only; later the checkpoint decides.

    Needs the Kafka connector on the class path. ``max_offsets`` bounds a micro-batch;
    on a large topic raise it, and set ``minPartitions`` to split big Kafka partitions.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.options(**options).load()


def file_stream(
    spark: SparkSession, path: str, max_files: int | None = None, **options: str
) -> DataFrame:
    """Parquet files with the columns of a Kafka record, in the order they were written."""
    reader = spark.readStream.schema(BUS_MESSAGE).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**options).parquet(path)


def text_stream(
    spark: SparkSession, path: str, max_files: int | None = None, **options: str
) -> DataFrame:
    """Raw messages as ``value``, one per line of the text files in a folder."""
    reader = spark.readStream.option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.options(**options).text(path)
