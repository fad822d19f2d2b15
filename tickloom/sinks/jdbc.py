"""Appending to a warehouse table over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CONNECTIONS = 32
BATCH_ROWS = 10_000


def append_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    load_id: int | None = None,
    connections: int = MAX_CONNECTIONS,
    batch_rows: int = BATCH_ROWS,
    **options: str,
) -> None:
    """Append all rows, at most ``connections`` at a time.

    The rows are dealt to that many tasks by a shuffle: narrowing the plan instead would run the
    scan and all work before the write in as few tasks. Each task commits on its own, so a job that fails midway leaves
    part of its rows. With a ``load_id`` a reader can keep the last load per key after a repeated run.
    """
    if load_id is not None:
        rows = rows.withColumn("load_id", F.lit(load_id).cast("bigint"))
    (
        rows.repartition(connections)
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .options(**options)
        .mode("append")
        .save()
    )
