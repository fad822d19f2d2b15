"""Writing partitioned Parquet tables so that a repeated write does no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "_COMPLETE"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def write_partitions(
    rows: DataFrame,
    path: str,
    by: list[str],
    sort: list[str] | None = None,
    rebalance: bool = True,
) -> None:
    """Replace exactly the partitions that occur in ``rows``.

    Rebalancing lets adaptive execution cut a large partition value into several files
    and pack small ones, so neither one hot day nor many thin ones hurt; rows that come
    from such files need none. Sorted files carry tight min/max statistics for skipping.
    """
    placed = rows.hint("rebalance", *by) if rebalance else rows
    placed = placed.sortWithinPartitions(*by, *(sort or []))
    (
        placed.write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def write_batch(rows: DataFrame, path: str, by: list[str]) -> None:
    """Add one micro-batch in the tasks that hold it, without a shuffle.

    ``by`` must include columns that name the batch: a replayed batch then replaces its
    own partitions and nothing else.
    """
    (
        rows.write.partitionBy(*by)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """The running batch, named by its query (stable over restarts of a checkpoint) and number."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id:010d}"


def with_batch(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.withColumn("batch", F.lit(batch_name(rows.sparkSession, batch_id)))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _hadoop_path(spark, path)
    return files.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    where, files = _hadoop_path(spark, path)
    if files.exists(where) and not files.delete(where, True):
        raise OSError(f"could not delete {path}")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    where, files = _hadoop_path(spark, path)
    out = files.create(where)
    out.writeUTF(text)
    out.close()


def read_note(spark: SparkSession, path: str) -> str | None:
    where, files = _hadoop_path(spark, path)
    if not files.exists(where):
        return None
    note = files.open(where)
    text = note.readUTF()
    note.close()
    return text


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file whose name says it all."""
    where, files = _hadoop_path(spark, path)
    files.create(where).close()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in one directory; none where there is no such directory."""
    where, files = _hadoop_path(spark, path)
    if not files.exists(where):
        return []
    return [status.getPath().getName() for status in files.listStatus(where)]


def partition_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of a table's topmost partition column, in order, from one directory listing. Rows
    without a value are in a folder of their own, which is left out."""
    values = (n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith(f"{name}="))
    return sorted(v for v in values if v != NULL_PARTITION)


def stage(
    rows: DataFrame,
    staging: str,
    target: str,
    by: list[str],
    drop: list[str] | None = None,
    replaced: list[str] | None = None,
) -> None:
    """Write rows for the table ``target`` whole to ``staging``, then a marker that says so.

    The rows may be computed from the table they are to change. The marker also lists
    directories of that table that the rows replace beyond their own partitions: those in ``drop``, and
    the values of the first partition column in ``replaced`` for which there is no row.
    """
    spark = rows.sparkSession
    delete(spark, staging)
    rows.hint("rebalance", *by).write.partitionBy(*by).parquet(staging)
    left = set(partition_values(spark, staging, by[0])) if replaced else set()
    drop = [*(drop or []), *(f"{by[0]}={v}" for v in replaced or [] if v not in left)]
    where, files = _hadoop_path(spark, f"{staging}/{MARKER}")
    out = files.create(where)
    out.writeUTF(target)
    out.writeInt(len(drop))
    for name in drop:
        out.writeUTF(name)
    out.close()


def apply_staged(
    spark: SparkSession, staging: str, target: str, by: list[str], sort: list[str] | None = None
) -> bool:
    """Copy completely staged rows over their partitions of ``target``; true if there were any.

    Call it before reading ``target`` as well as after staging: a run that died while
    copying is then finished first. Copying the same partitions twice changes nothing. Rows staged for
    another table are refused and stay where they are.
    """
    complete = exists(spark, f"{staging}/{MARKER}")
    if complete:
        staged_for = read_note(spark, f"{staging}/{MARKER}")
        if staged_for != target:
            raise ValueError(f"{staging} holds rows for {staged_for}, not for {target}")
        if partition_values(spark, staging, by[0]):
            write_partitions(spark.read.parquet(staging), target, by, sort, rebalance=False)
        where, files = _hadoop_path(spark, f"{staging}/{MARKER}")
        marker = files.open(where)
        marker.readUTF()
        for _ in range(marker.readInt()):
            delete(spark, f"{target}/{marker.readUTF()}")
        marker.close()
    delete(spark, staging)
    return complete
