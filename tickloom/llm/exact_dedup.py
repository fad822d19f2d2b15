"""Exact duplicates by a tree of merges of sorted digest runs.

Every document becomes a digest of its normalised text. Slots hold runs: sorted by digest, a
digest once, with the id to keep, the number of copies and a check value. Each task starts with the
run of its own rows. In each round a slot trades with the slots that differ from it in one digit of the
slot number, sending each the digests that have this digit, and merges the ``FAN_IN`` runs
it gets: Spark's sorter, which spills, brings them into one order, and a pass over it in the task
keeps the first row of each digest, the one with the id that stays, with the copies of all. It holds one row
beside the batch. The check value is a second hash with the length, and rows are merged only where it
agrees too; texts are not compared. A text with a billion copies is one row per run before anything is
sent, and after the last round each slot holds a range of digests, not all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import ascii_lower, shuffles, stored

FAN_IN = 8


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_sha256 and a check value (length and a second hash) of each row."""
    clean = normalised(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), clean.alias("clean")).select(
        "doc_id",
        F.sha2(F.col("clean").cast("binary"), 256).alias("text_sha256"),
        F.xxhash64("clean", F.octet_length("clean")).alias("check"),
    )


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def _merge(batches):
    """The first row of each run of equal slot, digest and check, with the sum of copies; rows come sorted."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.logical_or.reduce([_changes(batch.column(name)) for name in ("slot", "text_sha256", "check")])
        first = np.flatnonzero(new)
        copies = np.add.reduceat(batch.column("copies").to_numpy(), first)
        rows = batch.take(pa.array(first))
        at = rows.schema.get_field_index("copies")
        rows = rows.set_column(at, rows.schema.field(at), pa.array(copies, pa.int64()))
        yield rows.slice(0, len(first) - 1)
        held = rows.slice(len(first) - 1)  # the next batch may go on with this digest
    if held is not None:
        yield held


def merge_runs(runs: DataFrame, keep: str) -> DataFrame:
    """One row per slot and digest of each partition, in sorted order. Rows of one digest count as equal only
    where the check agrees; of these the first, with the id to keep, stays."""
    order = F.col("keep_id").desc_nulls_last() if keep == "largest" else F.col("keep_id").asc_nulls_last()
    return runs.sortWithinPartitions("slot", "text_sha256", "check", order).mapInArrow(_merge, runs.schema)


def merge_tree(found: DataFrame, keep: str, slots: int) -> DataFrame:
    """The digests with the id to keep and the number of copies, after all rounds."""
    rounds = 1
    while FAN_IN**rounds < slots:
        rounds += 1
    runs = merge_runs(
        found.select(
            (F.spark_partition_id() % FAN_IN**rounds).cast("long").alias("slot"),
            "text_sha256",
            "check",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("copies"),
        ),
        keep,
    )
    address = F.conv(F.substring("text_sha256", 1, 12), 16, 10).cast("long")
    for place in range(rounds):
        unit = FAN_IN**place
        own = F.col("slot").bitwiseAND(F.lit(~((FAN_IN - 1) * unit)))
        digit = F.floor(address / unit) % FAN_IN
        runs = merge_runs(runs.withColumn("slot", (own + digit * unit).cast("long")).repartition("slot"), keep)
    return runs.drop("slot")


def exact_duplicates(
    docs: DataFrame, keep: str = "largest", text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """For every row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty,
    so all null and empty texts are one group. ``keep`` is "largest" or "smallest". Rows that
    repeat an id within one text all refer to themselves and are all kept; a null id is kept
    only where its whole group has no id. An empty table gives an empty result. Other
    columns of ``docs``, whatever their names, are not read.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    found = stored(digests(docs, text, doc_id), "digests")
    groups = merge_tree(found, keep, shuffles(docs.sparkSession))
    return found.join(groups, ["text_sha256", "check"]).select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def without_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, one per text, with all their columns. Rows that share
    id and text are one document, of which one row stays."""
    key = F.struct("doc_id", "text_sha256")
    stay = exact_duplicates(docs, keep).where("kept").select(key.alias("key")).distinct()
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    own = F.struct(F.col("doc_id"), sha.alias("text_sha256")).alias("key")
    keyed = docs.select(own, F.struct(*docs.columns).alias("row"))
    once = keyed.join(stay, "key", "left_semi").dropDuplicates(["key"])
    return once.select(*(F.col(f"row.`{c}`") for c in docs.columns))
