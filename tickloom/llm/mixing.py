"""Mixing sources to target weights: repetition rates per source, copies per document."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import stored, word_count

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SALTS = 32
BROADCAST_SOURCES = 10_000


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds each source's place in code point order (null last) without one task seeing all."""
    runs = stored(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("at", F.monotonically_increasing_id()),
        "sources",
    )
    run = F.shiftright("at", 33)
    sizes = {r["run"]: r["n"] for r in runs.groupBy(run.alias("run")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    if not starts:
        return runs.select("source", "source_size", F.col("at").alias("place"))
    # as Arrow, since rows from a Python list start Python workers on the executors, which then stay
    columns = (pa.array(c, pa.int64()) for c in zip(*starts, strict=True))
    first = runs.sparkSession.createDataFrame(pa.table(dict(zip(("run", "before"), columns, strict=True))))
    rank = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("before")
    return runs.withColumn("run", run).join(F.broadcast(first), "run").select(
        "source", "source_size", rank.alias("place")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """source, source_size, target for rows of (source, size).

    The targets share the total size by weight. A target above ``most`` times its source's
    size stops there and the excess goes to the others by weight, until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.col("place") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long")
    known = stored(
        _numbered(sources).select("source", "source_size", weight.alias("weight")), "weights"
    )
    limit = F.col("source_size") * most
    total = known.agg(F.sum("source_size")).first()[0] or 0
    unit = 0.0
    while total:
        over = F.col("weight") * F.lit(unit) > limit
        held, free = known.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        new = (total - held) / free if free else unit
        if new <= unit:
            break
        unit = new
    target = F.when(F.col("weight") * F.lit(unit) > limit, limit.cast("double")).otherwise(
        F.col("weight") * F.lit(unit)
    )
    return known.select("source", "source_size", target.alias("target"))


def _with_copies(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """Adds source_size, target and copies to rows that have doc_id and source."""
    if targets.count() <= BROADCAST_SOURCES:
        targets, salt, salts = F.broadcast(targets), F.lit(0), F.array(F.lit(0))
    else:
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    targets = targets.select(
        F.col("source").alias("_source"), "source_size", "target", F.explode(salts).alias("_mix_salt")
    )
    name = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_salt") == F.col("_mix_salt"))
    copies = F.floor("_rate") + F.when(F.col("_draw") < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)
    return (
        rows.withColumn("_salt", salt)
        .join(targets, same)
        .withColumns({"_rate": rate, "_draw": draw})
        .withColumn("copies", copies.cast("long"))
        .drop("_source", "_salt", "_mix_salt", "_rate", "_draw")
    )


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = "mix"
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row.

    A document of a source with rate r = target / source_size is emitted floor(r) times, and
    once more if the number its id and the seed hash to, in [0, 1), is below r's fraction. A
    source without words has rate 0. Null texts have size 0, a null source is a source of
    its own, rows that repeat an id draw alike, a null id draws as the empty string, and an
    empty table gives an empty plan.
    """
    sized = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    targets = stored(source_targets(sized.select("source", "size"), weights, most), "targets")
    return _with_copies(sized, targets, seed).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = "mix"
) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, as often as they are taken.

    The texts stay where they are: only the sizes are shuffled, and only per source.
    """
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    columns = [F.col("_row." + c) for c in docs.columns]
    rows = docs.select("doc_id", "source", F.struct(*docs.columns).alias("_row"))
    return (
        _with_copies(rows, targets, seed)
        .where(F.col("copies") > 0)
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(*columns)
    )
