"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of bounded size. For one block, every task scores its
candidates against all queries and reports, per query, a histogram of the scores: only its
highest bins down to the k-th score, since lower ones cannot hold the overall k-th. The
summed histogram shows the bin of the k-th highest score, and the next round looks into
that bin alone, until it is one value wide. The last pass filters by that value; where it
is tied, each task gives its k smallest ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import stored

BINS = 1024
BLOCK_BYTES = 1 << 21
CANDIDATE_ROWS = 4096


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id and vector as integers floor(scale * x); unusable rows are left out."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return rows.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("v"),
    ).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad)).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have ``width`` components, and their places in the column."""
    lengths = np.asarray(column.value_lengths())
    fits = np.flatnonzero(lengths == width)
    values = column.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(fits), width), fits


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; raises OverflowError where one would not fit."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    bound = int(np.abs(queries.astype(object)).sum(1).max()) * int(max(abs(int(rows.max())), abs(int(rows.min()))))
    if bound < 1 << 53:  # every partial sum is exact in a double
        return (queries.astype(float) @ rows.T.astype(float)).astype(np.int64)
    if bound < 1 << 63:
        return queries @ rows.T
    return (queries.astype(object) @ rows.T.astype(object)).astype(np.int64)


def _scored(batches, ids, queries):
    """Candidate ids and scores, with a query's own row marked, for slices of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, CANDIDATE_ROWS):
            part = batch.slice(at, CANDIDATE_ROWS)
            rows, fits = _matrix(part.column(1), queries.shape[1])
            if len(rows):
                own = part.column(0).to_numpy()[fits]
                yield own, scores(queries, rows), ids[:, None] == own[None, :]


def _histograms(ids, queries, low, width, k):
    def run(batches):
        counts = {}
        for _, found, own in _scored(batches, ids, queries):
            # low is below every score in the first round; later, bin BINS stands for all above
            place = np.clip((found.astype(object) - low[:, None]) // width[:, None], -1, BINS).astype(int) \
                if low.dtype == object else np.clip((found - low[:, None]) // width[:, None], -1, BINS)
            place[own] = -1
            for q in range(len(ids)):
                bins = np.bincount(place[q] + 1, minlength=BINS + 2)[1:]
                counts[q] = counts[q] + bins if q in counts else bins
        out = {"q": [], "bin": [], "n": []}
        for q, bins in counts.items():
            used = np.flatnonzero(bins)[::-1]
            enough = np.searchsorted(np.cumsum(bins[used]), k) + 1
            out["q"] += [q] * len(used[:enough])
            out["bin"] += used[:enough].tolist()
            out["n"] += bins[used[:enough]].tolist()
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("q", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))

    return run


def _winners(ids, queries, cut, k):
    def run(batches):
        best = [None] * len(ids)
        for rows, found, own in _scored(batches, ids, queries):
            for q in range(len(ids)):
                take = np.flatnonzero((found[q] >= cut[q]) & ~own[q])
                if len(take):
                    new = np.stack((-found[q][take], rows[take]))
                    new = new if best[q] is None else np.concatenate((best[q], new), 1)
                    best[q] = new[:, np.lexsort(new[::-1])[:k]]
        for q, rows in enumerate(best):
            if rows is not None:
                yield pa.RecordBatch.from_pydict(
                    {"query_id": np.full(rows.shape[1], ids[q]), "vec_id": rows[1], "score": -rows[0]}
                )

    return run


def _kth_values(vectors, ids, queries, k):
    """For each query the k-th highest score, or the lowest possible one where there are fewer."""
    largest = vectors.where(F.size("v") == queries.shape[1]).agg(
        F.max(F.array_max(F.transform("v", F.abs)))
    ).first()[0]
    reach = np.array([max(1, int(sum(abs(int(x)) for x in q)) * int(largest or 0)) for q in queries], object)
    low, width = -reach, np.array([2 * r // BINS + 1 for r in reach], object)
    if max(int(r) for r in reach) < 1 << 61:
        low, width = low.astype(np.int64), width.astype(np.int64)
    open_ = np.ones(len(ids), bool)
    while open_.any():
        seen = np.flatnonzero(open_)
        task = _histograms(ids[seen], queries[seen], low[seen], width[seen], k)
        bins = vectors.mapInArrow(task, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        above = Window.partitionBy("q").orderBy(F.desc("bin"))
        found = (
            bins.withColumn("upto", F.sum("n").over(above))
            .where(F.col("upto") >= k)
            .groupBy("q").agg(F.max("bin").alias("bin"))
            .collect()  # at most one row per query of the block
        )
        place = {int(seen[r["q"]]): r["bin"] for r in found}
        for q in seen:
            if q not in place:  # fewer than k candidates: all of them
                open_[q] = False
            else:
                low[q] += place[q] * width[q]
                open_[q] = width[q] > 1
                width[q] = (width[q] + BINS - 1) // BINS
    return low


def top_k(
    rows: DataFrame, is_query, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest inner products, ties to smaller ids.

    ``is_query`` is a condition on the column vec_id. A query is compared with every row of
    another id whose vector is as long as its own. Null vectors, vectors holding null or
    non-finite components and rows without id take no part; a query id on several rows is
    asked once, with the vector that sorts first; other repeated rows rank one by one, and an
    empty table gives no rows. A score beyond 64 bits raises OverflowError.
    """
    vectors = stored(integer_vectors(rows, vec_id, vector, scale), "vectors")
    queries = stored(
        vectors.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")).where("width > 0"),
        "queries",
    )
    result = None
    for width in sorted(r[0] for r in queries.select("width").distinct().collect()):
        own = queries.where(F.col("width") == width)
        step = max(1, BLOCK_BYTES // (8 * width))
        last = None
        while True:  # one block of at most BLOCK_BYTES on the driver at a time
            rest = own if last is None else own.where(F.col("vec_id") > last)
            block: pd.DataFrame = rest.orderBy("vec_id").limit(step).select("vec_id", "v").toPandas()
            if block.empty:
                break
            ids, matrix = block.vec_id.to_numpy(), np.array(block.v.tolist(), np.int64)
            cut = _kth_values(vectors, ids, matrix, k)
            part = vectors.mapInArrow(_winners(ids, matrix, cut, k), "query_id long, vec_id long, score long")
            part = stored(part, "winners") if len(block) == step else part
            result = part if result is None else result.unionAll(part)
            last = int(ids[-1])
            if len(block) < step:
                break
    if result is None:
        return vectors.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        ).where(F.lit(False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        result.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
