"""Ranked lexical search: summed accumulators for short lists, document-at-a-time over long ones.

Queries are taken in blocks of bounded size. A first pass over the documents counts terms; it fixes
each term's weight. In the second pass every task forms segments of a few thousand documents with
the posting lists of the block's terms. Per query, the lists of its rare terms are summed into
one accumulator list (term at a time). That list then takes part as a single iterator with a bound of
its own beside the long lists of frequent terms: blocks of documents are visited in order, those whose
bounds stay below the task's current k-th score are skipped, and a document is dropped as soon as what is still to come cannot
lift it to that score. A task reports k documents per query, a window over those picks the k overall.
All scores are integers, so bounds are exact and no tie is lost.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import LOWER, UPPER
from tickloom.llm.words import mix64, raw_bytes, row_blocks, span_hashes
from tickloom.session import scratch_path
from tickloom.sinks.tables import exists

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM_BYTES = 4 << 20  # text of the queries of one block
TEXT_BYTES = 1 << 20  # text taken apart at once; a longer one goes in pieces
SEGMENT_DOCS = 4096
SEGMENT_POSTINGS = 1 << 20
BLOCK = 64  # documents with one bound
STRIDE = 8  # blocks scored before the k-th score is looked at again
LONG_SHARE = 16  # a list is long if it holds one document of so many

_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x165667B19E3779F9))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in ``data``; no term goes over an offset."""
    inside = _IN_TERM[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | cut[1:-1]
    closes[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def _pieces(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``size`` bytes, cut between terms."""
    at = 0
    while at < len(data):
        stop = at + size
        while stop < len(data):
            gap = np.flatnonzero(~_IN_TERM[data[stop : stop + size]])
            if len(gap):
                stop += int(gap[0])
                break
            stop += size
        yield data[at:stop]
        at = stop


class Vocabulary:
    """The terms of a block of queries, found in texts by hash and confirmed by their bytes."""

    def __init__(self, terms: list[str]):
        parts = [t.encode() for t in terms]
        ends = np.cumsum([len(p) for p in parts]).astype(np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        hashes = span_hashes(_BYTES[data], starts, ends, _BASE)
        self.order = np.argsort(hashes)
        self.hashes, self.data, self.starts, self.ends = hashes[self.order], data, starts, ends
        self.size = len(terms)

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms of the vocabulary, and which terms they are."""
        hashes = span_hashes(_BYTES[data], start, end, _BASE)
        slot = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        hit = np.flatnonzero(self.hashes[slot] == hashes)
        term = self.order[slot[hit]]
        length = end[hit] - start[hit]
        right = length == self.ends[term] - self.starts[term]
        hit, term, length = hit[right], term[right], length[right]
        place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        differs = data[np.repeat(start[hit], length) + place] != self.data[np.repeat(self.starts[term], length) + place]
        if differs.any():
            wrong = np.unique(np.repeat(np.arange(len(hit)), length)[differs])
            hit, term = np.delete(hit, wrong), np.delete(term, wrong)
        return hit, term


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    found, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, counts)
    return found, total


def _counted(column: pa.Array, vocabulary: Vocabulary):
    """Runs of rows: the first row, terms per row, and (row, term, frequency) for the vocabulary's terms."""
    data, offsets = raw_bytes(column)
    for row, stop in row_blocks(offsets, TEXT_BYTES):
        part, ends = data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        whole = len(part) <= TEXT_BYTES
        lengths, keys, counts = np.zeros(stop - row, np.int64), [], []
        for piece in [part] if whole else _pieces(part, TEXT_BYTES):
            piece = _FOLD[piece]
            start, end = _spans(piece, ends if whole else np.array([0, len(piece)]))
            at = np.searchsorted(ends, start, side="right") - 1 if whole else np.zeros(len(start), np.int64)
            lengths += np.bincount(at, minlength=stop - row)
            hit, term = vocabulary.find(piece, start, end)
            key, count = _summed(at[hit] * vocabulary.size + term)
            keys.append(key)
            counts.append(count)
        key, count = (keys[0], counts[0]) if len(keys) == 1 else _summed(np.concatenate(keys), np.concatenate(counts))
        yield row, lengths, key // vocabulary.size, key % vocabulary.size, count


def _count_terms(vocabulary: Vocabulary):
    def run(batches):
        held, docs, total = np.zeros(vocabulary.size, np.int64), 0, 0
        for batch in batches:
            for _, lengths, _, term, _ in _counted(batch.column(0), vocabulary):
                held += np.bincount(term, minlength=vocabulary.size)
                docs += int((lengths > 0).sum())
                total += int(lengths.sum())
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([-2, -1, *range(vocabulary.size)], pa.int64()), "n": pa.array([docs, total, *held.tolist()], pa.int64())}
        )

    return run


class Best:
    """The k best documents so far: score descending, then id ascending, null last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.lost, self.id = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
        self.least = 1  # a lower score can no longer get in

    def add(self, score: np.ndarray, lost: np.ndarray, ids: np.ndarray) -> None:
        score, lost, ids = (np.concatenate(x) for x in ((self.score, score), (self.lost, lost), (self.id, ids)))
        order = np.lexsort((ids, lost, -score))[: self.k]
        self.score, self.lost, self.id = score[order], lost[order], ids[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))


class Segment:
    """Documents of one task with their ids and what each of their terms adds to a score."""

    def __init__(self, ids, lost, lengths, doc, term, frequency, weights, long, norm):
        self.ids, self.lost = ids, lost
        m = norm(lengths)
        worth = weights[term] * ((1_000_000_000 * frequency) // (1000 * frequency + 12 * m[doc]))
        order = np.lexsort((doc, term))
        doc, term, worth = doc[order], term[order], worth[order]
        present, first = np.unique(term, return_index=True)
        ends = np.append(first, len(term))[1:]
        self.lists = {int(t): (doc[a:b], worth[a:b]) for t, a, b in zip(present, first, ends, strict=True)}
        self.blocks = -(-len(ids) // BLOCK)
        frequent = [t for t in self.lists if long[t]]
        self.row = {t: i for i, t in enumerate(frequent)}
        self.worth = np.zeros((len(frequent), self.blocks * BLOCK), np.int64)
        for t, i in self.row.items():
            docs, added = self.lists[t]
            self.worth[i, docs] = added
        self.bounds = self.worth.reshape(len(frequent), self.blocks, BLOCK).max(axis=2)

    def search(self, item: Counter, best: Best) -> None:
        """Let the segment's documents compete for an item's places."""
        accumulated, any_short = np.zeros(self.blocks * BLOCK, np.int64), False
        rows, repeats = [], []
        for t, n in item.items():
            if t in self.row:
                rows.append(self.row[t])
                repeats.append(n)
            elif t in self.lists:
                docs, added = self.lists[t]
                accumulated[docs] += n * added
                any_short = True
        if not rows and not any_short:
            return
        repeats = np.array(repeats, np.int64)
        bounds = self.bounds[rows] * repeats[:, None]
        largest = bounds.max(axis=1, initial=0)
        order = np.argsort(-largest, kind="stable")
        rows, repeats, largest = np.array(rows, np.int64)[order], repeats[order], largest[order]
        to_come = np.append(np.cumsum(largest[::-1])[::-1], 0)
        reach = accumulated.reshape(self.blocks, BLOCK).max(axis=1) + bounds.sum(axis=0)
        ahead = np.flatnonzero(reach >= best.least)
        for a in range(0, len(ahead), STRIDE):
            blocks = ahead[a : a + STRIDE]
            blocks = blocks[reach[blocks] >= best.least]
            if len(blocks):
                docs = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                self._score(docs, accumulated, rows, repeats, to_come, best)

    def _score(self, docs, accumulated, rows, repeats, to_come, best: Best) -> None:
        score = accumulated[docs]
        for i, (row, n) in enumerate(zip(rows, repeats, strict=True)):
            able = score + to_come[i] >= best.least
            if not able.all():
                docs, score = docs[able], score[able]
            score = score + n * self.worth[row, docs]
        in_reach = score >= best.least
        docs, score = docs[in_reach], score[in_reach]
        if len(docs):
            best.add(score, self.lost[docs], self.ids[docs])


def _norm(docs: int, total: int):
    def lengths_to_m(lengths: np.ndarray) -> np.ndarray:
        if 25 * docs * int(lengths.max(initial=0)) < 1 << 63:
            return 75 + (25 * docs * lengths) // total
        return np.array([75 + 25 * docs * int(n) // total for n in lengths], np.int64)

    return lengths_to_m


def _segments(batches, vocabulary: Vocabulary, weights: np.ndarray, long: np.ndarray, norm) -> Iterator[Segment]:
    parts, size, postings = [], 0, 0

    def segment() -> Segment:
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return Segment(*columns, weights, long, norm)

    for batch in batches:
        ids = batch.column(1)
        lost, ids = np.asarray(ids.is_null()), ids.fill_null(0).to_numpy()
        for row, lengths, doc, term, count in _counted(batch.column(0), vocabulary):
            if size and (size + len(lengths) > SEGMENT_DOCS or postings + len(doc) > SEGMENT_POSTINGS):
                yield segment()
                parts, size, postings = [], 0, 0
            span = slice(row, row + len(lengths))
            parts.append((ids[span], lost[span], lengths, doc + size, term, count))
            size, postings = size + len(lengths), postings + len(doc)
    if size:
        yield segment()


def _search(items: list[Counter], vocabulary: Vocabulary, weights, long, docs: int, total: int, k: int):
    def run(batches):
        best = [Best(k) for _ in items]
        for segment in _segments(batches, vocabulary, weights, long, _norm(docs, total)):
            for item, places in zip(items, best, strict=True):
                segment.search(item, places)
        number = np.repeat(np.arange(len(items)), [len(b.id) for b in best])
        score, lost, ids = (np.concatenate([getattr(b, x) for b in best]) for x in ("score", "lost", "id"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(ids, pa.int64(), mask=lost), pa.array(score, pa.int64())], ["item", "doc_id", "score"]
        )

    return run


def _answers(texts: DataFrame, items: list[Counter], k: int) -> DataFrame | None:
    """item, rank, doc_id and score of one block of items, given as counters of terms."""
    terms = sorted(set().union(*items))
    if not terms:
        return None
    vocabulary = Vocabulary(terms)
    place = {t: i for i, t in enumerate(terms)}
    numbered = [Counter({place[t]: n for t, n in item.items()}) for item in items]
    counts = texts.select("text").mapInArrow(_count_terms(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    known = {r["term"]: r["n"] for r in counts.collect()}
    docs, total = known.get(-2, 0), known.get(-1, 0)
    if not docs:
        return None
    held = [known[i] for i in range(len(terms))]
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for n in held], np.int64)
    long = np.array([n * LONG_SHARE >= docs for n in held])
    found = texts.mapInArrow(_search(numbered, vocabulary, weights, long, docs, total, k), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _item_blocks(items: DataFrame, size: int) -> Iterator[list]:
    block, held = [], 0
    for r in items.toLocalIterator(prefetchPartitions=True):
        if block and held + len(r["text"]) > size:
            yield block
            block, held = [], 0
        block.append(r)
        held += len(r["text"])
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the ``k`` best documents with a score above 0 of every item.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Equal scores
    go by ascending id, null last. Null texts and texts without a term match nothing and are not counted. Repeated documents are
    ranked one by one; an item that stands in several equal rows is one item, different texts with one id are
    items of their own. Texts longer than a megabyte are taken apart in pieces, so a task holds
    one text and the postings of a segment. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    texts = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    asked = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    path, shape = scratch_path(spark, "search"), f"item_id {kind}, rank int, doc_id long, score long"
    for block in _item_blocks(asked, block_bytes):
        found = _answers(texts, [Counter(terms_of(r["text"])) for r in block], k)
        if found is not None:
            names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(block)], f"item long, item_id {kind}")
            found.join(names, "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    return spark.read.schema(shape).parquet(path) if exists(spark, path) else spark.createDataFrame([], shape)
