"""Repeated passages by fixed-block anchors.

With windows of W words, blocks of B = (W + 1) // 2 words that do not overlap are the
index, and the window of B words at every word is a probe. Whatever two places share W
words, one of them covers a block there and the other's probe meets it. Probes and blocks
travel as packed arrays of 32-bit fingerprints, one row per batch of texts and shard, about
seven bytes a word. The windows of W words around the hits are then counted by their whole
64-bit hashes (and the shard, another few bits), again packed; those found twice are the
exact repeats, and their union extends each hit to the maximal repeat.

Equal texts are one text from the start, dropped within each task before anything moves, so
a text with a billion copies costs no more than one. Distinct texts are written once, as a
table bucketed by ``home``, so bringing hits back to them moves the hits, not the texts.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.text import even_keys, shuffles
from tickloom.session import scratch_path

WINDOW = 35
HOMES = 4  # per shuffle partition

_PACKED = "shard long, runs array<long>, hash binary, row binary, low binary, high binary"
_FOUND = "home long, place binary, word binary"


def _unseen(batches):
    """Drops texts that this task has passed on already."""
    seen = set()
    for batch in batches:
        keep = []
        for digest in batch.column(0).to_pylist():
            keep.append(digest not in seen)
            seen.add(digest)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _distinct_texts(docs: DataFrame, parts: int) -> DataFrame:
    """digest, text, home, place: each text once, bucketed by home, numbered within it."""
    texts = docs.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), "text")
    home = F.pmod(F.xxhash64("digest"), F.lit(HOMES * parts))
    once = (
        texts.mapInArrow(_unseen, "digest binary, text string")
        .withColumn("home", home)
        .repartition(parts, "home")
        .dropDuplicates(["home", "digest"])
    )
    place = F.row_number().over(_by_home()) - 1
    name = f"llm_texts_{uuid.uuid4().hex}"
    (
        once.withColumn("place", place)
        .write.bucketBy(parts, "home")
        .option("path", scratch_path(docs.sparkSession, "texts"))
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return docs.sparkSession.table(name)


def _by_home():
    from pyspark.sql import Window

    return Window.partitionBy("home").orderBy("digest")


def _runs(home: np.ndarray, place: np.ndarray) -> np.ndarray:
    """home, first place and length of each run of consecutive places."""
    if not len(home):
        return np.empty((0, 3), np.int64)
    cut = np.flatnonzero((np.diff(home) != 0) | (np.diff(place) != 1)) + 1
    first = np.concatenate(([0], cut))
    return np.stack((home[first], place[first], np.diff(np.append(first, len(home)))), 1)


def _packed(runs, hashes, row, word, shards, kind):
    """Rows of _PACKED: what goes to each shard (their keys), in the order of the texts. The shard
    comes from the hash's high bits, the fingerprint from its low ones."""
    shard = ((hashes >> np.uint64(40)) % np.uint64(len(shards))).astype(np.uint32)
    order = np.argsort(shard.astype(np.uint16) if len(shards) <= 65536 else shard, kind="stable")
    shard, hashes, row, word = shard[order], hashes[order].astype(kind), row[order].astype(np.uint16), word[order]
    low, high = word.astype(np.uint16), (word >> 16).astype(np.uint16)
    bounds = np.append(np.flatnonzero(np.diff(shard, prepend=len(shards) + 1)), len(shard))
    runs = runs.ravel().tolist()
    for a, b in itertools.pairwise(bounds):
        parts = [[x[a:b].tobytes()] for x in (hashes, row, low, high)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([shards[shard[a]]], pa.int64()), pa.array([runs], pa.list_(pa.int64())), *(pa.array(x, pa.binary()) for x in parts)],
            ["shard", "runs", "hash", "row", "low", "high"],
        )


def _slices(batch: pa.RecordBatch, rows: int = 60_000, size: int = 1 << 24):
    """At most 65,536 rows at a time, and about 16 MB of text."""
    column = batch.column(batch.schema.get_field_index("text"))
    _, offsets = words.raw_bytes(column)
    for a, b in words.row_blocks(offsets, size):
        for at in range(a, b, rows):
            yield batch.slice(at, min(rows, b - at))


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _probes(window, shards):
    size = (window + 1) // 2

    def run(batches):
        for whole in batches:
            for batch in _slices(whole):
                runs = _runs(_column(batch, "home").to_numpy(), _column(batch, "place").to_numpy())
                hashes, rows, at = [], [], []
                for block in words.blocks(_column(batch, "text"), lower=False):
                    found, text, word = block.windows(size)
                    use = block.counts[text] >= window
                    hashes.append(found[use])
                    rows.append(text[use] + block.first_row)
                    at.append((word - block.first[:-1][text])[use])
                if hashes:
                    yield from _packed(runs, *map(np.concatenate, (hashes, rows, at)), shards, np.uint32)

    return run


def _shard(table: pa.Table, kind):
    """The entries of one shard: hash, home, place and word."""
    hashes, home, place, word = [], [], [], []
    for row in table.to_batches():
        for i in range(row.num_rows):
            runs = np.array(row.column(1)[i].as_py(), np.int64).reshape(-1, 3)
            load = lambda k, t: np.frombuffer(row.column(k)[i].as_buffer(), t)  # noqa: B023, E731
            index = load(3, np.uint16).astype(np.int64)
            ends = np.cumsum(runs[:, 2])
            at = np.searchsorted(ends, index, side="right")
            hashes.append(load(2, kind))
            home.append(runs[at, 0])
            place.append((runs[at, 1] + index - (ends - runs[:, 2])[at]).astype(np.uint32))
            word.append(load(4, np.uint16).astype(np.uint32) | load(5, np.uint16).astype(np.uint32) << np.uint32(16))
    return tuple(map(np.concatenate, (hashes, home, place, word)))


def _by_homes(home, place, word) -> pa.Table:
    order = np.argsort(home, kind="stable")
    home, place, word = home[order], place[order], word[order]
    cuts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home))
    pairs = list(itertools.pairwise(cuts))
    return pa.table(
        {
            "home": pa.array([int(home[a]) for a, _ in pairs], pa.int64()),
            "place": pa.array([place[a:b].tobytes() for a, b in pairs], pa.binary()),
            "word": pa.array([word[a:b].tobytes() for a, b in pairs], pa.binary()),
        }
    )


def _meets(window):
    """Probes that meet a block other than the one they are."""
    size = (window + 1) // 2

    def run(table: pa.Table) -> pa.Table:
        hashes, home, place, word = _shard(table, np.uint32)
        block = word % size == 0
        index, count = np.unique(hashes[block], return_counts=True)
        if not len(index):
            return _by_homes(home[:0], place[:0], word[:0])
        at = np.minimum(np.searchsorted(index, hashes), len(index) - 1)
        hit = np.where(index[at] == hashes, count[at], 0) > block
        return _by_homes(home[hit], place[hit], word[hit])

    return run


def _twice(table: pa.Table) -> pa.Table:
    """Windows whose hash another window has too."""
    hashes, home, place, word = _shard(table, np.uint64)
    _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    hit = count[back] > 1
    return _by_homes(home[hit], place[hit], word[hit])


def _hits(found: pa.Table) -> dict[int, np.ndarray]:
    """Words that were found, by the text's place in its home."""
    if not found.num_rows:
        return {}
    place, word = (
        np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in found.column(c)]) for c in ("place", "word")
    )
    order = np.lexsort((word, place))
    place, word = place[order].astype(np.int64), word[order].astype(np.int64)
    cuts = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
    return {int(place[a]): word[a:b] for a, b in itertools.pairwise(cuts)}


def _covered(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in [start, start + length) of any start."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, np.clip(starts, 0, total), 1)
    np.add.at(steps, np.clip(starts + length, 0, total), -1)
    return np.cumsum(steps[:-1]) > 0


def _candidates(window, shards):
    """All windows that contain a probe that was met."""
    size = (window + 1) // 2

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        hits, out = _hits(found), []
        texts = texts.sort_by("place").combine_chunks()
        for whole in texts.to_batches() if hits else []:
            for batch in _slices(whole):
                places = _column(batch, "place").to_numpy()
                runs = _runs(_column(batch, "home").to_numpy(), places)
                hashes, rows, at = [], [], []
                for block in words.blocks(_column(batch, "text"), lower=False):
                    every, text, word = block.windows(window)
                    bounds = np.searchsorted(text, np.arange(block.texts + 1))
                    for d in range(block.texts):
                        own = hits.get(int(places[block.first_row + d]))
                        total = int(bounds[d + 1] - bounds[d])
                        if own is not None and total:
                            use = np.flatnonzero(_covered(own - (window - size), window - size + 1, total))
                            hashes.append(every[bounds[d] + use])
                            rows.append(np.full(len(use), block.first_row + d))
                            at.append(use)
                if hashes:
                    out += _packed(runs, *map(np.concatenate, (hashes, rows, at)), shards, np.uint64)
        schema = pa.schema([("shard", pa.int64()), ("runs", pa.list_(pa.int64())), *((x, pa.binary()) for x in ("hash", "row", "low", "high"))])
        return pa.Table.from_batches(out, schema)

    return run


def _cut(window):
    """Per text: the words it has, those in repeats, and the rest joined by one space."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        hits = _hits(found)
        out = {"digest": [], "n_words": [], "n_removed": [], "rest": []}
        for digest, place, text in zip(*(texts.column(c).to_pylist() for c in ("digest", "place", "text")), strict=True):
            parts = text.encode().split()
            out["digest"].append(digest)
            out["n_words"].append(len(parts))
            own = hits.get(place)
            if own is not None:
                gone = _covered(own, window, len(parts))
                parts = list(itertools.compress(parts, ~gone))
            out["n_removed"].append(out["n_words"][-1] - len(parts))
            out["rest"].append(b" ".join(parts).decode())
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return run


def _hashed(cut):
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        out = cut(texts, found)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in out.column("rest").to_pylist()]
        return out.drop(["rest"]).append_column("kept_sha256", pa.array(sha, pa.string()))

    return run


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def repeated_passages(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, kept_text for every row.

    Words are runs of bytes other than space and 0x09-0x0D, compared as they are. A word goes
    if it lies in a window of ``window`` words that also starts anywhere else, in the same
    text or another; windows are judged on the input. So of a text that stands on two rows,
    even under one id, every word goes if it has ``window`` words. Null counts as empty;
    texts shorter than a window keep all words; an empty table gives an empty result; a null
    id is carried along. Other columns are not read.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    parts = shuffles(docs.sparkSession)
    shards = even_keys(docs.sparkSession, parts)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    once = _distinct_texts(docs, parts)
    packed = once.mapInArrow(_probes(window, shards), _PACKED)
    met = packed.groupBy("shard").applyInArrow(_meets(window), _FOUND)
    homes = once.groupBy("home")
    near = homes.cogroup(met.groupBy("home")).applyInArrow(_candidates(window, shards), _PACKED)
    twice = near.groupBy("shard").applyInArrow(_twice, _FOUND)
    cut, columns = _cut(window), "digest binary, n_words long, n_removed long, "
    if texts:
        rest = homes.cogroup(twice.groupBy("home")).applyInArrow(cut, columns + "rest string")
        rest = rest.withColumn("kept_sha256", F.sha2(F.col("rest").cast("binary"), 256))
    else:
        rest = homes.cogroup(twice.groupBy("home")).applyInArrow(_hashed(cut), columns + "kept_sha256 string")
    digest = F.unhex(F.md5(F.col("text").cast("binary")))
    ids = docs.select("doc_id", digest.alias("digest"))
    copies = ids.groupBy("digest").agg(F.count("*").alias("copies"))
    gone = (F.col("copies") > 1) & (F.col("n_words") >= window)
    result = rest.join(copies, "digest")
    pick = lambda name, value: F.when(gone, value).otherwise(F.col(name)).alias(name)
    shown = [pick("kept_sha256", F.lit(EMPTY_SHA256))]
    if texts:
        shown.append(F.when(gone, F.lit("")).otherwise(F.col("rest")).alias("kept_text"))
    result = result.select("digest", "n_words", pick("n_removed", F.col("n_words")), *shown)
    return ids.join(result, "digest").drop("digest")
