"""Byte-level BPE: whole texts to token ids and back, by DuckDB recursive queries per task.

A task finds the pieces of its texts (the matches of the vocabulary's pattern) with array
passes and encodes each distinct piece that it does not remember and that is not a token itself. For
that, one row per token and position joins the merge table, and the recursion contracts each piece's
leftmost pair of minimum rank until none is left. Decoding joins ids with the vocabulary and
concatenates in order.

The recursion keeps every step, so its cost is the square of a piece's length. Pieces of more than
``LONG_PIECE`` bytes, such as encoded binary data, are contracted in the same order by a
heap of pairs instead. A worker remembers ``REMEMBERED`` pieces by a 64-bit hash of their code points;
when there are more, it forgets those not met since the last time.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from array import array
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words

# Fixed value: the pattern whose matches are encoded separately; pieces() follows it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")

BLOCK_BYTES = 1 << 18
REMEMBERED = 1_000_000
AT_ONCE = 5_000
SQUARES_AT_ONCE = 2_000_000  # sum of squared lengths of the pieces in one recursion
LONG_PIECE = 256
ROWS = 1_000
DECODED_AT_ONCE = 100_000
SPANS_AT_ONCE = 1 << 16
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)

# A pair's place among the pieces' pairs is in the low 8 bits of what the minimum is taken of.
MERGE = """
WITH RECURSIVE state(step, piece, tokens) AS (
    SELECT 0, piece, tokens FROM pieces
    UNION ALL
    (WITH pairs AS (
        SELECT piece, unnest(tokens[:-2]) * 1048576 + unnest(tokens[2:]) AS pair, unnest(range(len(tokens) - 1)) AS place FROM state
    ), lowest AS (
        SELECT piece, min(rank * 256 + place) AS best FROM pairs JOIN merges USING (pair) GROUP BY piece
    )
    SELECT step + 1, piece, tokens[:best & 255] || [best >> 8] || tokens[(best & 255) + 3:]
    FROM state JOIN lowest USING (piece))
)
SELECT piece, arg_max(tokens, step) AS ids FROM state GROUP BY piece
"""

JOIN = """
SELECT text, string_agg(bytes, '' ORDER BY place) AS bytes
FROM found JOIN vocabulary USING (token) GROUP BY text
"""


def read_ranks(path: str) -> bytes:
    """A rank file's contents, read on the driver and sent to the tasks."""
    with open(path, "rb") as file:
        return file.read()


def _kinds() -> np.ndarray:
    """The kind of every code point: white space, letter, number or other."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for low in range(0, 0x110000, 0x800):
        if 0xD800 <= low < 0xE000:
            continue
        text = np.arange(low, low + 0x800, dtype="<u4").tobytes().decode("utf-32-le")
        for kind, pattern in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
            for match in regex.finditer(pattern, text):
                kinds[low + match.start() : low + match.end()] = kind
    return kinds


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``flat[begin:begin + size]`` of all spans, one after the other; the places of a few spans at a time."""
    ends = np.cumsum(size, dtype=np.int64)
    out = np.empty(int(ends[-1]) if len(ends) else 0, flat.dtype)
    for at in range(0, len(size), SPANS_AT_ONCE):
        n = size[at : at + SPANS_AT_ONCE]
        stop = ends[at : at + SPANS_AT_ONCE]
        done = int(ends[at - 1]) if at else 0
        places = np.repeat(begin[at : at + SPANS_AT_ONCE] - (stop - n), n) + np.arange(done, int(stop[-1]))
        out[done : int(stop[-1])] = flat[places]
    return out


class Memory:
    """Ids of pieces by their hash, in sorted arrays: a large one and one for what came lately.

    An entry takes about 20 bytes: ids have the narrowest type that holds all of ``ids``, sizes one
    byte. A piece of more than 255 ids is not remembered.
    """

    def __init__(self, limit: int, ids: int = 1 << 32):
        self.limit, self.kind = limit, np.min_scalar_type(ids - 1)
        self.large, self.late = self._empty(), self._empty()
        self.used = np.zeros(0, bool)

    def _empty(self):
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint8), np.empty(0, self.kind)

    @staticmethod
    def _table(hashes, size, flat):
        """Hash, begin, size and ids, sorted by hash."""
        order = np.argsort(hashes)
        begin = np.cumsum(size, dtype=np.int64) - size
        flat = _gathered(flat, begin[order], size[order])
        size = size[order]
        return hashes[order], (np.cumsum(size, dtype=np.int64) - size).astype(np.uint32), size, flat

    def _joined(self, a, b):
        return self._table(np.concatenate((a[0], b[0])), np.concatenate((a[2], b[2])), np.concatenate((a[3], b[3])))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces are known, the ids of those in their order, and how many each has (0 if unknown)."""
        parts = []
        for table in (self.large, self.late):
            slot = np.searchsorted(table[0], hashes)
            inside = np.flatnonzero(slot < len(table[0]))
            hit = inside[table[0][slot[inside]] == hashes[inside]]
            parts.append((hit, slot[hit], table))
        self.used[parts[0][1]] = True
        known, size = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        for hit, slot, table in parts:
            known[hit], size[hit] = True, table[2][slot]
        upto = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.uint32)
        for hit, slot, table in parts:
            n = table[2][slot].astype(np.int64)
            spread = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            flat[np.repeat(upto[hit], n) + spread] = table[3][np.repeat(table[1][slot], n) + spread]
        return known, flat, size

    def add(self, hashes: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        short = size < 256
        if not short.all():
            hashes, flat, size = hashes[short], flat[np.repeat(short, size)], size[short]
        self.late = self._joined(self.late, (hashes, None, size.astype(np.uint8), flat.astype(self.kind)))
        if len(self.late[0]) * 8 < self.limit:
            return
        if len(self.large[0]) + len(self.late[0]) > self.limit:
            keep = np.flatnonzero(self.used)[: self.limit // 2]
            kept = self.large[2][keep]
            self.large = self._table(self.large[0][keep], kept, _gathered(self.large[3], self.large[1][keep], kept))
        self.large, self.late = self._joined(self.large, self.late), self._empty()
        self.used = np.zeros(len(self.large[0]), bool)


class Coder:
    """The merge table of one vocabulary in a DuckDB database of this process."""

    _here: dict[bytes, Coder] = {}

    @classmethod
    def of(cls, ranks: bytes) -> Coder:
        name = hashlib.sha256(ranks).digest()
        if name not in cls._here:
            cls._here[name] = cls(ranks)
        return cls._here[name]

    def __init__(self, ranks: bytes):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        self.kinds, self.memory = _kinds(), Memory(REMEMBERED, max(self.rank.values()) + 1)
        # without a folder to spill to, a query that needs more memory fails instead of filling a local disk
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        rows = array("q")
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    rows.extend((a, b, rank))
        a, b, rank = np.frombuffer(rows, np.int64).reshape(-1, 3).T
        self._create("merges", pa.table({"pair": a * 1048576 + b, "rank": rank}))
        self.can_decode = False

    def _create(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, little-endian and unsigned, four bytes each."""
        out = [np.uint32(self.rank[p]).tobytes() if p in self.rank else b"" for p in pieces]
        rest = [i for i, p in enumerate(pieces) if p and p not in self.rank]
        for i in rest:
            if len(pieces[i]) > LONG_PIECE:
                out[i] = np.array(self._contracted(pieces[i]), np.uint32).tobytes()
        rest = [i for i in rest if len(pieces[i]) <= LONG_PIECE]
        squares = np.cumsum([len(pieces[i]) ** 2 for i in rest])
        at = 0
        while at < len(rest):
            done = squares[at - 1] if at else 0
            stop = max(at + 1, min(at + AT_ONCE, int(np.searchsorted(squares, done + SQUARES_AT_ONCE, side="right"))))
            part = rest[at:stop]
            size = np.array([len(pieces[i]) for i in part])
            data = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
            offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
            tokens = pa.ListArray.from_arrays(offsets, pa.array(self.byte[data]))
            self.db.register("pieces", pa.table({"piece": np.arange(len(part)), "tokens": tokens}))
            found = self.db.sql(MERGE).to_arrow_table()
            self.db.unregister("pieces")
            ids = found.column("ids").combine_chunks()
            flat, ends = np.asarray(ids.flatten()).astype(np.uint32), np.cumsum(np.asarray(ids.value_lengths())).tolist()
            for n, a, b in zip(found.column("piece").to_pylist(), [0, *ends], ends, strict=False):
                out[part[n]] = flat[a:b].tobytes()
            at = stop
        return out

    def _contracted(self, piece: bytes) -> list[int]:
        """The ids of one long piece: pairs wait in a heap by rank and place, tokens are a linked list."""
        rank, bytes_of = self.rank.get, self.bytes_of

        def rank_of(a: int, b: int) -> int | None:
            return rank(bytes_of[a] + bytes_of[b])

        token = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(token)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(token[i], token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            lowest, i = heapq.heappop(heap)
            j = after[i]
            # a pair whose tokens have changed since it was put in is no longer one
            if token[i] < 0 or j >= n or rank_of(token[i], token[j]) != lowest:
                continue
            token[i], token[j], after[i] = lowest, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    r = rank_of(token[left], token[after[left]])
                    if r is not None:
                        heapq.heappush(heap, (r, left))
        return [t for t in token if t >= 0]

    def pieces(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of ``text`` and where its pieces start; ``ends`` are the ends of the texts in it."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        kind = self.kinds[points]
        fresh = np.zeros(n + 1, bool)
        fresh[0] = True
        fresh[ends] = True
        start = fresh[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last white space before something else stands alone, or goes with it if it is a blank
        after = np.flatnonzero(start[1:] & ~fresh[1:n] & (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        quote = np.flatnonzero(start & (points == 0x27))
        for suffix in SUFFIXES:
            at = quote[quote + len(suffix) < n]
            for k, letter in enumerate(suffix, 1):
                at = at[(points[at + k] == ord(letter)) & ~fresh[at + k]]
            start[at + 1] = False
            stop = at + 1 + len(suffix)
            start[stop[stop < n]] = True
        return points, np.flatnonzero(start)

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text, row by row."""
        data, offsets = words.raw_bytes(column)
        for row, stop in words.row_blocks(offsets, BLOCK_BYTES):
            raw = data[offsets[row] : offsets[stop]]
            lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            ends = lead[offsets[row : stop + 1] - offsets[row]]
            text = raw.tobytes().decode()
            points, start = self.pieces(text, ends)
            end = np.append(start[1:], len(points)) if len(start) else start
            hashes = words.span_hashes(words.mix64(points.astype(np.uint64) + np.uint64(1)), start, end, _BASE)
            hashes, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            flat, begin, size = self._ids(hashes, lambda rows, f=first, a=start, b=end, t=text: [t[a[i] : b[i]].encode() for i in f[rows]])
            begin, each = begin[back], size[back]
            upto = np.concatenate(([0], np.cumsum(each)))
            every = flat[np.repeat(begin - upto[:-1], each) + np.arange(upto[-1])]
            cuts = upto[np.searchsorted(start, ends)]
            for a, b in itertools.pairwise(cuts.tolist()):
                yield every[a:b].tobytes()

    def _ids(self, hashes: np.ndarray, pieces: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: one array, and where each piece's ids begin and how many they are."""
        known, flat, size = self.memory.find(hashes)
        new = np.flatnonzero(~known)
        fresh = self.encode_pieces(pieces(new))
        length = np.array([len(x) for x in fresh], np.int64) // 4
        added = np.frombuffer(b"".join(fresh), np.uint32)
        size[new] = length
        begin = np.empty(len(hashes), np.int64)
        begin[known] = np.cumsum(size[known]) - size[known]
        begin[new] = len(flat) + np.cumsum(length) - length
        self.memory.add(hashes[new], added, length)
        return np.concatenate((flat, added)), begin, size

    def decode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The bytes that each text's ids stand for."""
        if not self.can_decode:
            self._create("vocabulary", pa.table({"token": list(self.rank.values()), "bytes": [t.hex() for t in self.rank]}))
            self.can_decode = True
        size = np.array([len(x) // 4 for x in texts], np.int64)
        offsets = np.concatenate(([0], np.cumsum(size)))
        for row, stop in words.row_blocks(offsets, DECODED_AT_ONCE):
            ids = np.frombuffer(b"".join(texts[row:stop]), np.uint32)
            text = np.repeat(np.arange(stop - row), size[row:stop])
            self.db.register("found", pa.table({"text": text, "place": np.arange(len(ids)), "token": ids}))
            found = self.db.sql(JOIN).to_arrow_table()
            self.db.unregister("found")
            out = [b""] * (stop - row)
            for n, digits in zip(found.column("text").to_pylist(), found.column("bytes").to_pylist(), strict=True):
                out[n] = bytes.fromhex(digits)
            yield from out


def _encode(ranks, text):
    def run(batches):
        coder = Coder.of(ranks)
        for whole in words.released(batches):
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                at_text = batch.schema.get_field_index("text")
                ids = list(coder.encode(batch.column(at_text)))
                rest = batch if text else batch.remove_column(at_text)
                yield rest.append_column("token_ids", pa.array(ids, pa.binary()))
                del batch, rest, ids
                words.release()

    return run


def _decode(ranks, column):
    def run(batches):
        coder = Coder.of(ranks)
        for batch in words.released(batches):
            ids = [x or b"" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
            yield batch.append_column("decoded", pa.array(list(coder.decode(ids)), pa.binary()))

    return run


def _with(docs: DataFrame, name: str):
    from pyspark.sql.types import BinaryType, StructField, StructType

    return StructType([*docs.schema.fields, StructField(name, BinaryType())])


def encoded(docs: DataFrame, ranks: bytes, text: bool = True) -> DataFrame:
    """``docs`` with token_ids: the ids of column text, little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. No special tokens; their strings are ordinary text. All
    other columns and repeated rows are carried along, a column named token_ids is replaced.
    Without ``text`` the column text does not travel back from the workers.
    """
    docs = docs.drop("token_ids")
    return docs.mapInArrow(_encode(ranks, text), _with(docs if text else docs.drop("text"), "token_ids"))


def decoded(rows: DataFrame, ranks: bytes, column: str = "token_ids") -> DataFrame:
    """``rows`` with decoded: the bytes that the ids in ``column`` stand for; null counts as none."""
    rows = rows.drop("decoded")
    return rows.mapInArrow(_decode(ranks, column), _with(rows, "decoded"))


def _round_trip(ranks):
    def run(batches):
        coder = Coder.of(ranks)
        for batch in words.released(batches):
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = list(coder.encode(part.column(1)))
                sha = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in (ids, coder.decode(ids))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), *(pa.array(x, pa.string()) for x in sha)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def token_digests(docs: DataFrame, ranks: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, encoded and decoded in one pass
    so that neither ids nor bytes are written anywhere. Null counts as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_round_trip(ranks), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
