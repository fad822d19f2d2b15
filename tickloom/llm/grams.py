"""Byte n-grams of whole texts as small codes: all pairs, and triples folded to 16 bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tickloom.llm import words

CODES = 1 << 17


def text_codes(column: pa.Array, lower: bool, size: int = words.BLOCK_BYTES):
    """For blocks of texts: the codes of each block, the bounds of its texts, the block's rows.
    Grams do not cross texts; a text of one byte or none has no code."""
    data, offsets = words.raw_bytes(column)
    for row, stop in words.row_blocks(offsets, size):
        part = data[offsets[row] : offsets[stop]]
        if lower:
            part = words._LOWER[part]
        wide = part.astype(np.int32)
        pairs = (wide[:-1] << 8) | wide[1:] if len(wide) else wide
        triples = (((pairs[:-1] << 8) | wide[2:]).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16) if len(wide) > 1 else wide
        yield pairs, triples.astype(np.int32) + (1 << 16), offsets[row : stop + 1] - offsets[row], row


def per_text(column: pa.Array, lower: bool = False):
    """The codes of each text, repeats included, row by row."""
    for pairs, triples, offsets, _ in text_codes(column, lower):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            yield pairs[a : max(a, b - 1)], triples[a : max(a, b - 2)]
