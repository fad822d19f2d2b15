"""Language identification by error-correcting output codes.

Every language gets a codeword, and one naive Bayes classifier per bit tells the languages
with a 1 there from those with a 0 by the text's byte pairs and triples. A text's outputs
are compared with all codewords by a logistic loss, bits weighted by how far apart their
two sides are; the codeword with the least loss wins, and a close second marks the text as
ambiguous. Counts come from all training texts, summed within tasks first.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from tickloom.llm import grams

UNKNOWN = "und"
EXHAUSTIVE = 7  # up to so many languages every split into two sides is a bit
SHARPNESS = 12.0
AMBIGUOUS = 0.6
BLOCK_BYTES = 1 << 18
_LETTER = regex.compile(r"\p{L}")


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 per language; all rows and all columns differ."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= EXHAUSTIVE:
        bits = [[1, *rest] for rest in itertools.product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(bits, float).T
    length, draw = 10 * int(np.ceil(np.log2(languages))), np.random.RandomState(5)
    best, apart = None, -1
    for _ in range(20):
        code = draw.choice((-1.0, 1.0), (languages, length))
        product = code @ code.T
        np.fill_diagonal(product, -length)
        split = abs(code.sum(0)).max() < languages
        least = (length - product.max()) / 2 if split else -1
        if least > apart:
            best, apart = code, least
    return best


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, (pairs, triples) in zip(batch.column(0).to_pylist(), grams.per_text(batch.column(1), lower=True), strict=True):
            count = totals.setdefault(lang, np.zeros(grams.CODES, np.int64))
            np.add.at(count, pairs, 1)
            np.add.at(count, triples, 1)
    for lang, count in totals.items():
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(used), "code": used, "n": count[used]})


def bit_weights(counts: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bits) weights, scaled so that a side's mean output is near +1 or -1, and how
    much each bit counts."""
    tables, gaps = [], []
    for bit in code.T:
        sides = [counts[bit == s].sum(0) + 0.5 for s in (1, -1)]
        one, two = (s / s.sum() for s in sides)
        ratio = np.log(one) - np.log(two)
        high, low = one @ ratio, two @ ratio
        gap = max((high - low) / 2, 1e-9)
        tables.append((ratio - (high + low) / 2) / gap)
        gaps.append(gap)
    return np.stack(tables, 1), np.array(gaps) / sum(gaps)


def decoded(outputs: np.ndarray, code: np.ndarray, weight: np.ndarray):
    """Per text: the place of the nearest codeword, its share of belief and the runner-up's."""
    loss = np.stack([(weight * np.log1p(np.exp(-np.clip(2 * outputs * row, -50, 50)))).sum(1) for row in code], 1)
    belief = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
    belief /= belief.sum(1, keepdims=True)
    best = belief.argmax(1)
    belief.sort(1)
    return best, belief[:, -1], belief[:, -2] if belief.shape[1] > 1 else np.zeros(len(belief))


def _identify(languages, table, code, weight):
    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            outputs = np.zeros((batch.num_rows, table.shape[1]))
            for pairs, triples, offsets, row in grams.text_codes(column, True, BLOCK_BYTES):
                sums = [np.zeros((len(x) + 1, table.shape[1])) for x in (pairs, triples)]
                for total, codes in zip(sums, (pairs, triples), strict=True):
                    np.cumsum(table[codes], axis=0, out=total[1:])
                a, b = offsets[:-1], offsets[1:]
                n = np.maximum(b - a - 1, 0) + np.maximum(b - a - 2, 0)
                ends = (np.maximum(b - 1, a), np.maximum(b - 2, a))
                found = sum(t[np.minimum(e, len(t) - 1)] - t[np.minimum(a, len(t) - 1)] for t, e in zip(sums, ends, strict=True))
                outputs[row : row + len(a)] = found / np.maximum(n, 1)[:, None]
            best, score, second = decoded(outputs, code, weight)
            letters = np.array([t is not None and _LETTER.search(t) is not None for t in column.to_pylist()], bool)
            name = np.where(letters, np.array(languages, object)[best], UNKNOWN)
            batch = batch.append_column("lang_pred", pa.array(name.tolist(), pa.string()))
            batch = batch.append_column("score", pa.array(np.where(letters, score, 0.0)))
            yield batch.append_column("ambiguous", pa.array(letters & (second >= AMBIGUOUS * score), pa.bool_()))

    return run


def identified(docs: DataFrame, train: Column) -> DataFrame:
    """``docs`` (which has text and lang) with lang_pred, score and ambiguous.

    Learns from text and lang of the rows where ``train`` holds and lang is not null. Null
    texts and texts without a letter are ``und`` with score 0, and so is everything when there
    is nothing to learn from. Repeated rows count and are judged one by one; other columns are
    carried along, those named like a result are replaced.
    """
    rows = docs.where(train & F.col("lang").isNotNull()).select("lang", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = found.toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    docs = docs.drop("lang_pred", "score", "ambiguous")
    if not languages:
        none = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "ambiguous": F.lit(False)}
        return docs.withColumns(none)
    counts, place = np.zeros((len(languages), grams.CODES)), {x: i for i, x in enumerate(languages)}
    at = np.array([place[x] for x in found.column("lang").to_pylist()])
    counts[at, found.column("code").to_numpy()] = found.column("n").to_numpy()
    code = codewords(len(languages))
    table, weight = bit_weights(counts, code)
    more = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())]
    return docs.mapInArrow(_identify(languages, table, code, weight), StructType([*docs.schema.fields, *more]))
