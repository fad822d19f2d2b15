"""License scans by conditional compression.

Around every cue word a text's words are taken as a block. A block is compressed alone and
with each template as a raw zstandard dictionary; all templates that shrink it are compared
with it word by word, and the one with the fewest words missing or changed is reported if
they are few. The wording differences are part of the result.
"""

from __future__ import annotations

import difflib
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Customary notices, by SPDX-like name.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MIT-short": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved.",
}
CUES = r"licen[sc]|copyright|permission|permitted|redistribut|reserved|spdx"
LEAST_REDUCTION = 0.1
MOST_CHANGED = 0.2

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOUND = "block long, license string, first_word long, last_word long, reduction double, missing array<string>, extra array<string>, exact boolean"
_EDGES = ".,;:!?()[]\"'*#"


def _plain(word: str) -> str:
    return word.strip(_EDGES).lower()


def differences(template: list[str], block: list[str]):
    """(first, last, missing, extra): the part of the block that the template's words span, the
    template's words it lacks and its own words the template lacks; None if nothing is common."""
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    same = [m for m in match.get_matching_blocks() if m.size]
    if not same:
        return None
    first, last = same[0].b, same[-1].b + same[-1].size - 1
    used = {i for m in same for i in range(m.a, m.a + m.size)}
    taken = {j for m in same for j in range(m.b, m.b + m.size)}
    missing = [w for i, w in enumerate(template) if i not in used]
    extra = [block[j] for j in range(first, last + 1) if j not in taken]
    return first, last, missing, extra


def _around(template: list[str], words: list[str], at: int):
    """The differences from the part of the text around word ``at``, as places in the text; a part
    beside it, such as an equal notice before, is left out and the rest compared again."""
    start, stop = max(0, at - len(template)), min(len(words), at + len(template))
    while span := differences(template, words[start:stop]):
        first, last = span[0] + start, span[1] + start
        if first <= at <= last:
            return first, last, *span[2:]
        start, stop = (last + 1, stop) if last < at else (start, first)
    return None


class Scanner:
    def __init__(self, templates: dict[str, str], cues: str):
        self.cue = re.compile(cues, re.IGNORECASE)
        self.words = {k: [_plain(w) for w in _WORD.findall(v)] for k, v in templates.items()}
        self.alone = zstandard.ZstdCompressor(level=19)
        self.given = {
            k: zstandard.ZstdCompressor(
                level=19,
                dict_data=zstandard.ZstdCompressionDict(
                    " ".join(v).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )
            for k, v in self.words.items()
        }

    def reductions(self, words: list[str], at: int) -> list[tuple[float, str]]:
        """How much smaller each template makes the block around word ``at``, largest first. The
        block reaches as far as the template is long, so that a short notice fills its part."""
        alone: dict[int, tuple[bytes, int]] = {}
        found = []
        for name, template in self.words.items():
            reach = len(template)
            if reach not in alone:
                data = " ".join(words[max(0, at - reach) : at + reach]).encode()
                alone[reach] = data, len(self.alone.compress(data))
            data, size = alone[reach]
            found.append((1 - len(self.given[name].compress(data)) / size, name))
        return sorted(found, key=lambda x: (-x[0], x[1]))

    def _best(self, words: list[str], at: int):
        found = []
        for gain, name in self.reductions(words, at):
            if gain < LEAST_REDUCTION:
                break
            template = self.words[name]
            span = _around(template, words, at)
            if span:
                first, last, missing, extra = span
                if len(missing) + len(extra) <= MOST_CHANGED * len(template):
                    found.append((len(missing) + len(extra), -gain, name, first, last, gain, missing, extra))
        return min(found, default=None, key=lambda x: x[:3])

    def scan(self, text: str) -> list[tuple]:
        words = _WORD.findall(text)
        plain = [_plain(w) for w in words]
        out, seen = [], set()
        for at, word in enumerate(words):
            best = self._best(plain, at) if self.cue.search(word) else None
            if best and best[2:5] not in seen:
                seen.add(best[2:5])
                changed, _, name, first, last, gain, missing, extra = best
                out.append((len(out), name, first, last, gain, missing, extra, changed == 0))
        return out


def _scan(templates, cues):
    def run(batches):
        scanner = Scanner(templates, cues)
        for batch in batches:
            ids, rows = [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                found = scanner.scan(text)
                ids += [n] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), *[pa.list_(pa.string())] * 2, pa.bool_())
            names = ["block", "license", "first_word", "last_word", "reduction", "missing", "extra", "exact"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), *(pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", *names],
            )

    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, cues: str = CUES) -> DataFrame:
    """doc_id, block, license, first_word, last_word, reduction, missing, extra, exact.

    One row per notice found, ``block`` counting a text's notices from 0. Words are compared in
    lower case without punctuation at their ends; missing and extra are the wording's
    differences from the template, ``exact`` says there are none. Null texts, empty texts and
    texts without a cue give no row, repeated rows are scanned one by one, a null id is carried
    along, an empty table gives no row, and other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    likely = docs.where(F.col("text").rlike(f"(?i){cues}")).select("doc_id", "text")
    return likely.mapInArrow(_scan(dict(templates), cues), f"doc_id {kind}, {_FOUND}")
