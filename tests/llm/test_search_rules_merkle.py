"""Ranked search, the Merkle manifest and the line rules against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from cases import LOWER, empty, folder, hard, hard_rows, words  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import search
from tickloom.llm.line_rules import cleaned, line_report
from tickloom.llm.merkle import FAN, fold, lower_case_tampering, manifest
from tickloom.llm.queries import QUERIES
from tickloom.llm.search import Best, Segment, ranked_search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(docs, items, k=20):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, r in asked.items()
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if lost else i, -s) for r, (s, lost, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def answers(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def documents_of(size, seed):
    draw = random.Random(seed)
    common = [f"c{i}" for i in range(12)]
    rare = [f"R{i}é" for i in range(400)]
    pick = lambda: " ".join(draw.choices(common, k=draw.randint(0, 30)) + draw.choices(rare, k=draw.randint(0, 4)))
    return [(i, pick()) for i in range(size)], [(i, pick() + " c1 c2 c1") for i in range(25)]


def test_search_equals_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(search, "SEGMENT_DOCS", 200)
    docs, items = documents_of(3000, 5)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    want = ranking(docs, items)
    assert answers(ranked_search(table, asked)) == want
    # several blocks of items are searched one after the other
    assert answers(ranked_search(table, asked, block_bytes=200)) == want
    assert answers(ranked_search(table, asked, k=3)) == ranking(docs, items, 3)


def test_search_skips_blocks_it_need_not_look_at():
    """Later segments score few documents once the k-th score is known."""
    import numpy as np

    looked = []

    class Watched(Segment):
        def _score(self, docs, *rest):
            looked.append(len(docs))
            super()._score(docs, *rest)

    weights, long = np.array([9000, 10]), np.array([False, True])
    norm = lambda n: np.full(len(n), 100)
    size, best = 6400, Best(5)
    for part in range(4):
        doc = np.arange(size)
        rare = doc[::640] if part == 0 else doc[:0]
        docs = np.concatenate((rare, doc))
        term = np.concatenate((np.zeros(len(rare), np.int64), np.ones(size, np.int64)))
        ids = doc + part * size
        segment = Watched(ids, np.zeros(size, bool), np.full(size, 9), docs, term, np.ones(len(docs), np.int64), weights, long, norm)
        segment.search(Counter({0: 1, 1: 1}), best)
    assert best.id.tolist() == [0, 640, 1280, 1920, 2560]
    assert sum(looked) <= 6400  # 25,600 documents hold the frequent term


def test_search_with_ties_nulls_and_repeated_rows(spark, hard, empty):
    rows = [(r[0], r[1]) for r in hard_rows()]
    items = [(1, "base1x1 BASE2x2 base2x2"), (2, None), (3, ""), (4, "été 你好 ÄÖ"), (5, "aaaa " + "a" * 50_000), (6, "word p1 p2"), (None, "short text")]
    asked = spark.createDataFrame([(*i, "x", 1) for i in [*items, items[0]]], "item_id long, text string, rank string, score int")
    assert answers(ranked_search(hard, asked)) == ranking(rows, items)
    assert ranked_search(empty, asked).count() == 0
    assert ranked_search(hard, asked.where("item_id = 2")).count() == 0
    assert ranked_search(hard, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_texts_are_taken_apart_in_pieces(spark, monkeypatch):
    text = " ".join(f"t{i % 700} u{i}" for i in range(9000))
    import pyarrow as pa

    terms = sorted(set(terms_of(text)))
    for size in (1 << 20, 1000, 37):
        monkeypatch.setattr(search, "TEXT_BYTES", size)
        [(row, lengths, doc, term, count)] = search._counted(pa.array([text]), search.Vocabulary(terms))
        assert (row, lengths.tolist(), set(doc.tolist())) == (0, [18_000], {0})
        assert {terms[t]: n for t, n in zip(term, count, strict=True)} == Counter(terms_of(text))


def test_vocabulary_compares_bytes(monkeypatch):
    import numpy as np

    monkeypatch.setattr(search, "span_hashes", lambda values, start, end, base: np.zeros(len(start), np.uint64))
    vocabulary = search.Vocabulary(["same"])
    data = np.frombuffer(b"same size sames", np.uint8)
    hit, term = vocabulary.find(data, *search._spans(data, np.array([0, len(data)])))
    assert hit.tolist() == [0] and term.tolist() == [0]


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, text)))


def proofs(rows, fan=FAN):
    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([sha(*x[i : i + fan]) for i in range(0, len(x), fan)])
        return levels

    def way(levels, i):
        for level in levels[:-1]:
            a = i // fan * fan
            yield "".join(level[a:i]), "".join(level[i + 1 : a + fan])
            i //= fan

    langs = {}
    for r in rows:
        langs.setdefault(r.lang, []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for x in order:
        langs[x].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    trees = [tree([leaf_of(r, r.text) for r in langs[x]]) for x in order]
    top = tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, x in enumerate(order):
        for i, r in enumerate(langs[x]):
            path = [*way(trees[k], i), *way(top, k)]
            spoiled = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            now = leaf_of(r, r.text.translate(LOWER) if spoiled else r.text)
            for a, b in path:
                now = sha(a, now, b)
            out.append((r.doc_id, leaf_of(r, r.text), trees[k][-1][0], root, sha(*(a + b for a, b in path)), now, now == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest_equals_a_plain_tree(spark, hard):
    rows = hard.withColumns({"n_chars": F.length("text").cast("long"), "_part": F.lit("x"), "rank": F.lit(1)})
    rows = rows.withColumn("doc_id", F.col("doc_id") * 17)
    more = [(i, f"Text {i}", f"l{i % 70}" if i % 5 else "en", "s", 1, "c", "k") for i in range(1000, 1600)]
    more += [(5000, "Same Row", "en", "s", 1, "c", "k")] * 90
    rows = rows.unionByName(spark.createDataFrame(more, hard.schema).withColumn("n_chars", F.lit(3).cast("long")), allowMissingColumns=True)
    got = sorted((tuple(r) for r in lower_case_tampering(rows).select(COLUMNS).collect()), key=repr)
    assert got == proofs(rows.collect())


def test_manifest_of_few_rows(spark, empty):
    assert manifest(empty.withColumn("n_chars", F.lit(1))).count() == 0
    for langs in (["en"], [None], ["en", "de"], ["en"] * 8, ["en"] * 9 + [None]):
        rows = spark.createDataFrame([(i, "T", x, "s", 1) for i, x in enumerate(langs)], "doc_id long, text string, lang string, source string, n_chars int")
        got = sorted((tuple(r) for r in lower_case_tampering(rows).select(COLUMNS).collect()), key=repr)
        assert got == proofs(rows.collect())


def test_paths_fold_and_any_change_shows(spark):
    rows = spark.range(200).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars")
    )
    found = manifest(rows, fan=3)
    assert found.where("verified").count() == 200
    assert found.select(fold(F.col("leaf"), F.col("path")).alias("r"), "root").where("r <> root").count() == 0
    assert manifest(rows, F.col("doc_id") < 7, F.lit("b"), fan=3).where("verified").count() == 193
    assert found.first()["root"] != manifest(rows.where("doc_id <> 5"), fan=3).first()["root"]


# Line rules


def base(text):
    text = text or ""
    ws = words(text)
    windows = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    again = {p for i in range(len(ws) - 7) if windows[tuple(ws[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(ws) < 20 or 100 * len(again) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
PROSE = "\n".join(f"Line number {i} says something else about topic {i * 7}." for i in range(12))


def report(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in line_report(rows).collect()}


def test_base_figures(spark, hard, empty):
    draw = random.Random(2)
    texts = [r[1] for r in hard_rows()] + ["\n".join(" ".join(draw.choices("abc#", k=9)) for _ in range(40)) for _ in range(30)]
    texts += ["\n", "x\r\nx\r\nx", "a b 🙂 🙂|", " ".join("abcdefgh" * 2), " ".join("abcdefghi" + "abcdefg"), PROSE]
    got = report(spark, texts)
    for i, text in enumerate(texts):
        assert tuple(got[i][c] for c in BASE) == base(text), text and text[:80]
    assert line_report(hard).count() == hard.count()
    assert line_report(empty).count() == 0


@pytest.mark.parametrize(
    "line, rule",
    [
        ("Home | News | Sports | About us", "navigation"),
        ("Read more", "navigation"),
        ("We use cookies, see our privacy policy.", "boilerplate"),
        ("© 2020 Somebody.", "boilerplate"),
        ("spam spam spam spam spam spam eggs eggs eggs.", "boilerplate"),
        ("Line number 3 says something else about topic 21.", "boilerplate"),
        ("this line just stops", "punctuation"),
        ("BUY!! NOW!! CHEAP!! STUFF!! HERE.", "punctuation"),
        ("odd%%% marks### all&&& over$$$ it.", "punctuation"),
        ("He said so (or did he?).", None),
        ("A price of 5% or $7 is fine when the line is long enough to carry it, is it not?", None),
        ("你好世界。", None),
        (" \t", None),
    ],
)
def test_each_rule(spark, line, rule):
    got = report(spark, [PROSE + "\n" + line])[0]
    assert [r for r in ("navigation", "boilerplate", "punctuation") if got[f"n_{r}"]] == ([rule] if rule else [])
    assert got.kept and got.clean_text == (PROSE if rule else PROSE + "\n" + line)
    assert got.lost_chars == (sum(map(len, words(line))) if rule else 0)


def test_rejects_what_loses_too_much(spark):
    menu = "\n".join(f"Home{i} | News | Sports{i * 3} | Contact" for i in range(9))
    got = report(spark, [PROSE, PROSE + "\n" + menu, menu + "\n" + PROSE[:60] + ".", None, "Too short."])
    assert [got[i].kept for i in range(5)] == [True, True, False, False, False]


def test_cleaned_keeps_columns_and_clean_documents(spark, hard, folder):
    rows = hard.withColumns({"row": F.lit(1), "report": F.lit("r"), "kept": F.lit(None).cast("int")})
    kept = cleaned(rows)
    assert kept.columns == rows.columns and kept.dtypes == rows.dtypes
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = QUERIES["op13_quality_rules"](spark, folder).join(labels, "doc_id").where("n_words >= 20")
    share = {r.quality: r.kept for r in scored.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share.get(0, 0) < 0.1


def test_line_rules_need_neither_python_nor_a_shuffle(spark, folder):
    plan = QUERIES["op13_quality_rules"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
