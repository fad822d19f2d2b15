"""Search, language, tokens, licences, language model and quality, against brute force or held-out rows."""

import base64
import hashlib
import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from cases import empty, hard, hard_rows, small, words  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm import bpe, hmm, language, quality
from tickloom.llm.licenses import TEMPLATES, license_scan
from tickloom.llm.queries import QUERIES, quality_left_out
from tickloom.llm.text import held_out
from tickloom.llm.topk import scores, top_k
from tickloom.llm.words import blocks as block_words


def brute_top(rows, k, scale=1024):
    clean = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.append((i, [math.floor(scale * x) for x in v]))
    out = {}
    for q, v in clean:
        if q % 100 == 0:
            found = [(-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in clean if c != q and len(w) == len(v)]
            out[q] = [(c, -s) for s, c in sorted(found)[:k]]
    return {q: x for q, x in out.items() if x}


def top_of(rows):
    out = {}
    for r in rows.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_top_k_with_ties_nulls_and_few_rows(spark):
    draw = np.random.RandomState(3)
    rows = [(i, [float(x) for x in draw.randint(-2, 3, 4)]) for i in range(450)]
    rows += [(450, None), (451, [1.0, None, 0.0, 0.0]), (452, [float("nan")] * 4), (453, [float("inf")] * 4)]
    rows += [(None, [1.0] * 4), (500, [1.0, 2.0]), (501, [3.0, 4.0]), (601, [5.0, -1.0]), (7, rows[7][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top_of(top_k(table, F.col("vec_id") % 100 == 0, 10)) == brute_top(rows, 10)
    assert top_of(top_k(table, F.col("vec_id") % 100 == 0, 600)) == brute_top(rows, 600)
    assert top_k(table.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_in_several_blocks(spark, monkeypatch):
    from tickloom.llm import topk

    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 4 * 2)
    draw = np.random.RandomState(4)
    rows = [(i, [float(x) for x in draw.randn(4)]) for i in range(520)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top_of(top_k(table, F.col("vec_id") % 100 == 0, 3)) == brute_top(rows, 3)


def test_scores_are_exact_or_refused():
    big = np.array([[2**40, 1]])
    assert scores(big, np.array([[2**20, 3]]))[0, 0] == 2**60 + 3
    with pytest.raises(OverflowError):
        scores(big, big)


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


@pytest.fixture(scope="module")
def reference():
    pairs = (line.split() for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_vocabularys():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def odd_texts():
    draw = np.random.RandomState(9)
    letters = list("ab'sStTmdrevl  \n\t\r.,!1²½éß你🙂  \x1c_-") + ["'re", "'ll", " the", "ing", "  ", "\n\n"]
    return ["".join(draw.choice(letters, draw.randint(0, 60))) for _ in range(3000)]


def test_pieces_and_ids_equal_the_library(coder, reference):
    texts = [*odd_texts(), "", "a" * 9000, "ab" * 3000, " " * 500, "=" * 4001, "it's we'll 'tis 's' ''s 'S", "<|endoftext|>"]
    ids = list(coder.encode(pa.array(texts)))
    assert [np.frombuffer(x, np.uint32).tolist() for x in ids] == [reference.encode_ordinary(t) for t in texts]
    assert list(coder.decode(ids)) == [t.encode() for t in texts]


@pytest.mark.parametrize("size", [250, 256, 257, 5_000, 200_000])
def test_long_words_end_and_equal_the_library(coder, reference, size):
    """Random words over few letters, where many pairs wait for each other."""
    for letters in ("abcd", "01", "eé", "="):
        draw = np.random.RandomState(size)
        word = "".join(draw.choice(list(letters), size))
        [ids] = coder.encode(pa.array([word]))
        assert np.frombuffer(ids, np.uint32).tolist() == reference.encode_ordinary(word)


def test_pieces_are_remembered_and_forgotten(reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 400)
    coder = bpe.Coder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    draw = np.random.RandomState(4)
    texts = [" ".join("".join(draw.choice(list("abcdefgh"), draw.randint(3, 7))) for _ in range(40)) + " always here again" for _ in range(60)]
    asked = []
    encode = coder.encode_pieces
    monkeypatch.setattr(coder, "encode_pieces", lambda pieces: asked.append(pieces) or encode(pieces))
    for text in texts:
        [ids] = coder.encode(pa.array([text]))
        assert np.frombuffer(ids, np.uint32).tolist() == reference.encode_ordinary(text)
    assert len(coder.memory.large[0]) <= 400
    # what is met in every text is encoded once; what is not is forgotten some time
    assert sum(p.count(b" always") for p in asked) == 1
    list(coder.encode(pa.array([texts[0]])))
    assert len(asked[-1]) > 20


def test_a_full_memory_stays_small():
    """Entries are narrow, and merging the late ones takes a fixed amount beside the tables."""
    memory, draw = bpe.Memory(400_000, 50_257), np.random.RandomState(2)
    hashes = np.unique(draw.randint(0, 1 << 62, 390_000)).astype(np.uint64)
    size = draw.randint(1, 7, len(hashes))
    size[7] = 300  # too long to be remembered
    ids = draw.randint(0, 50_257, size.sum()).astype(np.uint32)
    ends = np.cumsum(size)
    tracemalloc.start()
    try:
        for at in range(0, len(hashes), 30_000):
            a, b = (ends[at - 1] if at else 0), ends[min(at + 30_000, len(ends)) - 1]
            memory.add(hashes[at : at + 30_000], ids[a:b], size[at : at + 30_000])
        kept, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert kept < 22 * len(hashes) and most < 100 * len(hashes)
    known, flat, found = memory.find(hashes)
    assert not known[7] and found[7] == 0 and known.sum() == len(hashes) - 1
    assert (flat == np.delete(ids, np.arange(ends[6], ends[7]))).all()


def test_token_digests_on_hard_rows(hard, empty, reference):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = Counter(map(tuple, bpe.token_digests(hard, ranks).collect()))
    expected = Counter()
    for doc_id, text, *_ in hard_rows():
        ids = np.array(reference.encode_ordinary(text or ""), "<u4")
        sha = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (text or "").encode())]
        expected[(doc_id, len(ids), *sha)] += 1
    assert got == expected
    assert bpe.encoded(empty, ranks).count() == 0


def test_encoded_rows_decode_to_their_texts(hard):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    back = bpe.decoded(bpe.encoded(hard, ranks), ranks)
    assert back.columns == [*hard.columns, "token_ids", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back.collect())


def test_codewords_differ():
    for n in (2, 4, 7, 9, 40):
        code = language.codewords(n)
        assert len({tuple(r) for r in code}) == n
        assert all(abs(c.sum()) < n for c in code.T)


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}
    rows = [r for r in QUERIES["op2_language_id"](spark, folder).collect() if r.held_out]
    assert len(rows) > 100 and sum(r.lang_pred == langs[r.doc_id] for r in rows) / len(rows) > 0.99


def test_language_on_hard_rows(hard, empty):
    got = language.identified(hard, F.lit(True))
    for r in got.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert got.count() == len(hard_rows())
    assert language.identified(empty, F.lit(True)).count() == 0
    assert {r.lang_pred for r in language.identified(hard, F.lit(False)).collect()} == {"und"}
    one = language.identified(hard, F.col("lang") == "en").where("doc_id = 1").first()
    assert one.lang_pred == "en"


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{folder}/labels.parquet").to_pylist()}
    got = [r for r in QUERIES["op10_quality_classifier"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in got) / len(got) > 0.95


def test_quality_on_hard_rows(spark, hard, empty):
    labels = [(1, 1), (3, 1), (5, 1), (17, 0), (6, 0), (None, 1), (9, None), (1, 1), (4, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    never = lambda c: F.lit(False)
    got = quality.quality_scores(hard, labels, never)
    assert got.count() == len(hard_rows()) and got.where("quality_score between 0 and 1").count() == len(hard_rows())
    assert quality.quality_scores(empty, labels, never).count() == 0
    one_class = quality.quality_scores(hard, labels.where("quality = 1"), never)
    assert one_class.where("quality_score < 0.99").count() == 0
    assert quality.quality_scores(hard, labels.where("false"), never).first().quality_score == 0.5
    assert quality.accepted(hard, labels, never).columns == hard.columns


def test_quality_labels_of_held_out_rows_are_not_used(spark, hard):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 18)], "doc_id long, quality int")
    left = quality_left_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(left, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda x: sorted(
        (str(r.doc_id), r.quality_score) for r in quality.quality_scores(hard, x, quality_left_out).collect()
    )
    assert score(labels) == score(turned)


def test_base_scores_and_counts(spark, hard):
    rows = [(i, words(t, lower=True) + [None]) for i, t, *_ in hard_rows()]
    left = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not left(i) for w in t)
    total, distinct = sum(count.values()), len(count)
    got = hmm.score_texts(hard, held_out(F.col("doc_id"), 7, 2), rounds=1).collect()
    expected = sorted(
        (str(i), left(i), len(t), sum(count[w] > 0 for w in t), total, round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t), 4))
        for i, t in rows
    )
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got)
    assert found == expected
    assert all(r.score < 0 for r in got)


def test_rare_words_are_counted_in_shards(spark, monkeypatch):
    rows = [(i, f"the a{i % 50} b{i % 7} c{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = hmm.score_texts(docs, held_out(F.col("doc_id"), 7, 2), frequent=3).toPandas().sort_values("doc_id")
    many = hmm.score_texts(docs, held_out(F.col("doc_id"), 7, 2)).toPandas().sort_values("doc_id")
    monkeypatch.setattr(hmm, "SHARD_BYTES", 100)  # more shards than shuffle partitions
    more = hmm.score_texts(docs, held_out(F.col("doc_id"), 7, 2), frequent=3).toPandas().sort_values("doc_id")
    assert few.n_known.tolist() == many.n_known.tolist() == more.n_known.tolist()
    assert np.allclose(few.score, more.score)
    assert np.allclose(few.base_score, many.base_score)


def test_without_texts_to_learn_from(spark, hard, empty):
    got = hmm.score_texts(hard, F.lit(True)).collect()
    assert len(got) == len(hard_rows()) and all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert hmm.score_texts(empty, F.lit(False)).count() == 0


def test_forward_recursion_sums_over_all_paths():
    draw = np.random.RandomState(1)
    share = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(draw.rand(*s))
    start, chain, emit = share(3), share(3, 3), share(3, 5).T
    symbols, bounds = draw.randint(5, size=9).astype(np.uint16), np.array([0, 4, 4, 9])
    got = hmm.likelihoods((start, start, chain, emit), symbols, bounds)
    for d in range(3):
        part = symbols[bounds[d] : bounds[d + 1]]
        total = 0.0
        for path in np.ndindex(*[3] * len(part)):
            p = 1.0
            for t, (k, s) in enumerate(zip(path, part, strict=True)):
                p *= (start[k] if t == 0 else chain[path[t - 1], k]) * emit[s, k]
            total += p
        assert math.isclose(got[d], math.log10(total), abs_tol=1e-9)


def test_baum_welch_raises_the_likelihood():
    draw = np.random.RandomState(2)
    texts = [draw.randint(0, 10, 50) if i % 2 else draw.randint(10, 20, 50) for i in range(40)]
    symbols, bounds = np.concatenate(texts).astype(np.uint16), np.arange(41) * 50
    unigram = np.full(20, 0.05)
    before = -math.inf
    for rounds in (0, 1, 3, 8):
        now = hmm.likelihoods(hmm.first_model(symbols, bounds, unigram, 2, rounds), symbols, bounds).sum()
        assert now > before - 1e-6
        before = now
    assert before / len(symbols) > math.log10(0.08)  # two kinds of text, ten symbols each


def test_frequent_words_come_from_all_texts(spark):
    """One long text and a few of 3,000 hold what is frequent: no bounded choice of texts finds both."""
    rows = [("long " * 9_000,)] + [(f"w{i}" + " few" * (i % 100 == 0),) for i in range(3_000)]
    found = hmm._frequent(spark.createDataFrame(rows, "text string"), 3)
    want = np.concatenate([b.hashes for b in block_words(pa.array(["long few"]), lower=True)])
    assert set(found.tolist()) == {*want.view(np.int64).tolist(), int(hmm.END.view(np.int64))}


def test_expected_counts_are_those_of_whole_texts():
    draw = np.random.RandomState(1)
    share = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(draw.rand(*s))
    start, chain, emit = share(3), share(3, 3), share(3, 5).T
    symbols, bounds = draw.randint(5, size=300).astype(np.uint16), np.array([0, 4, 4, 9, 109, 300])
    got, want = hmm._empty(3, 5), hmm._empty(3, 5)
    hmm.expected((start, chain, emit), symbols, bounds, got)
    for part in np.split(symbols, bounds[1:-1]):
        ahead, behind = [start * emit[part[:1]].prod(0)], [np.ones(3)]
        for s in part[1:]:
            ahead.append((ahead[-1] @ chain) * emit[s])
        for s in part[:0:-1]:
            behind.insert(0, chain @ (emit[s] * behind[0]))
        total = ahead[-1].sum()
        for t, s in enumerate(part):
            now = ahead[t] * behind[t] / total
            want[2][s] += now
            want[0] += now if t == 0 else 0
            if t + 1 < len(part):
                want[1] += np.outer(ahead[t], emit[part[t + 1]] * behind[t + 1]) * chain / total
    assert all(np.allclose(g, w) for g, w in zip(got, want, strict=True))


def test_windows_of_any_size_give_the_same_counts(monkeypatch):
    draw = np.random.RandomState(3)
    share = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(draw.rand(*s))
    model = share(3), share(3, 3), share(3, 7).T
    length = np.concatenate(([4_000, 0, 1], draw.randint(0, 60, 90)))
    bounds = np.concatenate(([0], np.cumsum(length)))
    symbols = draw.randint(7, size=bounds[-1]).astype(np.uint16)
    whole = hmm._empty(3, 7)
    hmm.expected(model, symbols, bounds, whole)
    assert math.isclose(whole[2].sum(), bounds[-1], rel_tol=1e-4)
    for texts, window, kept in ((7, 50, 60), (1, 1, 1), (500, 100, 1 << 18)):
        monkeypatch.setattr(hmm, "TEXTS", texts)
        monkeypatch.setattr(hmm, "WINDOW", window)
        monkeypatch.setattr(hmm, "KEPT", kept)
        got = hmm._empty(3, 7)
        hmm.expected(model, symbols, bounds, got)
        assert all(np.allclose(g, w, rtol=1e-4) for g, w in zip(got, whole, strict=True))


def test_unlikely_symbols_do_not_underflow():
    """States that all but exclude each other's symbols, met in turn, stay finite in single precision."""
    emit = np.array([[1 - 1e-6, 1e-6], [1e-6, 1 - 1e-6]])
    model = np.array([0.5, 0.5]), np.array([[1 - 1e-9, 1e-9], [1e-9, 1 - 1e-9]]), emit
    symbols = np.tile([0, 1], 5_000).astype(np.uint16)
    got = hmm._empty(2, 2)
    hmm.expected(model, symbols, np.array([0, 10_000]), got)
    assert all(np.isfinite(x).all() for x in got) and math.isclose(got[2].sum(), 10_000, rel_tol=1e-3)


def test_extrapolated_rounds_reach_what_plain_ones_do(small, monkeypatch):
    hashes = [np.concatenate([b.hashes for b in block_words(pa.array([r["text"] or ""]), lower=True)] or [[]]) for r in small]
    bounds = np.concatenate(([0], np.cumsum([len(h) for h in hashes])))
    _, symbols, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    symbols, unigram = symbols.astype(np.uint16), (counts + 1) / (counts.sum() + len(counts))
    score = lambda rounds: hmm.likelihoods(hmm.first_model(symbols, bounds, unigram, 4, rounds), symbols, bounds).sum()
    fast = score(hmm.ROUNDS)
    monkeypatch.setattr(hmm, "STRIDE", 1.0)
    assert fast >= score(22) * 1.002  # logarithms, below zero


def test_more_symbols_than_their_bits_are_refused(spark, hard, monkeypatch):
    monkeypatch.setattr(hmm, "BUCKETS", 1 << 16)
    with pytest.raises(ValueError, match="16 bits"):
        hmm.score_texts(hard, held_out(F.col("doc_id"), 7, 2))


def test_model_beats_the_base_on_held_out_rows(spark):
    rows = QUERIES["op9_hidden_markov_lm"](spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum()


def test_licenses_found_with_their_differences(spark, empty):
    rows = [(i, f"Some words before. {t} And some after.") for i, t in enumerate(TEMPLATES.values())]
    rows += [
        (100, "text This work is licensed under the GNU General Public License, version 9. more"),
        (101, "A license to drive is not a notice."),
        (102, None),
        (103, ""),
        (104, "Licensed under CC BY-NC 4.0.\n" + "word " * 20_000 + "\nAll rights reserved."),
        (None, "All rights reserved."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))
    got = license_scan(docs).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append(r.license)
    for i, name in enumerate(TEMPLATES):
        assert name in found[i]
    changed = [r for r in got if r.doc_id == 100]
    assert [(r.license, r.exact, r.missing) for r in changed] == [("GPL-2.0", False, ["2"])]
    assert found[104] == ["CC-BY-NC-4.0", "Proprietary"] and found[None] == ["Proprietary"]
    assert not {101, 102, 103} & found.keys()
    assert license_scan(empty).count() == 0


def test_neighbouring_licenses_do_not_hide_each_other(spark):
    joins = [" ", " and some prose then "]
    pairs = [(a, b, j) for a in TEMPLATES for b in TEMPLATES for j in joins]
    rows = [
        (i, f"Some prose first. {TEMPLATES[a]}{j}{TEMPLATES[b]} Then more prose follows the notices here and there.")
        for i, (a, b, j) in enumerate(pairs)
    ]
    found = {}
    for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r.doc_id, []).append((r.block, r.license, r.exact))
    assert [sorted(found[i]) for i in range(len(pairs))] == [[(0, a, True), (1, b, True)] for a, b, _ in pairs]


def test_all_license_lines_of_the_small_table(spark):
    folder = "/root/testdata/sf0.01"
    texts = [r["text"] for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]
    found = Counter(r.license for r in QUERIES["op6_license_scan"](spark, folder).collect())
    for name in ("GPL-3.0", "Proprietary", "CC-BY-NC-4.0", "MIT-short", "Apache-2.0"):
        assert found[name] == sum(t.count(TEMPLATES[name]) for t in texts)
