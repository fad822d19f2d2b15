"""Exact, near and passage dedup, and mixing, against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from cases import LOWER, empty, folder, hard, hard_rows, small, words  # noqa: F401

from tickloom.llm.components import components
from tickloom.llm.exact_dedup import digests, exact_duplicates, merge_runs, merge_tree, without_duplicates
from tickloom.llm.mixing import mix_plan, mixed, source_targets
from tickloom.llm.near_dedup import _possible, _within, near_duplicates, without_near_duplicates
from tickloom.llm.queries import QUERIES
from tickloom.llm.substring_dedup import repeated_passages


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return Counter(out)


def test_exact_on_hard_rows(hard, empty):
    got = exact_duplicates(hard).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert Counter(map(tuple, got.collect())) == exact_expected([r[:2] for r in hard_rows()])
    assert exact_duplicates(empty).count() == 0


def test_runs_are_sorted_and_merged_across_batches(spark):
    rows = [(i, f"t{i % 7}" if i % 3 else "HOT" if i % 2 else "hot") for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # one digest goes over many batches
    try:
        plan = merge_tree(digests(docs), "largest", 8)
        got = exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
        runs = merge_runs(digests(docs).selectExpr("0L slot", "text_sha256", "check", "doc_id keep_id", "1L copies"), "smallest")
        runs = runs.selectExpr("spark_partition_id() part", "*").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert Counter(map(tuple, got)) == exact_expected(rows)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in text and text.count("MapInArrow") == 2 and text.count("Sort [") >= 2
    assert sum(r.copies for r in runs) == 3_000
    for part in {r.part for r in runs}:
        found = [r.text_sha256 for r in runs if r.part == part]
        assert found == sorted(set(found))


def test_exact_smallest_and_bad_choice(hard):
    rows = {r.doc_id: r.keep_id for r in exact_duplicates(hard, keep="smallest").collect()}
    assert rows[3] == 1 and rows[12] == 11
    with pytest.raises(ValueError):
        exact_duplicates(hard, keep="first")


def test_one_row_stays_per_text(hard):
    rows = without_duplicates(hard).collect()
    assert len(rows) == len({(r.text or "").translate(LOWER) for r in rows})
    assert rows[0].asDict().keys() == set(hard.columns)


def shingles(text, size=5):
    found = words(text, lower=True)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def near_expected(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
    return {doc_id: (len(sets[i]), rows[find(i)][0]) for i, (doc_id, _) in enumerate(rows)}


def test_near_on_hard_rows(hard, empty):
    rows = [r[:2] for r in hard_rows() if r[0] is not None]
    got = near_duplicates(hard).collect()
    assert len(got) == len(hard_rows())
    known = {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None}
    assert known == near_expected(rows)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_duplicates(empty).count() == 0


def test_near_on_small_tables(spark, folder, small):
    got = QUERIES["op4_minhash_near_dedup"](spark, folder).collect()
    expected = near_expected([(r["doc_id"], r["text"]) for r in small])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_near_group_is_one_component(spark):
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):  # two edits each, so that copies differ more from each other than from the base
        text = list(base)
        text[(7 * i) % 150], text[(31 * i + 5) % 150] = f"x{i}", f"y{i}"
        rows.append((i, " ".join(text)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in near_expected(rows).items()}


def test_one_of_a_near_group_stays(hard):
    kept = {r.doc_id for r in without_near_duplicates(hard).collect()}
    assert 1 in kept and not kept & {2, 3, 4}


def test_one_id_on_two_texts_keeps_the_links_of_both(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(100)) for x in "ab")
    rows = [(1, a), (2, a + " tail"), (2, b), (3, b + " end"), (4, "none of these words")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string")
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs).collect())
        assert got == [(1, 96, 1), (2, 96, 2), (2, 97, 1), (3, 97, 2), (4, 1, 4)]
        stay = {(r.doc_id, r.text) for r in without_near_duplicates(docs).collect()}
        assert stay == {(1, a), (2, b), (4, "none of these words")}


def boilerplate(count):
    """Texts of a shared notice and words of their own, too few in common to be links."""
    notice = " ".join(f"notice{i}" for i in range(204))
    return [(i, notice + " " + " ".join(f"own{i}x{k}" for k in range(40 + i % 5))) for i in range(count)]


def test_texts_that_share_boilerplate_are_not_linked(spark):
    rows = boilerplate(200) + [(1000, boilerplate(1)[0][1] + " more")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in near_expected(rows).items()}


def test_a_list_is_compared_by_distinct_bounds(spark):
    shape = "key long, id long, c long, n long, m long, h long, keys array<long>"
    # 40 kinds of bounds, whatever the number of members; all below 0.75
    rows = [(7, i, i, 260 + i % 40, 200, 200, [7]) for i in range(4_000)]
    rows += [(7, 9_000 + i, 9_000 + i % 2, 220, 215, 205, [7]) for i in range(4)]  # two components, may be links
    rows += [(7, 9_100 + i, 9_100, 500, 500, 500, [7]) for i in range(50)]  # one component already
    rows += [(8, i, i, 30, 30, -1, [7, 8]) for i in (9_000, 9_001)]  # a pair of both lists counts once, in list 7
    members = spark.createDataFrame(rows, shape)
    compared = [tuple(r) for r in _possible(members, 75).collect()]
    assert sorted(compared) == [(7, 220, 215, 205), (8, 30, 30, -1)]
    members = members.withColumn("keys", F.when(F.col("id").isin(9_000, 9_001), F.array(F.lit(7), F.lit(8))).otherwise(F.col("keys")).cast("array<long>"))
    got = sorted(map(tuple, _within(members, 75).collect()))
    assert got == [(9_000, 9_001), (9_000, 9_003), (9_001, 9_002), (9_002, 9_003)]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def passages_expected(rows, window):
    found = [words(t) for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in found for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, found, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        rest = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), sha(rest), rest))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 4, 7])
def test_passages_on_hard_rows(hard, window):
    rows = [r[:2] for r in hard_rows() if r[0] != 14]
    got = repeated_passages(hard.where("doc_id is null or doc_id != 14"), window)
    got = got.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect()
    assert Counter(map(tuple, got)) == passages_expected(rows, window)


def test_passages_within_one_long_text(hard, empty):
    row = repeated_passages(hard.where("doc_id = 14")).first()
    assert (row.n_words, row.n_removed, row.kept_text) == (30_000, 30_000, "")
    assert repeated_passages(empty).count() == 0


def test_passages_on_small_tables(spark, folder, small):
    got = QUERIES["op7_substring_dedup"](spark, folder).select("doc_id", "n_words", "n_removed", "kept_sha256")
    expected = passages_expected([(r["doc_id"], r["text"]) for r in small], 35)
    assert Counter(map(tuple, got.collect())) == Counter(x[:4] for x in expected.elements())


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by the rule's own words: cap, share the rest by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in held]
        unit = (total - sum(most * sizes[s] for s in held)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * unit > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in held else weight[s] * unit for s in names}
        held |= over


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 1000, "c": 5, None: 50}, {"a": 0, "b": 0}, {"a": 0, "b": 7}, {"é": 3, "z": 900, "A": 40, "b": 41, "c": 1}],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    expected = fill(sizes)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[s], expected[s], abs_tol=1e-9) for s in got)


def test_mix_plan_and_mix_agree(hard, empty):
    plan = mix_plan(hard).collect()
    assert len(plan) == hard.count()
    assert all(r.copies in (0, 1, 2, 3) and r.taken == r.copies * r.size for r in plan)
    assert [tuple(r) for r in plan] and sorted(map(str, plan)) == sorted(map(str, mix_plan(hard).collect()))
    made = Counter(r.doc_id for r in mixed(hard).collect())
    wanted = Counter()
    for r in plan:
        wanted[r.doc_id] += r.copies
    assert made == +wanted
    assert mixed(hard).columns == hard.columns
    assert mix_plan(empty).count() == 0 and mixed(empty).count() == 0


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (i % 40 + 1), f"s{i % 4}") for i in range(8000)]
    plan = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    by = plan.groupby(plan.doc_id % 4).agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by.taken / by.target - 1).abs() < 0.05).all()
