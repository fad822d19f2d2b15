"""The pipeline's stages, one after the other, and SQL side by side with the queries."""

from collections import Counter

import corpus_pipeline
import duckdb
import pandas as pd
import pytest
from cases import folder, hard_rows, words  # noqa: F401
from pyspark.sql import functions as F

from tickloom.llm.mixing import _numbered
from tickloom.llm.oracle import ORACLE
from tickloom.llm.queries import QUERIES, table


def test_stages_keep_clean_documents_and_columns(spark, folder):
    docs = table(spark, folder, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    start, columns = docs.count(), docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder).cache()
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    gone = start - len(kept["quality"])
    assert 0 < gone < start / 2
    ids = {r.doc_id for r in kept["quality"]}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) > 0.95 * len(good)
    texts = Counter((r.text or "").lower() for r in kept["exact_dedup"])
    assert texts.most_common(1)[0][1] == 1 and len(texts) == len({(r.text or "").lower() for r in kept["quality"]})
    assert len(kept["near_dedup"]) <= len(kept["exact_dedup"])
    assert {r.doc_id for r in kept["mix"]} <= {r.doc_id for r in kept["near_dedup"]}
    assert Counter(r.doc_id for r in kept["tokens"]) == Counter(r.doc_id for r in kept["mix"])
    assert all(len(r.token_ids) >= 4 for r in kept["tokens"] if words(r.doc_id and "x"))


def test_run_equals_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert [f.name for f in corpus_pipeline.run(spark, folder).schema] == ["doc_id", "source", "lang", "token_ids"]
    again = corpus_pipeline.run(spark, folder).collect()
    key = lambda r: (r.doc_id, bytes(r.token_ids))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_the_mix_starts_no_python_worker(spark, folder):
    """Workers that a small list of numbers needs stay beside those of the next stage."""
    sizes = table(spark, folder, "documents").groupBy("source").agg(F.sum(F.length("text")).alias("source_size"))
    numbered = _numbered(sizes)
    assert "ExistingRDD" not in numbered._jdf.queryExecution().toString()
    assert sorted(r.place for r in numbered.collect()) == list(range(sizes.count()))


CLASHING = "label int, _id long, _key string, key string, row int, token_ids string, quality_score double, copies string, n long"


def tables(spark, path, rows):
    """A folder with documents, whose other columns have the names that stages use themselves, and labels."""
    more = [c.split() for c in CLASHING.split(", ")]
    docs = spark.createDataFrame([(*r[:4], len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({name: F.lit("7").cast(kind) for name, kind in more}).write.parquet(f"{path}/documents.parquet")
    ids = sorted({r[0] for r in rows if r[0] is not None})
    marks = [(i, int(i % 4 != 0), 0) for i in ids] + [(None, 1, 0), (10_000, None, None)] * bool(rows)
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_run_takes_hard_rows_and_clashing_columns(spark, tmp_path):
    prose = [(100 + i, " ".join(f"word{i}x{j}" for j in range(60)) + ".", "en", f"s{i % 3}") for i in range(40)]
    rows = [*hard_rows(), *prose, *prose[:3], (101, "another text " * 9 + "under a used id", "en", None)]
    tables(spark, tmp_path, rows)
    kept = {r[0] for r in rows}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and {r.doc_id for r in got} <= kept
    docs = table(spark, str(tmp_path), "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        assert docs.where("label <> 7 OR _id <> 7 OR _key <> '7' OR row <> 7 OR n <> 7").count() == 0


def test_run_on_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    db = duckdb.connect()
    for view in ("documents", "embeddings", "benchmark"):
        db.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{folder}/{view}.parquet')")
    got, expected = QUERIES[name](spark, folder).toPandas(), db.sql(ORACLE[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    put = lambda x: x[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(put(got), put(expected), check_dtype=False)


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
