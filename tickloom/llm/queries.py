"""One query per operator, on whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tickloom.llm.bpe import read_ranks, token_digests
from tickloom.llm.exact_dedup import exact_duplicates
from tickloom.llm.hmm import score_texts
from tickloom.llm.language import identified
from tickloom.llm.licenses import license_scan
from tickloom.llm.line_rules import line_report
from tickloom.llm.merkle import lower_case_tampering
from tickloom.llm.mixing import mix_plan
from tickloom.llm.near_dedup import near_duplicates
from tickloom.llm.quality import quality_scores
from tickloom.llm.search import ranked_search
from tickloom.llm.substring_dedup import repeated_passages
from tickloom.llm.text import held_out
from tickloom.llm.topk import top_k


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    left_out = held_out(F.col("doc_id"), 4, 2)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return identified(docs, ~left_out).select(
        "doc_id", left_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_plan(table(spark, folder, "documents")).drop("copies")


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_digests(table(spark, folder, "documents"), ranks)


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"), texts=False)


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


def op9_hidden_markov_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"), held_out(F.col("doc_id"), 7, 2))


def quality_left_out(doc_id):
    return held_out(doc_id, 3, 1)


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality_scores(docs, table(spark, folder, "labels"), quality_left_out)
    return scored.select(
        "doc_id",
        quality_left_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=20)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    proved = lower_case_tampering(table(spark, folder, "documents"))
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_report(table(spark, folder, "documents")).drop("clean_text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_top_k,
        op2_language_id,
        op3_source_mix,
        op4_minhash_near_dedup,
        op5_byte_bpe,
        op6_license_scan,
        op7_substring_dedup,
        op8_exact_dedup,
        op9_hidden_markov_lm,
        op10_quality_classifier,
        op11_ranked_search,
        op12_merkle_manifest,
        op13_quality_rules,
    )
}
