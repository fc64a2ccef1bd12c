"""The registered queries of the training-data operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import oracle
from affinity.llm.best_fit import pack_best_fit
from affinity.llm.common import read_table
from affinity.llm.decontam import decontaminate
from affinity.llm.embed_dedup import embedding_components
from affinity.llm.hard_negatives import mine_hard_negatives
from affinity.llm.html_template import extract_main_text
from affinity.llm.lang_id import held_out, identify_languages
from affinity.llm.license_scan import scan_licenses
from affinity.llm.packing import pack_documents
from affinity.llm.secret_scan import BASE_RULES, RULES, find_secrets, spans_text
from affinity.llm.simhash import simhash_components
from affinity.llm.token_count import count_tokens
from affinity.llm.turn_repair import damage, repair_conversations
from affinity.llm.url_filter import filter_urls


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select(
        "page_id",
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"),
        F.col("url_pattern").alias("pattern"),
    )


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("text")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = len(BASE_RULES)
    count = lambda i: F.size(F.filter("secret_spans", lambda s: s["kind"] == i)).cast("long")
    base = F.filter("secret_spans", lambda s: s["kind"] < n)
    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)),
        F.sha2(spans_text(base, RULES), 256).alias("base_sha256"),
        spans_text(F.col("secret_spans"), RULES).alias("spans"),
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    near = F.size("near_items").cast("long").alias("n_near_items")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", near)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(read_table(spark, sf_dir, "embeddings"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(read_table(spark, sf_dir, "conversations")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(read_table(spark, sf_dir, "documents"), keep_ids=False)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_license_scans,
        op3_simhash_dedup,
        op4_html_extraction,
        op5_secret_scans,
        op6_token_counts,
        op7_benchmark_decontamination,
        op8_packing,
        op9_language_id,
        op10_embedding_dedup,
        op11_turn_repair,
        op12_hard_negatives,
        op13_best_fit_packing,
    )
}


def llm_oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in LLM_QUERIES}
