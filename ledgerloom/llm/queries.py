"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat, dedup, jaccard, leaks, licenses, merkle, mixing, sharding, spans, toxicity, urls, variants, vectors
from ledgerloom.plans.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = leaks.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_report(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(table(spark, sf_dir, "conversations"))


def chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as JSON records in mixed layouts, each read by its own fingerprint and formatted."""
    turns, _ = chat.json_turn_rows(chat.as_records(chat.turn_rows(table(spark, sf_dir, "conversations"))))
    return chat.digests(turns)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.spans_report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf_dir, "documents"))


def op12_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_ngram_jaccard_join, op3_source_mixing, op4_benchmark_decontamination, op5_toxicity, op6_license_scan, op7_exact_dedup, op8_chat_format, op9_url_filter, op10_substring_dedup, op11_merkle_manifest, op12_top_k_search, op13_spelling_variants, chat_layouts)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES = {
    "op3_source_mixing": mixing.ORACLE,
    "op7_exact_dedup": f"""
WITH r AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM r WINDOW w AS (PARTITION BY t)
""",
    "op8_chat_format": chat.ORACLE,
    "chat_layouts": f"{chat.ORACLE} WHERE conv_id IS DISTINCT FROM -1",
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_top_k_search": vectors.ORACLE,
    "op13_spelling_variants": variants.ORACLE,
}
