"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstream.llm import compact_windows, decontaminate, katz, language, packing, pii, prefix_trie, ranked_search, simhash, suffix_dedup, threshold_topk, url_filter, warc
from tripstream.llm.common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.report(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_topk.report(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.report(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_pii": op1_pii,
    "op2_url_filter": op2_url_filter,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_compact_windows": op4_compact_windows,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_language": op6_language,
    "op7_threshold_topk": op7_threshold_topk,
    "op8_simhash": op8_simhash,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_k2_treap_search": op12_k2_treap_search,
    "op13_katz_backoff": op13_katz_backoff,
}
