"""Registered queries of this subpackage: one for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (decontaminate, embed_dedup, filter_audit, html_extract, lang_id, license_scan, merkle, mixing,
                        packing, pii, quality, simhash, sql, url_filter)
from larder.llm.common import table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filter.url_filter(pages, url_filter.train(pages))
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.license_scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.html_extract(pages, html_extract.train(pages)).select("page_id", "url", "text", "n_chars")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_words(docs)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_id.train(docs)
    found = lang_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", lang_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_components(table(spark, sf_dir, "embeddings"))


def op9_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_filter(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        *quality.FLOOR, *[f"limit_{m}" for m in quality.FLOOR])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = merkle.manifest(docs, merkle.tampered_leaf(docs), keep_paths=False)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.corpus_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and rule of every URL: operator 1 without its models."""
    found = url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), None)
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict")
    return found.select("page_id", "host", "path", "rule", ruled)


def op2_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict spans of operator 2."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), None)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def op3_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and places of the base phrases of operator 3."""
    return op3_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def op5_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of operator 5, before anything is drawn."""
    mix = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id"])
    return mix.docs.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"))


def op10_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and base verdict of operator 10, before any sketch."""
    found = quality.measures(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_url_filter, op2_pii, op3_license_scan, op4_html_extract, op5_mix_sources, op6_language_id, op7_simhash_dedup,
           op8_embedding_dedup, op9_lexical_packing, op10_quality_rules, op11_merkle_manifest, op12_filter_audit,
           op13_decontamination, pipeline)
    return {f.__name__: f for f in own}


def base_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The columns that the definitions fix of operators 1, 2, 3, 5 and 10."""
    return {f.__name__: f for f in (op1_rules, op2_base, op3_base, op5_targets, op10_base)}


def oracle_sql() -> dict[str, str]:
    """SQL for the results that hold no learned, drawn or sketched column.

    The tests hold the other queries against a brute-force version, held-out
    labels or an exact round trip; their columns that the definitions fix have
    queries of their own (``base_queries``).
    """
    return {"op8_embedding_dedup": sql.EMBEDDING_DEDUP, "op11_merkle_manifest": sql.MERKLE, "op12_filter_audit": sql.FILTER_AUDIT,
            "op13_decontamination": sql.DECONTAMINATION}


def base_oracle_sql() -> dict[str, str]:
    """SQL for all of ``base_queries``."""
    return {"op1_rules": sql.URL_RULES, "op2_base": sql.PII_BASE, "op3_base": sql.LICENSE_BASE, "op5_targets": sql.MIX_TARGETS,
            "op10_base": sql.QUALITY_BASE}
