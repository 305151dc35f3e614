"""The registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthlog.llm import (
    byte_repeats,
    decontamination,
    filter_audit,
    html_extraction,
    importance_sampling,
    jaccard_join,
    oracles,
    packing,
    quality_rules,
    secret_scan,
    source_mixing,
    token_counts,
    topk_search,
    word_repeats,
)

# Names of vocabulary files of the public tokenizers, which workers look up.
BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.top_k(vectors, F.col("vec_id") % 100 == 0)


def op2_word_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return word_repeats.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(secret_scan.BASE_KINDS))

    def found(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return secret_scan.scan_secrets(docs).select(
        "doc_id",
        *map(found, secret_scan.BASE_KINDS),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"),
    )


def op4_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_repeats.without_repeats(docs, keep_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return packing.pack_documents(docs, BYTE_BPE)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = source_mixing.queue(docs).where(F.col("copy") == 1)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, WORD_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return html_extraction.extract_main_text(pages).select(
        "page_id", "url", text.alias("text"), F.length(text).cast("bigint").alias("n_chars")
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    target = _read(spark, sf_dir, "benchmark").select("text")
    return importance_sampling.resample(docs, target).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    items = _read(spark, sf_dir, "benchmark").select("item_id", "text")
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return decontamination.contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_near",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labels = _read(spark, sf_dir, "labels")
    return filter_audit.filter_audit(docs, labels)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_topk_search,
        op2_word_repeats,
        op3_secret_scan,
        op4_byte_repeats,
        op5_packing,
        op6_source_mixing,
        op7_token_counts,
        op8_html_extraction,
        op9_jaccard_join,
        op10_quality_rules,
        op11_importance_sampling,
        op12_decontamination,
        op13_filter_audit,
    ]
    return {query.__name__: query for query in own}


def oracle_sql() -> dict[str, str]:
    """Tokenization, checksums and parsers are left to the tests' brute force."""
    return {
        "op1_topk_search": oracles.TOPK,
        "op2_word_repeats": oracles.WORD_REPEATS,
        "op4_byte_repeats": oracles.BYTE_REPEATS,
        "op6_source_mixing": oracles.SOURCE_MIXING,
        "op9_jaccard_join": oracles.JACCARD_JOIN,
        "op10_quality_rules": oracles.quality_rules(),
        "op11_importance_sampling": oracles.IMPORTANCE_SAMPLING,
        "op12_decontamination": oracles.DECONTAMINATION,
        "op13_filter_audit": oracles.FILTER_AUDIT,
    }
