"""Registered queries of the corpus operators."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.llm import sql
from assayline.llm.common import table
from assayline.llm.exact_dedup import exact_dedup
from assayline.llm.lattice_lm import score_documents
from assayline.llm.line_dedup import line_dedup
from assayline.llm.mixing import mix
from assayline.llm.near_dedup import near_dedup
from assayline.llm.packing import pack
from assayline.llm.quality_rules import quality_rules
from assayline.llm.secret_scan import BASE, scan_secrets, span_text
from assayline.llm.site_quality import site_quality
from assayline.llm.token_links import link_tokens
from assayline.llm.toxicity import toxicity
from assayline.llm.url_filter import filter_urls
from assayline.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), "kept"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; listed are the addresses that were fetched with a tracking
    parameter, so every spelling of such a page is blocked."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(F.col("url").rlike(r"[?&](utm_[a-z]+|ref)="))
    return filter_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op5_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False).drop("ids")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE]))

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    counts = [number(r.kind).alias(f"n_{r.kind}") for r in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "held_out", "score", "predicted",
        F.transform("spans", lambda s: F.struct(s["start"], s["end"])).alias("spans"),
    )


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures, _ = link_tokens(table(spark, sf_dir, "documents"))
    return measures


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_url_filter, op3_quality_rules, op4_source_mixing,
        op5_lexical_packing, op6_exact_dedup, op7_secret_scan, op8_lattice_lm, op9_toxicity,
        op10_site_quality, op11_line_dedup, op12_token_links,
        op13_embedding_whitening,
    )
}
ORACLES: dict[str, str] = {
    "op2_url_filter": sql.URL_FILTER,
    "op3_quality_rules": sql.QUALITY_RULES,
    "op4_source_mixing": sql.SOURCE_MIXING,
    "op6_exact_dedup": sql.EXACT_DEDUP,
    "op11_line_dedup": sql.LINE_DEDUP,
}
