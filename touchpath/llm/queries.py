"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm import (alignment, collocations, decontamination, html_extraction, mixing, pii, quality_rules, secret_scan, simhash_dedup,
                           substring_dedup, token_counts, toxicity, url_filter)
from touchpath.llm.common import stage

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 1_024
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"), pii.fit(pii.labelled_table(spark)), keep=["doc_id"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url: the longest fitting rule's, else the trained model's."""
    model = url_filter.train(url_filter.seed_table(spark))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, model, keep=["page_id"])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics and verdict of every document, with cutoffs certified on the labelled ones."""
    measured = stage(quality_rules.with_measures(table(spark, sf_dir, "documents"), keep=["doc_id", "lang"]), "measures")
    cutoffs = quality_rules.select_cutoffs(measured, table(spark, sf_dir, "labels"))
    return measured.select("doc_id", *quality_rules.COUNTS, "base_failed", quality_rules.kept(cutoffs).alias("kept"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.hex_digits(found.fp).alias("fingerprint"), "component_id")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, verbatim or with other numbers and names, and which."""
    found = decontamination.with_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.where("size(item_ids) > 0")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a repeated 20-word window covers, and a digest of the others."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from its prefix store."""
    import public_tokenizers

    counted = token_counts.token_prefixes(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (counted.n_tokens > TOKEN_LIMIT).alias("over_limit"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_texts(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two and three words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens by two tokenizers, and how common the links are."""
    import public_tokenizers

    return alignment.align_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_pii, op2_url_filter, op3_quality_rules, op4_mixing, op5_simhash_dedup, op6_html_extraction, op7_decontamination, op8_secret_scan,
        op9_substring_dedup, op10_token_counts, op11_toxicity, op12_collocations, op13_token_alignment)}
