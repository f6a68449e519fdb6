"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gustgrid.llm.centroids import centroid_digests, cluster_vectors
from gustgrid.llm.common import table
from gustgrid.llm.decontam import CONTAMINATED, contamination
from gustgrid.llm.html_tree import extract_main_text
from gustgrid.llm.license_diag import license_scan
from gustgrid.llm.mcd_rules import BASE, quality_rules
from gustgrid.llm.prefix_bpe import bpe_decode, bpe_encode
from gustgrid.llm.rff_quality import quality_scores
from gustgrid.llm.secret_crf import secret_scan
from gustgrid.llm.setsketch import near_duplicates
from gustgrid.llm.token_dac import read_documents, write_tokens
from gustgrid.llm.trie_variants import count_words, lowered_runs, slipped, spelling_variants
from gustgrid.llm.url_rules import judge_urls, mine_rules, url_parts
from gustgrid.llm.water_fill import mix
from gustgrid.session import stage_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_association_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls (:mod:`url_rules`). The first number of a page's path is the document it shows, so
    that document's labels are the page's: of low quality or toxic is blocked."""
    parts = url_parts(table(spark, sf_dir, "pages"))
    labels = table(spark, sf_dir, "labels").filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(
        F.expr("max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false))").alias("blocked"))
    numbered = parts.selectExpr("tokens", "try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') AS BIGINT) AS doc_id").filter("doc_id IS NOT NULL")
    return judge_urls(parts, mine_rules(numbered.join(labels, "doc_id").select("tokens", "blocked")))


def op2_crf_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by fixed patterns and a random field (:mod:`secret_crf`)."""
    return secret_scan(table(spark, sf_dir, "documents")).selectExpr("doc_id", "n_assign", "n_access", "n_hex", "sha2(base, 256) AS base_sha256", "spans")


def op3_aho_corasick_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a 13-word window of a benchmark item (:mod:`decontam`)."""
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), window=13)
    return found.selectExpr(
        "doc_id", "_n_words AS n_words", "_n_hit AS n_hit", "CAST(size(_items) AS BIGINT) AS n_items", "sha2(array_join(_items, ','), 256) AS items_sha256",
        f"{CONTAMINATED} AS contaminated")


def op4_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at Jaccard 0.8 over 2-word shingles (:mod:`setsketch`)."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, threshold=0.8)


def op5_tree_scored_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (:mod:`html_tree`)."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document (:mod:`license_diag`)."""
    return license_scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op7_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outliers by language and source (:mod:`mcd_rules`)."""
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept", "distance")


def op8_random_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores; a fifth of the ids never trains (:mod:`rff_quality`)."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op9_directly_addressable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as token files and reads them back (:mod:`token_dac`)."""
    out = stage_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), out, TOKENIZER)
    return read_documents(spark, out)


def op10_water_fill_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of sources weighing 1, 2, 3, at most three epochs (:mod:`water_fill`)."""
    return mix(table(spark, sf_dir, "documents"), max_epochs=3.0).selectExpr(
        "doc_id", "_size AS size", "_source_size AS source_size", "_target AS target", "_size * _copies AS taken")


def op11_trie_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of all words of seven letters or more (:mod:`trie_variants`)."""
    runs = lowered_runs(table(spark, sf_dir, "documents"), "doc_id", "text", "A-Za-z\\u00C0-\\u00FF", least=7)
    return spelling_variants(count_words(slipped(runs, every=31), least_length=7, least_count=2), ratio=10)


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to (:mod:`prefix_bpe`)."""
    ids = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER).select("doc_id", "ids")
    return bpe_decode(ids, TOKENIZER).selectExpr(
        "doc_id", "CAST(length(ids) div 4 AS BIGINT) AS n_tokens", "sha2(ids, 256) AS ids_sha256", "sha2(decoded, 256) AS decoded_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings after five rounds from forty seeded vectors (:mod:`centroids`)."""
    rows, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2, size=64, scale=256)
    digest = F.get(F.lit(centroid_digests(centroids) or [""]), F.col("cluster"))
    return rows.select("*", digest.alias("centroid_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_association_url_filter": op1_association_url_filter,
    "op2_crf_secret_scan": op2_crf_secret_scan,
    "op3_aho_corasick_decontamination": op3_aho_corasick_decontamination,
    "op4_setsketch_near_dedup": op4_setsketch_near_dedup,
    "op5_tree_scored_html": op5_tree_scored_html,
    "op6_diagonal_license_scan": op6_diagonal_license_scan,
    "op7_mcd_quality_rules": op7_mcd_quality_rules,
    "op8_random_fourier_quality": op8_random_fourier_quality,
    "op9_directly_addressable_tokens": op9_directly_addressable_tokens,
    "op10_water_fill_mix": op10_water_fill_mix,
    "op11_trie_spelling_variants": op11_trie_spelling_variants,
    "op12_prefix_bpe": op12_prefix_bpe,
    "op13_centroid_clusters": op13_centroid_clusters,
}
