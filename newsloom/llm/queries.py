"""The queries of this subpackage: thin shapes of the operators' results over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm.class_lm import score_corpus
from newsloom.llm.decontaminate import contaminated, digest
from newsloom.llm.frames import table
from newsloom.llm.html_extraction import extract_pages
from newsloom.llm.jaccard_join import jaccard_join
from newsloom.llm.licenses import license_scan
from newsloom.llm.prefix_trie import prefix_trie
from newsloom.llm.quality_classifier import quality_classifier
from newsloom.llm.quality_rules import quality_rules
from newsloom.llm.sampling import round_trip
from newsloom.llm.spelling import spelling_variants
from newsloom.llm.sql import DECONTAMINATION, JACCARD_JOIN, PREFIX_TRIE, SPELLING_VARIANTS, SUBSTRING_DEDUP
from newsloom.llm.substring_dedup import substring_dedup
from newsloom.llm.syncmers import document_fingerprints
from newsloom.llm.token_counts import token_counts


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("k")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op7_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op10_quality_classifier": op10_quality_classifier,
    "op7_sentencepiece_sampling": op7_sentencepiece_sampling,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_counts": op9_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_license_scans": op5_license_scans,
    "op6_quality_rules": op6_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_document_fingerprints": op13_document_fingerprints,
}
# The others have no short SQL form: they hash, sample, learn or parse. The tests hold them against brute force.
SQL: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op3_ngram_jaccard_join": JACCARD_JOIN,
    "op4_benchmark_decontamination": DECONTAMINATION,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_prefix_trie": PREFIX_TRIE,
}
