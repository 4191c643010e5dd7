"""The queries of this subpackage with their production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, collocations, decontaminate, exact_dedup, jaccard_join, line_dedup, lm_score, mixing, packing, quality, suffix_dedup, token_counts, url_filters
from .base import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.spans(table(spark, sf_dir, "documents", "doc_id", "text")).drop("removed")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages", "page_id", "url"), url_filters.rules(spark))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "lang", "text"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_token_counts, op3_jaccard_join, op4_url_filters, op5_exact_dedup, op6_lm_score, op7_decontaminate, op8_mixing, op9_quality, op10_line_dedup, op11_packing, op12_alignment, op13_collocations)}
SQL = {"op4_url_filters": url_filters.SQL, "op5_exact_dedup": exact_dedup.SQL, "op8_mixing": mixing.SQL, "op10_line_dedup": line_dedup.SQL}
