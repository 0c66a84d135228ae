"""Registered queries of this subpackage and, where SQL can express them, their oracles."""

from pyspark.sql import DataFrame, SparkSession

from lociweave.llm import (
    bpe,
    decontaminate,
    lm,
    maintext,
    quality,
    shards,
    simhash,
    spelling,
    tokencount,
    topk,
    toxicity,
    urlfilter,
    whitening,
)
from lociweave.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filtered_pages(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_table(table(spark, sf_dir, "documents"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_table(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extracted(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_token_counts": op3_token_counts,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_top_k": op6_top_k,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_lm": op10_lm,
    "op11_html_text": op11_html_text,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op2_url_filter": urlfilter.ORACLE,
    "op4_decontamination": decontaminate.ORACLE,
    "op5_sharding": shards.ORACLE,
    "op6_top_k": topk.ORACLE,
}
