"""Training-data pipeline: every stage works on what the one before it has kept."""

from pyspark.sql import DataFrame, SparkSession

from lociweave.llm import bpe, decontaminate, quality, simhash, toxicity
from lociweave.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; learned from the labelled documents of the input."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of good quality; learned from the labelled documents of the input."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that SimHash links, with the operator's own settings."""
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# Trained models, 64-bit fingerprints and merges are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage keeps is written, so the stages after it do not work it out again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
