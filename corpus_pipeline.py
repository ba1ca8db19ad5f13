"""From raw documents to a training mix: five stages, each a whole pass over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwright.llm import decontamination, line_dedup, minhash, mixing, toxicity
from cellwright.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It is fitted on the labelled ones of these."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, exactly or nearly, go; of each class the first stays."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return minhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a word window of a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets the rate at which it is to be drawn, so that languages have equal tokens."""
    return mixing.mix(docs, docs.select("text", F.col("lang").alias("domain")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("minhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing to target weights", mix_domains),
]

#: Trees, darts and projected gradients are not SQL: tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
