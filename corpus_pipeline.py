"""Training corpus from ``documents``: stages that each keep the columns of the table they are given.

Every stage works on all rows the stage before kept; ``run`` writes each result as Parquet in the
shared folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportstar.llm import decontaminate, linededup, mixing, quality, simhash
from reportstar.staging import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, takes for good; null and empty texts are scored like any other."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of repeated runs of lines; ``n_chars`` follows the text. Null texts stay null."""
    kept = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share four fifths of their five-word shingles."""
    return simhash.keep_one(docs, words=5, likeness=0.8)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``; without passages all stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources have their target weights, in a shuffled order."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unrepeated_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mix", target_mix),
]

#: The trained scores and the md5-seeded mix of survivors are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
