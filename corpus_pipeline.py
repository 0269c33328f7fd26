"""From raw documents to a weighted training set: identified, without near copies, test items and secrets, mixed to target weights.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. What it returns is written as Parquet and read
again as the next one's documents. All but the last keep the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subtlake.llm import decontaminate, jaccard, language, mixing, secrets, simhash
from subtlake.session import scratch_path, stored


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by text, declared language and source; the others go."""
    return language.keep_identified(docs, declared=F.col("lang"), host=F.col("source"))


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of up to four differing bits, then, of what is left, five-word
    shingles of similarity 0.8 or more."""
    return jaccard.drop_similar(stored(simhash.drop_near_copies(docs), "pipeline-fingerprints"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secrets.redact_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target mix uses, with their rate and number of uses."""
    return mixing.apply_mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [("language_id", identified), ("near_copies", single), ("decontamination", uncontaminated), ("secrets", redacted), ("mixing", mixed)]

#: Several stages are fits or iterations, which SQL can not express; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
