"""The corpus pipeline: five stages, each over all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``; the last adds what the mix decided.

Defined cases are those of the operators: a null or empty text fails the quality
rules; repeated rows are judged alike, and one of them stays after the join; an empty
table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.llm import decontaminate, lines, mixing, nearjoin, rules
from codequarry.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the table of thresholds go."""
    return rules.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go; ``n_chars`` follows the text."""
    done = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(
            F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return nearjoin.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies."""
    return mixing.take(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# Alignment scores of edited passages have no SQL: tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
