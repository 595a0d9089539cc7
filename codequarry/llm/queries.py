"""Registered queries of this subpackage: name → (callable(spark, sf_dir), SQL or None)."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.llm import decontaminate, importance, katz, licences, lines, mixing, nearjoin, nearvectors, passages, rules, secrets, tokens, trie
from codequarry.llm import oracles as SQL
from codequarry.llm import oracles_later as LATER


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of each text: at its quarters five characters give way to the source's name."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("source", F.lit("")).alias("source"))
    size = F.char_length(F.coalesce("text", F.lit("")))
    edits = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.struct(
        F.floor(size * k / 4).alias("start"), F.least(F.floor(size * k / 4) + 5, F.floor(size * (k + 1) / 4)).alias("end"),
        F.col("source").alias("put")))
    edited = tokens.apply_edits(tokens.build(docs.withColumn("edits", edits)))
    return edited.select(
        "doc_id", F.col("tokens.n_tokens").alias("tokens_before"), F.col("edited.n_tokens").alias("tokens_after"),
        F.col("edited.n_pretokens").alias("pretokens"), F.col("edited.n_encoded").alias("encoded_again"),
        F.sha2(F.col("edited.text").cast("binary"), 256).alias("text_sha256"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", F.round("leak.score", 6).alias("score"), "leak.first_word", "leak.last_word")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.sha2(F.col("secrets.base_text").cast("binary"), 256).alias("base_sha256"),
        F.col("secrets.spans_text").alias("spans"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = passages.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"licence.{c}" for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join("licence.base_labels", ",").alias("base_labels"), F.array_join("licence.labels", ",").alias("labels"),
        "licence.score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return done.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.join(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(_table(spark, sf_dir, "conversations")).drop("a", "b")


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvectors.join(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    # Tested against a plain model and its sums to one; the base score against SQL in tests.
    "op1_katz_scores": (op1_katz_scores, None),
    # Tested against encoding the edited texts as a whole.
    "op2_token_counts": (op2_token_counts, None),
    "op3_source_mix": (op3_source_mix, SQL.SOURCE_MIX),
    "op4_quality_rules": (op4_quality_rules, SQL.QUALITY_RULES),
    # Tested against full alignment tables.
    "op5_decontamination": (op5_decontamination, None),
    "op6_secret_scan": (op6_secret_scan, SQL.SECRET_SCAN),
    "op7_substring_dedup": (op7_substring_dedup, SQL.SUBSTRING_DEDUP),
    # Bounded-error matching has no SQL: tested against edit distances.
    "op8_licence_scan": (op8_licence_scan, None),
    "op9_line_dedup": (op9_line_dedup, SQL.LINE_DEDUP),
    # Tested against all pairs.
    "op10_ngram_join": (op10_ngram_join, None),
    "op11_importance_resample": (op11_importance_resample, LATER.IMPORTANCE),
    "op12_conversation_trie": (op12_conversation_trie, LATER.PREFIX_TRIE),
    "op13_near_vectors": (op13_near_vectors, LATER.NEAR_VECTORS),
}
