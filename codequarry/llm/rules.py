"""Quality rules: a threshold table compiled into one projection.

``measure(docs)`` adds the measures of each whole text and ``judge(docs, rules)``
compiles a table of thresholds into Boolean expressions over them. Everything is
built-in column functions, one narrow stage: no shuffle, no Python.

Defined cases: a null text counts as empty (all measures 0); an empty document has
no words and fails the length rule; texts of any length are judged whole; repeated
rows are judged alike and all stay; an empty table gives an empty table; measures
go into one struct column, so columns of other names are never touched (an input
column named like the struct is replaced).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8

# Frequent words of four languages, lower case.
STOP_WORDS = tuple(dict.fromkeys((
    "the of and to a in is that it for on was with as be by this are at from an or not but which have "
    "de la le les et des en un une du que qui dans pour pas est sur au par avec ce il elle ne se plus "
    "der die das und den von zu mit ist im nicht ein eine auf für sich des dem es auch als er "
    "el los las y del con no para su lo al una por más como"
).split()))


class Rule(NamedTuple):
    """Keep a document when ``low <= measure <= high``; None leaves a side open."""

    measure: str
    low: float | None
    high: float | None


# What every document must meet, whatever the table says.
BASE_RULES = (
    Rule("n_words", 20, None),
    Rule("repeat_percent", None, 30),
)

DEFAULT_RULES = (
    Rule("mean_word_length", 2, 12),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_ratio", 0.01, None),
    Rule("duplicate_line_ratio", None, 0.5),
)


def measure(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` plus a struct of counts and ratios of each text.

    Windows of eight words are compared by 64-bit hashes within one text. A document
    without repeated windows, the usual case, is settled by a distinct count; only
    the others sort their windows, so the cost is n log n for any text.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    step = docs.select(F.struct(*kept).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    step = step.select(
        "row", "t",
        F.filter(F.split("t", WORD_BREAK), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    step = step.select(
        "row", "words", "lines",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
    )
    # Hashes of 2, 4 and 8 consecutive words, each from two of the level below.
    step = step.withColumn("h2", F.transform("h1", lambda x, i: F.xxhash64(x, F.get("h1", i + 1))))
    step = step.withColumn("h4", F.transform("h2", lambda x, i: F.xxhash64(x, F.get("h2", i + 2))))
    step = step.withColumn("starts", F.slice("h4", F.lit(1), F.greatest(F.lit(0), F.size("h4") - (REPEAT_WINDOW - 1))))
    step = step.withColumn("h8", F.transform("starts", lambda x, i: F.xxhash64(x, F.get("h4", i + 4))))
    step = step.withColumn(
        "sorted",
        F.when(F.size(F.array_distinct("h8")) < F.size("h8"),
               F.array_sort(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))),
    )
    step = step.withColumn(
        "again",
        F.array_sort(F.transform(
            F.filter("sorted", lambda e, j: (
                F.coalesce(F.get("sorted", j - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get("sorted", j + 1)["h"] == e["h"], F.lit(False))
            )), lambda e: e["at"],
        )),
    )
    step = step.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(
            F.transform("again", lambda p, j: F.least(
                F.lit(REPEAT_WINDOW), F.coalesce(F.get("again", j + 1) - p, F.lit(REPEAT_WINDOW)))),
            F.lit(0).cast("long"), lambda total, x: total + x,
        ), F.lit(0).cast("long")),
    )
    step = step.select(
        "row", "n_words", "word_chars", "n_symbols", "n_repeat_words",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        # Punctuation around a word does not hide a stop word.
        F.size(F.filter("words", lambda w: F.lower(F.regexp_replace(w, r"[.,;:!?]+$", "")).isin(*STOP_WORDS)))
        .cast("long").alias("n_stop_words"),
    )

    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return step.select("row.*", F.struct(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
        per("word_chars", "n_words").alias("mean_word_length"),
        per("n_symbols", "n_words").alias("symbols_per_word"),
        per("n_stop_words", "n_words").alias("stop_word_ratio"),
        per("n_dup_lines", "n_lines").alias("duplicate_line_ratio"),
        F.when(F.col("n_words") > 0, F.lit(100) * F.col("n_repeat_words") / F.col("n_words"))
        .otherwise(F.lit(0.0)).alias("repeat_percent"),
    ).alias(into))


def compiled(rules, measures: str = "quality") -> Column:
    """The table of thresholds as one Boolean expression: true when all rules hold."""
    holds = F.lit(True)
    for rule in rules:
        value = F.col(f"`{measures}`.`{rule.measure}`")
        if rule.low is not None:
            holds = holds & (value >= rule.low)
        if rule.high is not None:
            holds = holds & (value <= rule.high)
    return holds


def judge(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` plus the measures and the verdict (``base_failed``, ``kept``) in one struct."""
    measured = measure(docs, text, into)
    base = compiled(BASE_RULES, into)
    # A filter on the verdict would be moved below the measures and repeat them inside
    # each other; it is not moved past a value that differs from row to row.
    stays = F.monotonically_increasing_id() >= 0
    return measured.withColumn(into, F.struct(
        f"`{into}`.*", (~base).alias("base_failed"), (base & compiled(rules, into) & stays).alias("kept"),
    ))


def keep(docs: DataFrame, rules=DEFAULT_RULES, text: str = "text") -> DataFrame:
    """The documents that meet the base rules and the table, with their own columns."""
    return judge(docs, rules, text, "_verdict").filter("_verdict.kept").drop("_verdict")
