"""Mixing sources to target weights with hash-threshold histograms.

Every document has a hash; a source takes whole copies of all its documents plus
one more of those whose hash lies below the source's threshold. Thresholds come
from histograms: tokens are summed by source and leading hash digits, the bucket in
which the wanted sum is crossed is found by a running sum over its 256 buckets, and
only the documents of that one bucket are summed again by the next digits. Nothing
is sorted and no Python runs on executors. As the hash decides alone, smaller
budgets take subsets of larger ones (nested budgets), and reruns agree.

Defined cases: a null text has size 0; null is a source of its own, ordered last;
documents with one id share a hash and are taken together; a source without words
has target 0; if no document has a word all targets are 0; an empty table gives an
empty table; columns of other names stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codequarry.session import materialise

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
DIGITS = 15  # hex digits of the hash: 60 bits
LEVEL_DIGITS = 2
WORD_BREAK = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text, counted by its gaps: null has none."""
    pieces = F.size(F.split(F.concat(F.lit("x "), F.coalesce(text, F.lit("")), F.lit(" x")), WORD_BREAK))
    return (pieces - 2).cast("long")


def doc_hash(doc_id: Column) -> Column:
    """Fifteen hex digits that both this job and plain SQL can make from the id."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, DIGITS)


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds the 0-based rank of each source, code-point order, null last.

    Ranges are sorted apart and offset by the counts of the ranges before them, so
    any number of sources is ranked without a sort in one task.
    """
    ranged = sources.withColumn("is_null", F.col("source").isNull()).repartitionByRange("is_null", "source")
    placed = materialise(ranged.withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = placed.groupBy("part").agg(F.count("*").alias("in_part"))
    # One row for each range: a few hundred.
    before = counts.withColumn("ahead", F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).drop("in_part")
    inside = placed.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("is_null", "source")) - 1)
    return inside.join(before, "part").select(
        "source", "source_size", (F.col("at") + F.col("ahead")).cast("long").alias("rank"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, budget: float = 1.0) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    ``budget`` (a share of all words, up to ``max_copies``) is shared by weight; a
    share above its cap stops there and the excess is shared among the rest again.
    Each round is two aggregates of the small table, and at least one source leaves.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ranked = materialise(_ranked(summed).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("rank") % len(weights) + 1).cast("int")),
    ).withColumn("cap", (F.col("source_size") * max_copies).cast("double")), "mix-ranked")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * float(budget)
    level, stopped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        fixed, count, rest = ranked.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
            F.sum(over.cast("long")), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
        ).first()
        if count is None or count == stopped or not rest:
            break
        stopped, level = count, (total - fixed) / rest
    share = F.lit(0.0) if level is None else F.least(F.col("cap"), F.col("weight") * F.lit(float(level)))
    return materialise(ranked.select("source", "source_size", share.alias("target")), "mix-targets")


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, copies, prefix, low): the thresholds of each source.

    ``sized`` has (source, size, hash). A document gets one more copy than ``copies``
    when its hash is below ``prefix``. Sums below the prefix come near the rest of
    the target: the last bucket, one hash wide, is taken if that comes nearer.
    """
    state = wanted.select(
        "source",
        F.when(F.col("source_size") > 0,
               F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_COPIES))).otherwise(0)
        .cast("int").alias("copies"), "source_size", "target",
    ).select(
        "source", "copies",
        F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size")).alias("rest"),
        F.lit("").alias("prefix"), F.lit(0).cast("long").alias("low"),
    )
    inside = sized.filter("size > 0")
    for at in range(0, DIGITS, LEVEL_DIGITS):
        last = at + LEVEL_DIGITS >= DIGITS
        near = state.select(F.col("source").alias("s"), "prefix", "rest", "low")
        # Only documents of the boundary bucket are summed again.
        held = inside.join(near, F.col("source").eqNullSafe(F.col("s")) & F.col("hash").startswith(F.col("prefix")))
        summed = held.groupBy("source", F.substring("hash", 1, at + LEVEL_DIGITS).alias("digits")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("low").alias("low"))
        running = summed.withColumn(
            "upto", F.col("low") + F.sum("size").over(Window.partitionBy("source").orderBy("digits")))
        # The first bucket that goes beyond the rest; without one everything is taken.
        crossed = running.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(
            F.min(F.struct("digits", "upto", "size", "n")).alias("b"))
        joined = state.join(crossed.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        state = materialise(joined.select(
            "source", "copies", "rest",
            F.coalesce("b.digits", F.concat("prefix", F.lit("g"))).alias("prefix"),
            F.coalesce(F.col("b.upto") - F.col("b.size"), F.col("low")).alias("low"),
            F.coalesce("b.size", F.lit(0)).alias("size"), F.coalesce("b.n", F.lit(0)).alias("n"),
        ), "mix-state")
        most = state.agg(F.max("n")).first()[0] or 0
        if last or most <= 1:
            break
        state = state.drop("size", "n")
    # Take the boundary bucket too when that comes nearer to the target.
    nearer = (F.col("low") + F.col("size") - F.col("rest")) < (F.col("rest") - F.col("low"))
    return state.select("source", "copies", F.when(
        (F.col("size") > 0) & nearer, F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix")).alias("prefix"))


def _plan(sized: DataFrame, weights, budget: float) -> DataFrame:
    """(s, source_size, target, copies, prefix) for each source: a small table."""
    wanted = targets(sized.select("source", "size"), weights, MAX_COPIES, budget)
    cut = thresholds(sized, wanted)
    plan = wanted.withColumnRenamed("source", "s").join(
        cut, F.col("source").eqNullSafe(F.col("s"))).select("s", "source_size", "target", "copies", "prefix")
    # Written, its size is known: Spark sends it to the documents where it is small.
    return materialise(plan, "mix-plan")


def _sized(docs: DataFrame, text: str, doc_id: str, source: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        n_words(F.col(f"`{text}`")).alias("size"), doc_hash(F.col(f"`{doc_id}`")).alias("hash"))


def _copies() -> Column:
    return F.least(F.col("copies") + (F.col("hash") < F.col("prefix")).cast("int"), F.lit(MAX_COPIES)).cast("long")


def mix(
    docs: DataFrame, weights=WEIGHTS, budget: float = 1.0, text: str = "text", doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each document."""
    sized = materialise(_sized(docs, text, doc_id, source), "mix-sizes")
    joined = sized.join(_plan(sized, weights, budget), F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("copies", _copies()).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def take(
    docs: DataFrame, weights=WEIGHTS, budget: float = 1.0, text: str = "text", doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """The documents that the mix takes, with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Input columns of these names are replaced.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    plan = _plan(materialise(_sized(docs, text, doc_id, source), "mix-sizes"), weights, budget)
    shaped = docs.select(
        F.struct(*kept).alias("row"), F.col(f"`{source}`").cast("string").alias("source"),
        n_words(F.col(f"`{text}`")).alias("size"), doc_hash(F.col(f"`{doc_id}`")).alias("hash"))
    joined = shaped.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies())
    return joined.filter("copies > 0").select(
        "row.*", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
