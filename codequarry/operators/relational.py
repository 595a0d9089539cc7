"""Keyed picks, pages and joins that hold when one key owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Over how many tasks the rows of one hot key are spread.
SPREAD = 256


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key by ``order``.

    Spark limits each map task to one row per key before the shuffle, so many
    copies of one key do not meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows of each key by ``order``, ranked from 1.

    Picked in two rounds: each of SPREAD shares of a key keeps its own first
    ``n``, and only those meet. A hot key never reaches one task whole.
    """
    share = df.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    part = Window.partitionBy(*keys, "_share").orderBy(*order)
    kept = share.withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= n)
    whole = Window.partitionBy(*keys).orderBy(*order)
    ranked = kept.drop("_share", "_rn").withColumn(rank, F.row_number().over(whole))
    return ranked.filter(F.col(rank) <= n)


def page_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int,
    offset: int = 0, rank: str = "pos",
) -> DataFrame:
    """Rows ``offset+1 … offset+limit`` of every key; ``rank`` counts inside the key."""
    ranked = top_n(df, keys, order, offset + limit, rank)
    return ranked if offset == 0 else ranked.filter(F.col(rank) > offset)


def page(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One page of one ordered set (a top-k per task, never a full sort)."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(limit)


def matching(left: DataFrame, right: DataFrame, on: Sequence[str], keep: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is in ``right`` (``keep``) or is not.

    Spark broadcasts the keys when it knows them to be few, and splits the tasks of
    hot keys of ``left`` otherwise (adaptive skew join).
    """
    return left.join(right.select(*on), list(on), "left_semi" if keep else "left_anti")


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of ``right`` (one narrow row per key) to ``left``; as above."""
    return left.join(right, list(on), how)


def latest(df: DataFrame, keys: Sequence[str], seq: str | Column) -> DataFrame:
    """Row of the highest ``seq`` per key, combined in each map task first."""
    others = [c for c in df.columns if c not in keys]
    order = F.col(seq) if isinstance(seq, str) else seq
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
