"""Quantiles of durations from sketches that are stored by window and merged over any span.

A window's row holds the number of samples, their sum, the largest, and a KLL sketch of
them: some kilobytes however many there were. Rows of one window may be many, of
different batches or of samples that came late; they are added up when read, so nothing
is rewritten and no sample is too late. A quantile's true rank is off by at most
``rank_error`` with 99 percent confidence, in one sketch as in a merged one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Larger is finer and wider; see ``rank_error``.
PRECISION = 400


def rank_error(precision: int = PRECISION) -> float:
    """How far the rank of a quantile may be off, as a share of all samples (99 percent confidence)."""
    return 2.296 / precision ** 0.9021


def sketched(
    samples: DataFrame, by: Sequence[str] = ("path",), ts: str = "ts", value: str = "duration_ms", window: str = "1 hour",
    precision: int = PRECISION,
) -> DataFrame:
    """``window_start, *by, requests, total, longest, sketch``: a row for each window and key that has samples."""
    known = samples.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = known.groupBy(F.window(ts, window).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(F.col(value).cast("double")).alias("total"),
        F.max(F.col(value).cast("double")).alias("longest"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(precision)).alias("sketch"))
    return rows.select(F.col("w.start").alias("window_start"), *by, "requests", "total", "longest", "sketch")


def merged(rows: DataFrame, by: Sequence[str | Column], precision: int = PRECISION) -> DataFrame:
    """Rows of ``sketched`` added up by other keys, for instance by day."""
    return rows.groupBy(*by).agg(
        F.sum("requests").alias("requests"), F.sum("total").alias("total"), F.max("longest").alias("longest"),
        F.kll_merge_agg_double("sketch", F.lit(precision)).alias("sketch"))


def quantiles(rows: DataFrame, shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """``sketch`` and ``total`` as mean and quantiles: ``avg_ms, max_ms, p50, p95, p99``."""
    found = rows
    for share in shares:
        found = found.withColumn(f"p{round(share * 100)}", F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return found.withColumn("avg_ms", F.col("total") / F.col("requests")).withColumnRenamed("longest", "max_ms").drop("sketch", "total")


class SketchStore:
    """Rows of ``sketched`` by batch, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str] = ("path",), window: str = "1 hour", precision: int = PRECISION):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)
        self.window, self.precision = window, precision

    def add(self, samples: DataFrame, batch: int, ts: str = "ts", value: str = "duration_ms") -> None:
        """Samples of one batch; the same batch again replaces itself."""
        rows = sketched(samples, self.by, ts, value, self.window, self.precision)
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")

    def start(self, samples: DataFrame, checkpoint: str, ts: str = "ts", value: str = "duration_ms") -> StreamingQuery:
        """A stream of samples; late ones go to their window like any other."""
        writer = samples.writeStream.foreachBatch(lambda rows, number: self.add(rows, number, ts, value))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/batch=*")

    def windows(self) -> DataFrame:
        """One row for each window and key, over all batches."""
        return merged(self.rows(), ["window_start", *self.by], self.precision)

    def compact(self, into: str) -> SketchStore:
        fresh = SketchStore(self.spark, into, self.by, self.window, self.precision)
        self.windows().write.parquet(f"{fresh.path}/batch=0")
        return fresh
