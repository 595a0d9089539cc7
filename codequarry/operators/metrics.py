"""Counters, bounded samples, request rollups and request rates."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codequarry import fixed_values as V
from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.relational import top_n


def counters(samples: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    return samples.groupBy(metric).agg(F.sum(value).alias("total"))


def sample_size(n: Column) -> Column:
    """Values held after ``n`` observations: at one over full the newest are kept."""
    over = n - (V.SAMPLE_FULL + 1)
    return F.when(n <= V.SAMPLE_FULL, n).otherwise(
        F.lit(V.SAMPLE_KEPT) + F.pmod(over, F.lit(V.SAMPLE_FULL + 1 - V.SAMPLE_KEPT))
    )


def bounded_sample(
    samples: DataFrame, metric: str = "metric", newest: tuple[str, ...] = ("ts", "id")
) -> DataFrame:
    """The newest values of each metric that its bounded sample holds."""
    sizes = samples.groupBy(metric).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.desc(c) for c in newest]
    candidates = top_n(samples, [metric], order, V.SAMPLE_FULL, "_rn")
    kept = candidates.join(sizes, metric)
    return kept.filter(F.col("_rn") <= sample_size(F.col("_n"))).drop("_rn", "_n")


def summary(sample: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    return sample.groupBy(metric).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(value), 2).alias("avg_ms"),
        F.round(F.max(value), 2).alias("max_ms"),
    )


def request_rows(requests: DataFrame) -> DataFrame:
    """Log rows: method, path, status, rounded duration, client."""
    return requests.select(
        "method", "path", "status", F.round("duration_ms", 2).alias("duration_ms"),
        F.coalesce("client", F.lit("unknown")).alias("client"), "ts",
    )


def request_rollup(
    requests: DataFrame, by: tuple[str, ...] = ("path", "status"), ts: str = "ts",
    value: str = "duration_ms", window: str = "1 hour",
) -> DataFrame:
    """Requests, mean, maximum and 95th percentile per window."""
    return (
        requests.groupBy(F.window(ts, window).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.avg(value).alias("avg_ms"),
            F.max(value).alias("max_ms"),
            F.approx_percentile(value, 0.95).alias("p95_ms"),
        )
        .select(F.col("w.start").alias("window_start"), *by, "requests", "avg_ms", "max_ms", "p95_ms")
    )


# ------------------------------------------------------------------ request rates


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _moments(requests: DataFrame, client: str, ts: str, count: str | None = None) -> DataFrame:
    """Requests of a client at one instant, counted before any shuffle."""
    return requests.groupBy(F.col(client).alias("client"), _micros(ts).alias("t")).agg(
        (F.sum(count) if count else F.count(F.lit(1))).alias("n")
    )


def _with_recent(moments: DataFrame, span: int) -> DataFrame:
    """Add ``recent``: requests of the client in (t - span, t].

    Time is cut into buckets four spans wide, each also given the last span of
    the bucket before it, so a busy client is spread over its buckets. Inside a
    bucket a request counts up when it comes and down when it leaves the
    window: one running sum, however many requests a window holds.
    """
    width = 4 * span
    bucket = F.floor(F.col("t") / width)
    tail = F.floor((F.col("t") + (span - 1)) / width)
    placed = moments.withColumn("bucket", F.explode(F.array_distinct(F.array(bucket, tail))))
    own = F.col("bucket") == bucket
    comes = F.struct(F.col("t").alias("at"), F.lit(1).alias("turn"), F.col("n").alias("d"))
    goes = F.struct((F.col("t") + span).alias("at"), F.lit(0).alias("turn"), (-F.col("n")).alias("d"))
    moves = placed.select("client", "bucket", "t", "n", own.alias("own"), F.inline(F.array(comes, goes)))
    # What leaves at an instant is gone before what comes at it is counted.
    so_far = Window.partitionBy("client", "bucket").orderBy("at", "turn").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        moves.withColumn("recent", F.sum("d").over(so_far))
        .filter(F.col("own") & (F.col("turn") == 1))
        .select("client", "bucket", "t", "n", "recent")
    )


def recent_requests(
    requests: DataFrame, client: str = "client", ts: str = "ts",
    seconds: int = DEFAULT_LIMITS.window_seconds,
) -> DataFrame:
    """Per client and instant: requests then, and in the window that ends there."""
    counted = _with_recent(_moments(requests, client, ts), seconds * 1_000_000)
    return counted.select("client", "t", F.col("n").alias("requests"), "recent")


def _carry(marked: DataFrame, column: str, back: bool) -> DataFrame:
    """(client, bucket, value): the nearest value of ``column`` in the buckets before, or behind, a client's."""
    per_bucket = marked.groupBy("client", "bucket").agg((F.min if back else F.max)(column).alias("_value"))
    order = Window.partitionBy("client").orderBy("bucket")
    if back:
        found = F.first("_value", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    else:
        found = F.last("_value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return per_bucket.select("client", "bucket", found.alias(f"_carried{column}_{'next' if back else 'last'}"))


def _with_chain(counted: DataFrame, limit: int, span: int) -> DataFrame:
    """Add ``chain``, null where all requests of an instant are admitted whatever came before.

    An instant with at most ``limit`` requests in its raw window is admitted whole, as
    what is admitted is never more than what came. Only instants over it depend on the
    state, and they do so only through one another while less than a window apart:
    such a chain is replayed from the window before it, in which everything is known.
    Where a client stays within the limit for a window, its chains part.
    """
    inside = Window.partitionBy("client", "bucket").orderBy("t")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = counted.withColumn("_over", F.when(F.col("recent") > limit, F.col("t")))
    near = marked.withColumn(
        "_before", F.last("_over", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    ).withColumn("_after", F.first("_over", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing)))
    near = near.join(_carry(marked, "_over", False), ["client", "bucket"]).join(
        _carry(marked, "_over", True), ["client", "bucket"])
    before = F.coalesce("_before", "_carried_over_last")
    after = F.coalesce("_after", "_carried_over_next")
    near = near.select("client", "bucket", "t", "n", "_over", before.alias("_before"), after.alias("_after"))
    apart = F.col("_before").isNull() | (F.col("_after") - F.col("_before") >= span)
    starts = near.withColumn("_start", F.when(F.col("_over").isNotNull() & apart, F.col("t")))
    joined = starts.withColumn("_own", F.last("_start", ignorenulls=True).over(upto)).join(
        _carry(starts, "_start", False), ["client", "bucket"])
    running = F.coalesce("_own", "_carried_start_last")
    chain = (
        F.when(F.col("_over").isNotNull(), running)
        .when(F.col("_after") - F.col("t") < span, F.when(apart, F.col("_after")).otherwise(running))
    )
    return joined.select("client", "t", "n", chain.alias("chain"))


def admit(kept: deque, t: int, n: int, limit: int, span: int) -> int:
    """How many of ``n`` requests at ``t`` are admitted; ``kept`` holds earlier ones."""
    while kept and kept[0] <= t - span:
        kept.popleft()
    room = min(n, max(limit - len(kept), 0))
    kept.extend([t] * room)
    return room


def _replay(limit: int, span: int, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, kept = None, deque()
        for batch in batches:
            clients, chains, times, counts = (c.to_pylist() for c in batch.columns)
            admitted = []
            for client, chain, t, n in zip(clients, chains, times, counts):
                if (client, chain) != current:
                    current, kept = (client, chain), deque()
                admitted.append(admit(kept, t, n, limit, span))
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(admitted, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return run


def admitted_requests(
    requests: DataFrame, client: str = "client", ts: str = "ts",
    limit: int = DEFAULT_LIMITS.requests_per_window,
    seconds: int = DEFAULT_LIMITS.window_seconds, count: str | None = None,
) -> DataFrame:
    """Per client and instant: requests, and how many of them are admitted.

    A row is one request, or as many as its column ``count`` says.

    A request is admitted while fewer than ``limit`` admitted ones lie in the
    window before it; rejected ones leave no trace. Most instants are settled by the
    raw counts alone; the chains of those that are not are spread over tasks, and read
    through in time order with at most ``limit`` times in memory.
    """
    span = seconds * 1_000_000
    chained = _with_chain(_with_recent(_moments(requests, client, ts, count), span), limit, span)
    settled = chained.filter(F.col("chain").isNull()).select(
        "client", "t", F.col("n").alias("requests"), F.col("n").alias("admitted"))
    ordered = (
        chained.filter(F.col("chain").isNotNull()).select("client", "chain", "t", "n")
        .repartition("client", "chain")
        .sortWithinPartitions("client", "chain", "t")
    )
    schema = T.StructType([
        T.StructField("client", requests.schema[client].dataType),
        T.StructField("t", T.LongType()),
        T.StructField("requests", T.LongType()),
        T.StructField("admitted", T.LongType()),
    ])
    return settled.unionByName(ordered.mapInArrow(_replay(limit, span, to_arrow_schema(schema)), schema))


def admission_flags(
    requests: DataFrame, request_id: str, client: str = "client", ts: str = "ts", **rule
) -> DataFrame:
    """Requests with ``admitted``; those of one instant go by ``request_id``."""
    counts = admitted_requests(requests, client, ts, **rule).select(
        F.col("client").alias(client), F.col("t").alias("_t"), F.col("admitted").alias("_room")
    )
    instant = Window.partitionBy(client, "_t").orderBy(request_id)
    placed = requests.withColumn("_t", _micros(ts)).withColumn(
        "_rn", F.row_number().over(instant)
    )
    joined = placed.join(counts, [client, "_t"])
    return joined.withColumn("admitted", F.col("_rn") <= F.col("_room")).drop("_t", "_rn", "_room")
