"""Requests, metric samples and entities as streams."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.metrics import admit


def metric_windows(
    samples: DataFrame, metric: str = "metric", value: str = "value", ts: str = "ts",
    window: str = "1 hour", delay: str = "10 minutes",
) -> DataFrame:
    """Count, mean and maximum of each metric per window, once the window is closed."""
    timed = samples.withWatermark(ts, delay)
    rolled = timed.groupBy(F.window(ts, window).alias("w"), metric).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg(value), 2).alias("avg_ms"),
        F.round(F.max(value), 2).alias("max_ms"),
    )
    return rolled.select(F.col("w.start").alias("window_start"), metric, "count", "avg_ms", "max_ms")


def first_seen(
    rows: DataFrame, keys: list[str], ts: str = "ts", delay: str | None = None
) -> DataFrame:
    """First arrival of each key, however the input is cut into triggers.

    Every key stays in the state, a row each. With ``delay`` a key is forgotten once
    the watermark has passed it by that much, and may then be seen anew.
    """
    if delay is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def admitted_requests(
    requests: DataFrame, client: str = "client", ts: str = "ts",
    limit: int = DEFAULT_LIMITS.requests_per_window,
    seconds: int = DEFAULT_LIMITS.window_seconds, delay: str = "10 minutes",
) -> DataFrame:
    """Admission per client and instant; state is at most ``limit`` times a client.

    The requests of one trigger are taken in time order; those later than the
    watermark are dropped. Idle clients leave the state after the window.
    """
    span = seconds * 1_000_000
    kind = requests.schema[client].dataType.simpleString()
    timed = requests.select(
        F.col(client).alias("client"), F.col(ts).alias("ts"), F.unix_micros(ts).alias("t")
    ).withWatermark("ts", delay)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        moments = pd.concat([batch["t"] for batch in batches]).value_counts().sort_index()
        kept = deque(state.get[0]) if state.exists else deque()
        pairs = list(zip(moments.index.tolist(), moments.tolist()))
        admitted = [admit(kept, t, n, limit, span) for t, n in pairs]
        state.update((list(kept),))
        idle = (pairs[-1][0] + span) // 1000 + 1
        state.setTimeoutTimestamp(max(idle, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({
            "client": [key[0]] * len(pairs), "t": moments.index, "requests": moments.to_numpy(),
            "admitted": admitted,
        })

    return timed.groupBy("client").applyInPandasWithState(
        step,
        f"client {kind}, t bigint, requests bigint, admitted bigint",
        "kept array<bigint>",
        "append",
        "EventTimeTimeout",
    )
