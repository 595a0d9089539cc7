"""Counters, samples, rollups and request rates over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.operators import metrics
from registry.common import table

DAY = 24 * 3600


def _events(spark, d):
    return table(spark, d, "events")


def metric_counters(spark, d):
    whole = _events(spark, d).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return metrics.counters(whole, "event_type", "cents")


def metric_sample(spark, d):
    return metrics.bounded_sample(_events(spark, d), "event_type", ("ts", "event_id")).select(
        "event_type", "event_id", "value"
    )


_SAMPLE = """
WITH sizes AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events),
sample AS (SELECT event_type, event_id, value FROM ranked JOIN sizes USING (event_type)
  WHERE rn <= CASE WHEN n <= 1000 THEN n ELSE 500 + (n - 1001) % 501 END)
"""


def metric_summary(spark, d):
    return metrics.summary(_events(spark, d), "event_type", "value")


def metric_sample_summary(spark, d):
    """The same over the bounded sample of the newest values."""
    sample = metrics.bounded_sample(_events(spark, d), "event_type", ("ts", "event_id"))
    return metrics.summary(sample, "event_type", "value")


def request_rows(spark, d):
    logged = _events(spark, d).select(
        F.lit("GET").alias("method"), F.col("event_type").alias("path"), F.lit(200).alias("status"),
        (F.col("value") / 7).alias("duration_ms"), F.col("user_id").cast("string").alias("client"), "ts",
        "event_id",
    )
    rows = metrics.request_rows(logged)
    return rows.withColumn("duration_ms", F.round("duration_ms", 2)).drop("ts")


def request_rollup(spark, d):
    rolled = metrics.request_rollup(_events(spark, d), ("event_type",), "ts", "value")
    return rolled.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "requests",
        F.round("avg_ms", 6).alias("avg_ms"), "max_ms",
    )


def rate_recent(spark, d):
    """Requests of a user within the minute, and within the day, before each request."""
    events = _events(spark, d)
    minute = metrics.recent_requests(events, "user_id").withColumnRenamed("recent", "in_minute")
    day = metrics.recent_requests(events, "user_id", seconds=DAY).select(
        "client", "t", F.col("recent").alias("in_day")
    )
    return minute.join(day, ["client", "t"])


RECENT_SQL = """
SELECT DISTINCT user_id AS client, epoch_us(ts) AS t,
  count(*) OVER (PARTITION BY user_id, ts) AS requests,
  count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW)
    AS in_minute,
  count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
    RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS in_day
FROM events
"""


def rate_admitted(spark, d):
    flags = metrics.admission_flags(
        _events(spark, d), "event_id", "user_id", limit=2, seconds=DAY
    )
    return flags.select("event_id", "user_id", "admitted")


ADMITTED_SQL = """
WITH RECURSIVE ordered AS (
  SELECT user_id, event_id, epoch_us(ts) AS t,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk AS (
  SELECT user_id, event_id, i, [t] AS kept, TRUE AS admitted FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.user_id, o.event_id, o.i,
    CASE WHEN len(list_filter(w.kept, lambda x: x > o.t - 86400000000)) < 2
      THEN list_append(list_filter(w.kept, lambda x: x > o.t - 86400000000), o.t)
      ELSE list_filter(w.kept, lambda x: x > o.t - 86400000000) END,
    len(list_filter(w.kept, lambda x: x > o.t - 86400000000)) < 2
  FROM walk w JOIN ordered o ON o.user_id = w.user_id AND o.i = w.i + 1)
SELECT event_id, user_id, admitted FROM walk
"""

QUERIES = {
    "metric_counters": (
        metric_counters,
        "SELECT event_type, sum(round(value * 100)::BIGINT)::BIGINT AS total FROM events GROUP BY 1",
    ),
    "metric_sample": (metric_sample, _SAMPLE + "SELECT * FROM sample"),
    "metric_summary": (
        metric_summary,
        """SELECT event_type, count(*) AS count, round(avg(value), 2) AS avg_ms,
        round(max(value), 2) AS max_ms FROM events GROUP BY 1""",
    ),
    "metric_sample_summary": (
        metric_sample_summary,
        _SAMPLE + """SELECT event_type, count(*) AS count, round(avg(value), 2) AS avg_ms,
        round(max(value), 2) AS max_ms FROM sample GROUP BY 1""",
    ),
    "request_rows": (
        request_rows,
        """SELECT 'GET' AS method, event_type AS path, 200 AS status, round(value / 7, 2) AS duration_ms,
        user_id::VARCHAR AS client FROM events""",
    ),
    "request_rollup": (
        request_rollup,
        """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, event_type,
        count(*) AS requests, round(avg(value), 6) AS avg_ms, max(value) AS max_ms FROM events GROUP BY 1, 2""",
    ),
    "rate_recent": (rate_recent, RECENT_SQL),
    "rate_admitted": (rate_admitted, ADMITTED_SQL),
}
