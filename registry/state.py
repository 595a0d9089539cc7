"""Repository state, run logs, gates, pages and retention on orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry import schemas
from codequarry.operators import state
from codequarry.session import work_path
from codequarry.sources.ranked import RankedTable
from registry.common import table

NOW = "2000-06-30 00:00:00"


def _customers_as_repositories(spark, d):
    """Every customer, 50 numbers on, is a repository that was registered before."""
    old = table(spark, d, "customer").withColumn("c_custkey", F.col("c_custkey") + 50)
    when = F.to_timestamp(F.lit("1990-01-01 00:00:00"))
    values = {
        "id": F.col("c_custkey").cast("string"), "url": F.concat(F.lit("old/"), "c_name"),
        "name": F.col("c_name"), "local_path": F.lit("/old"), "default_branch": F.lit("dev"),
        "language": F.lit("python"), "status": F.lit("failed"), "error_message": F.col("c_mktsegment"),
        "file_count": F.col("c_nationkey"), "entity_count": F.lit(7),
        "structure_path": F.lit(None), "created_at": when, "updated_at": when,
    }
    return old.select(*[
        values[f.name].cast(f.dataType).alias(f.name) for f in schemas.REPOSITORIES
    ])


def upsert_repositories(spark, d):
    """Orders register their customer again and again."""
    arriving = table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.concat(F.lit("new/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.concat(F.lit("/new/"), F.col("o_orderkey").cast("string")).alias("local_path"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("branch"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )
    merged = state.upsert_repositories(_customers_as_repositories(spark, d), arriving)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return merged.withColumns({"created_at": day("created_at"), "updated_at": day("updated_at")})


UPSERT_SQL = """
WITH old AS (SELECT * REPLACE (c_custkey + 50 AS c_custkey) FROM customer),
news AS (SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first, arg_max(o_orderkey, o_orderkey) AS last,
  coalesce(nullif(arg_min(o_orderstatus, o_orderkey), 'F'), 'main') AS branch,
  arg_min(o_orderdate, o_orderkey) AS first_ts, arg_max(o_orderdate, o_orderkey) AS last_ts
  FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, o_custkey)::VARCHAR AS id,
  CASE WHEN c_custkey IS NULL THEN 'new/' || first ELSE 'old/' || c_name END AS url,
  CASE WHEN c_custkey IS NULL THEN 'order ' || first ELSE c_name END AS name,
  CASE WHEN o_custkey IS NULL THEN '/old' ELSE '/new/' || last END AS local_path,
  CASE WHEN c_custkey IS NULL THEN branch ELSE 'dev' END AS default_branch, 'python' AS language,
  CASE WHEN o_custkey IS NULL THEN 'failed' ELSE 'cloning' END AS status,
  CASE WHEN o_custkey IS NULL THEN c_mktsegment END AS error_message,
  CASE WHEN c_custkey IS NULL THEN 0 ELSE c_nationkey END AS file_count,
  CASE WHEN c_custkey IS NULL THEN 0 ELSE 7 END AS entity_count, NULL::VARCHAR AS structure_path,
  CASE WHEN c_custkey IS NULL THEN strftime(first_ts, '%Y-%m-%d') ELSE '1990-01-01' END AS created_at,
  CASE WHEN o_custkey IS NULL THEN '1990-01-01' ELSE strftime(last_ts, '%Y-%m-%d') END AS updated_at
FROM old FULL JOIN news ON c_custkey = o_custkey
"""


def finish_and_fail(spark, d):
    """Customers' counts are set from their orders; the poorest are marked failed."""
    stored = _customers_as_repositories(spark, d)
    totals = table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("repository_id")).agg(
        F.count(F.lit(1)).alias("files"), (F.count(F.lit(1)) * 2).alias("entities")
    )
    failures = table(spark, d, "customer").filter(F.col("c_acctbal") < -500).select(
        (F.col("c_custkey") + 50).cast("string").alias("id"), F.lit("no clone").alias("error")
    )
    now = F.to_timestamp(F.lit(NOW))
    done = state.mark_failed(state.finish_repositories(stored, totals, now), failures, now)
    return state.repository_cards(done)


FINISH_SQL = """
WITH old AS (SELECT * REPLACE (c_custkey + 50 AS c_custkey) FROM customer),
n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey::VARCHAR AS id, 'old/' || c_name AS url, c_name AS name,
  CASE WHEN c_acctbal < -500 THEN 'failed' WHEN n IS NOT NULL THEN 'completed' ELSE 'failed' END AS status,
  coalesce(n, c_nationkey)::INTEGER AS file_count, coalesce(2 * n, 7)::INTEGER AS entity_count,
  CASE WHEN c_acctbal < -500 THEN 'no clone' ELSE c_mktsegment END AS error_message
FROM old LEFT JOIN n ON o_custkey = c_custkey
"""


def latest_state(spark, d):
    log = table(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    return state.latest_runs(log, "user_id", "event_id")


def repository_page(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    rows = state.repository_page(orders, 3, 50, "o_orderdate", "o_orderkey")
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def _ranked(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return RankedTable.build(orders, work_path(spark, "ranked"), ["-o_orderdate", "o_orderkey"], range_rows=500)


def ranked_page(spark, d):
    """The fifty rows behind the first two thirds of all orders, newest first."""
    ranked = _ranked(spark, d)
    rows = ranked.page(50, ranked.total() * 2 // 3)
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


_RANKED_SQL = """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice, rank FROM (
  SELECT *, (row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey))::INTEGER AS rank, count(*) OVER () AS n FROM orders)
WHERE rank > n * 2 // 3 AND rank <= n * 2 // 3 + 50"""


def _gate(spark, d):
    asked = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("repository_id"), "source", "lang"
    )
    known = table(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.when(F.col("quality") == 1, "completed").otherwise("parsing").alias("status"),
    )
    return asked, known


def gate_accepted(spark, d):
    return state.accepted(*_gate(spark, d))


def gate_rejected(spark, d):
    return state.rejected(*_gate(spark, d))


def retention_kept(spark, d):
    """Lines of orders that are not expired."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    gone = state.expired(orders, NOW, 365, "o_orderdate")
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "repository_id")
    kept = state.retained({"lines": lines}, gone)["lines"]
    return kept.select("repository_id", "l_linenumber", "l_partkey")


QUERIES = {
    "upsert_repositories": (upsert_repositories, UPSERT_SQL),
    "finish_and_fail": (finish_and_fail, FINISH_SQL),
    "latest_state": (
        latest_state,
        """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
        arg_max(value, event_id) AS value FROM events GROUP BY 1""",
    ),
    "repository_page": (
        repository_page,
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice,
        (SELECT count(*) FROM orders) AS total, 150 < (SELECT count(*) FROM orders) AS has_more FROM orders
        ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100""",
    ),
    "ranked_page": (ranked_page, _RANKED_SQL),
    "gate_accepted": (
        gate_accepted,
        """SELECT doc_id::VARCHAR AS repository_id, source, lang FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    ),
    "gate_rejected": (
        gate_rejected,
        """SELECT doc_id::VARCHAR AS repository_id, source, lang FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    ),
    "retention_kept": (
        retention_kept,
        f"""SELECT l_orderkey AS repository_id, l_linenumber, l_partkey FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders
          WHERE o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 365 DAY)""",
    ),
}
