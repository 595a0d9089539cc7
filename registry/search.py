"""Vector search over ``embeddings``: a chunk per vector, its label the repository."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.functions.vectors import cosine, norm
from codequarry.operators import search
from codequarry.operators.inverted import WordIndex
from codequarry.operators.pivots import VectorIndex
from codequarry.operators.relational import attach
from codequarry.sources import vector_bytes
from codequarry.session import spread_scan, work_path
from registry.common import table

K = 8


def _chunks(spark, d):
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("repository_id"), "embedding"
    )


def mean_vectors(spark, d):
    """One query per label: the mean of its vectors."""
    spots = table(spark, d, "embeddings").select(
        F.col("label"), F.posexplode("embedding").alias("pos", "x")
    )
    means = spots.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    rows = F.array_sort(F.collect_list(F.struct("pos", "m")))
    return means.groupBy("label").agg(F.transform(rows, lambda r: r["m"]).alias("embedding")).select(
        F.col("label").alias("query_id"), F.col("label").alias("repository_id"), "embedding"
    )


_SCORED = """
WITH spots AS (SELECT label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m FROM spots GROUP BY 1, 2),
queries AS (SELECT label AS query_id, list(m ORDER BY pos) AS q FROM means GROUP BY 1),
scored AS (SELECT query_id, vec_id AS id, label, round(list_dot_product(q, v) /
    (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(v, v)) + 1e-9), 9) AS score
  FROM queries, (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings))
"""


def _ranked(where: str, keyed: str) -> str:
    return _SCORED + f"""
SELECT query_id, {keyed} id, round(score, 6) AS score, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INTEGER AS rank
  FROM scored {where}) WHERE rank <= {K}
"""


def _shown(hits):
    return hits.withColumn("score", F.round("score", 6))


def vector_topk(spark, d):
    return _shown(search.top_k(_chunks(spark, d), mean_vectors(spark, d), K, by=None))


def vector_topk_by_repository(spark, d):
    return _shown(search.top_k(_chunks(spark, d), mean_vectors(spark, d), K))


def vector_topk_blocks(spark, d):
    """The shuffled form, as taken for more queries than may be broadcast."""
    return _shown(search.top_k(
        _chunks(spark, d), mean_vectors(spark, d), K, by=None, broadcast_queries=0
    ))


def _index(spark, d, chunks, by):
    return VectorIndex.build(chunks, work_path(spark, "vector-index"), by, pivots=64)


def vector_topk_index(spark, d):
    """The same hits from a stored index, cells visited in waves."""
    return _shown(_index(spark, d, _chunks(spark, d), None).top_k(mean_vectors(spark, d), K, None))


def vector_topk_index_by_repository(spark, d):
    index = _index(spark, d, _chunks(spark, d), "repository_id")
    return _shown(index.top_k(mean_vectors(spark, d), K))


def vector_topk_index_two_widths(spark, d):
    index = _index(spark, d, _two_widths(_chunks(spark, d), "repository_id"), None)
    return _shown(index.top_k(_two_widths(mean_vectors(spark, d), "query_id"), K, None))


def vector_index_cells(spark, d):
    """What the index holds: all vectors, each in one cell of its repository."""
    cells = _index(spark, d, _chunks(spark, d), "repository_id").cells()
    return cells.groupBy(F.col("by").alias("repository_id")).agg(F.sum("rows").alias("chunks"))


def _two_widths(df, number):
    """Vectors of odd numbers keep their first half only."""
    half = F.slice("embedding", F.lit(1), (F.size("embedding") / 2).cast("int"))
    return df.withColumn("embedding", F.when(F.col(number) % 2 == 1, half).otherwise(F.col("embedding")))


def vector_topk_two_widths(spark, d, **form):
    chunks = _two_widths(_chunks(spark, d), "repository_id")
    queries = _two_widths(mean_vectors(spark, d), "query_id")
    return _shown(search.top_k(chunks, queries, K, by=None, **form))


def vector_topk_two_widths_blocks(spark, d):
    return vector_topk_two_widths(spark, d, broadcast_queries=0)


WIDTHS_SQL = _SCORED.replace("list(m ORDER BY pos) AS q", """CASE WHEN label % 2 = 1
    THEN (list(m ORDER BY pos))[:(count(*) // 2)::INT] ELSE list(m ORDER BY pos) END AS q""").replace(
    "embedding::DOUBLE[] AS v", """CASE WHEN label % 2 = 1 THEN (embedding::DOUBLE[])[:len(embedding) // 2]
    ELSE embedding::DOUBLE[] END AS v""").replace(
    "round(list_dot_product(q, v)", "CASE WHEN len(q) <> len(v) THEN -1 ELSE round(list_dot_product(q, v)").replace(
    ", 9) AS score", ", 9) END AS score") + f"""
SELECT query_id, id, round(score, 6) AS score, rank FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INTEGER AS rank
  FROM scored) WHERE rank <= {K}
"""


def keyword_topk(spark, d):
    """Documents that share most words with each benchmark item."""
    docs = spread_scan(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    hits = search.keyword_top_k(docs, items, 5, by=None, chunk_text="text")
    return hits.withColumn("score", F.col("score").cast("bigint"))


def keyword_topk_index(spark, d):
    """The same from a stored index of words."""
    docs = spread_scan(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))
    index = WordIndex.build(docs, work_path(spark, "word-index"), None, text="text")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))
    return index.top_k(items, 5, None).withColumn("score", F.col("score").cast("bigint"))


def word_counts(spark, d):
    """Documents of each language that hold a word, as the index of words has them."""
    docs = spread_scan(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("repository_id")))
    index = WordIndex.build(docs, work_path(spark, "word-index"), text="text")
    return index.words().select(F.col("by").alias("lang"), "word", "n")


_WORDS = r"unnest(list_distinct(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')))"
KEYWORD_SQL = f"""
WITH d AS (SELECT doc_id AS id, {_WORDS} AS word FROM documents),
q AS (SELECT item_id AS query_id, {_WORDS} AS word FROM benchmark),
scored AS (SELECT query_id, id, count(*) AS score FROM q JOIN d USING (word) WHERE word <> '' GROUP BY 1, 2)
SELECT query_id, id, score, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INTEGER AS rank
FROM scored QUALIFY rank <= 5
"""


def label_scores(spark, d):
    """Cosine as a column: each vector against the mean vector of its label."""
    vectors = table(spark, d, "embeddings").withColumn("n", norm("embedding"))
    means = mean_vectors(spark, d).select(F.col("query_id").alias("label"), F.col("embedding").alias("q"))
    score = cosine("embedding", "q", F.col("n"))
    return attach(vectors, means, ["label"], "inner").select("vec_id", "label", F.round(score, 6).alias("score"))


def vector_widths(spark, d):
    packed = vector_bytes.export_vectors(_chunks(spark, d))
    return search.vector_widths(vector_bytes.import_vectors(packed))


def vector_round_trip(spark, d):
    packed = vector_bytes.export_vectors(_chunks(spark, d)).withColumn("bytes", F.octet_length("embedding"))
    back = vector_bytes.import_vectors(packed)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.select("id", "bytes", F.round(total, 6).alias("total"))


QUERIES = {
    "vector_topk": (vector_topk, _ranked("", "")),
    "vector_topk_by_repository": (
        vector_topk_by_repository, _ranked("WHERE label = query_id", "label AS repository_id,"),
    ),
    "vector_topk_two_widths": (vector_topk_two_widths, WIDTHS_SQL),
    "vector_topk_two_widths_blocks": (vector_topk_two_widths_blocks, WIDTHS_SQL),
    "vector_topk_blocks": (vector_topk_blocks, _ranked("", "")),
    "vector_topk_index": (vector_topk_index, _ranked("", "")),
    "vector_topk_index_by_repository": (
        vector_topk_index_by_repository, _ranked("WHERE label = query_id", "label AS repository_id,"),
    ),
    "vector_topk_index_two_widths": (vector_topk_index_two_widths, WIDTHS_SQL),
    "vector_index_cells": (
        vector_index_cells, "SELECT label AS repository_id, count(*) AS chunks FROM embeddings GROUP BY 1",
    ),
    "keyword_topk": (keyword_topk, KEYWORD_SQL),
    "keyword_topk_index": (keyword_topk_index, KEYWORD_SQL),
    "word_counts": (
        word_counts, f"SELECT lang, word, count(*) AS n FROM (SELECT lang, {_WORDS} AS word FROM documents) WHERE word <> '' GROUP BY 1, 2",
    ),
    "label_scores": (
        label_scores,
        _SCORED + "SELECT id AS vec_id, label, round(score, 6) AS score FROM scored WHERE label = query_id",
    ),
    "vector_widths": (
        vector_widths,
        """SELECT label AS repository_id, count(*) AS chunks, count(*) FILTER (WHERE embedding IS NULL)
          AS missing, min(len(embedding))::INTEGER AS min_width, max(len(embedding))::INTEGER AS max_width,
          min(len(embedding)) = max(len(embedding)) AS one_width FROM embeddings GROUP BY 1""",
    ),
    "vector_round_trip": (
        vector_round_trip,
        """SELECT vec_id AS id, (4 * len(embedding))::INTEGER AS bytes,
          round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings""",
    ),
}
