"""Keyword top-k from a stored index of words.

The index holds, for each word, the chunks that have it, in blocks by the chunk's hash, so
a word of very many chunks is many rows. Rows lie in folders by the word's hash, sorted by
word: a search reads the folders of the asked words, and there only what their statistics
do not exclude; chunk texts are not read at all.

A chunk's score is the number of the query's words that it has. Of a query with m words
a chunk found under none of the rarest j has at most m - j. So the rarest half is counted
first; the k-th count t found then tells how many words can bring new chunks, namely the
rarest m - t + 1. The frequent ones beyond are only looked up, in the blocks of chunks that
can still be among the first k: chunks and rows of the index meet by block, a row once for
all queries, and a block hands on what can be among the first k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.relational import top_n
from codequarry.operators.search import words_of
from codequarry.session import materialise

FOLDERS = 64
BLOCK_ROWS = 2048
# Pairs of word and chunk that the build holds before it drops those of repeated ids.
HELD_PAIRS = 1 << 22
# Queries that meet one copy of a block's rows.
QUERY_SHARE = 512
# Words are sent to the readers as values up to this many, and joined alone beyond.
PUSHED_WORDS = 1000


def _folder(word: Column | str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(FOLDERS)).cast("int")


class WordIndex:
    """Words of chunks, below ``path``; written by ``build``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(
        cls, chunks: DataFrame, path: str, by: str | None = "repository_id", chunk_id: str = "id", text: str = "content",
        block_rows: int = BLOCK_ROWS,
    ) -> WordIndex:
        index = cls(chunks.sparkSession, path)
        key = F.col(by) if by else F.lit(0)
        sizes = chunks.groupBy(key.alias("by")).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
        sizes.write.mode("errorifexists").parquet(f"{index.path}/keys")
        # Chunks go to their block once, as their distinct words in one string; what meets there is not shuffled by word.
        rows = chunks.select(
            key.alias("by"), F.col(chunk_id).alias("id"), F.array_join(words_of(F.col(text)), " ").alias("words"))
        placed = index._placed(rows, "by", "id", "words")
        kinds = {f.name: f.dataType for f in placed.schema}
        schema = T.StructType().add("by", kinds["by"]).add("word", T.StringType()).add("block", T.IntegerType()).add(
            "ids", T.ArrayType(kinds["id"])).add("n", T.LongType())
        # A block of a word holds at most as many ids as a block has chunks.
        lists = placed.groupBy("by", "block").applyInArrow(_lists, schema)
        index._write(lists.withColumn("folder", _folder("word")), "postings", "block")
        index._write(index.postings().groupBy("folder", "by", "word").agg(F.sum("n").alias("n")), "words")
        return index

    def _write(self, rows: DataFrame, name: str, *more: str) -> None:
        order = ["folder", "word", "by", *more]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("folder").mode("errorifexists").parquet(
            f"{self.path}/{name}")

    def _placed(self, rows: DataFrame, *columns: str) -> DataFrame:
        """``columns`` of rows of (by, id), with the block of the id."""
        block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        return rows.join(self.keys(), "by").select(*columns, block.alias("block"))

    def keys(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/keys")

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def words(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/words")

    def _of(self, table: DataFrame, asked: DataFrame) -> DataFrame:
        """The rows of ``table`` that asked words can have: their folders, and their names where they are few."""
        folders = [r["folder"] for r in asked.select("folder").distinct().collect()]  # at most FOLDERS
        found = table.filter(F.col("folder").isin(folders))
        few = asked.select("word").distinct().limit(PUSHED_WORDS + 1).collect()
        return found.filter(F.col("word").isin([r["word"] for r in few])) if len(few) <= PUSHED_WORDS else found

    def top_k(
        self, queries: DataFrame, k: int | None = None, by: str | None = "repository_id", chunk_id: str = "id",
        query_id: str = "query_id", text: str = "question",
    ) -> DataFrame:
        """``query_id, [by,] id, score, rank``: the k chunks with most of a query's distinct words; none without a match."""
        k = k or DEFAULT_LIMITS.hits
        asked = queries.select(
            (F.col(by) if by else F.lit(0)).alias("by"), F.col(query_id).alias("query_id"), F.explode(words_of(F.col(text))).alias("word"))
        asked = materialise(asked.withColumn("folder", _folder("word")), "asked")
        known = asked.join(self._of(self.words(), asked), ["folder", "by", "word"])
        # Rarest first; words of no chunk cannot score.
        rarest = Window.partitionBy("query_id").orderBy("n", "word")
        known = known.withColumn("place", F.row_number().over(rarest)).withColumn(
            "m", F.count(F.lit(1)).over(Window.partitionBy("query_id")))
        known = materialise(known, "known-words")

        first = materialise(self._counted(known.filter("place <= (m + 1) / 2")), "counted")
        least = top_n(first, ["query_id"], [F.desc("score"), F.col("id")], k).groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(0)).alias("t"))
        bounds = known.groupBy("query_id").agg(F.first("m").alias("m")).join(least, "query_id", "left").select(
            "query_id", "m", F.coalesce("t", F.lit(0)).alias("t"))
        # Words that can bring a chunk of score t or more that is not yet found.
        half = F.floor((F.col("m") + 1) / 2)
        bounds = materialise(
            bounds.withColumn("essential", F.least("m", F.greatest(half, F.col("m") - F.col("t") + 1))), "bounds")
        ranked = known.drop("m").join(bounds, "query_id")
        more = self._counted(ranked.filter("place <= essential AND place > floor((m + 1) / 2)"))
        every = first.unionByName(more).groupBy("query_id", "by", "id").agg(F.sum("score").alias("score"))
        # Who cannot reach the k-th count even with all other words leaves.
        open_ = every.join(bounds, "query_id").filter(F.col("score") + F.col("m") - F.col("essential") >= F.col("t"))
        rest = ranked.filter("place > essential").select("folder", "query_id", "by", "word")
        whole = self._looked_up(open_.select("query_id", "by", "id", "score"), rest, known, k)
        best = top_n(whole, ["query_id"], [F.desc("score"), F.col("id")], k)
        named = best.withColumnsRenamed({"id": chunk_id, "query_id": query_id})
        return named.withColumnRenamed("by", by) if by else named.drop("by")

    def _counted(self, words: DataFrame) -> DataFrame:
        """Chunks under the words of each query, with the number of words."""
        found = words.select("folder", "query_id", "by", "word").join(
            self._of(self.postings(), words).drop("n"), ["folder", "by", "word"])
        return found.select("query_id", "by", F.explode("ids").alias("id")).groupBy("query_id", "by", "id").agg(
            F.count(F.lit(1)).alias("score"))

    def _looked_up(self, found: DataFrame, rest: DataFrame, known: DataFrame, k: int) -> DataFrame:
        """``found`` with the words of ``rest`` counted too; of a block only what can be among a query's first k."""
        shares = known.groupBy("by").agg(F.ceil(F.count_distinct("query_id") / QUERY_SHARE).cast("int").alias("shares"))
        share = F.pmod(F.xxhash64("query_id"), F.col("shares")).cast("int").alias("share")
        words = rest.groupBy("query_id", "by").agg(F.collect_list("word").alias("words")).join(self.keys(), "by")
        words = words.select("query_id", "by", "words", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        left = self._placed(found, "query_id", "by", "id", "score").unionByName(words, allowMissingColumns=True)
        left = left.join(shares, "by").select("by", "block", share, "query_id", "id", "score", "words")
        # A row is sent once for each share of the queries, not for each query that asks for its word.
        right = self._of(self.postings(), rest).join(rest.select("folder", "by", "word").distinct(), ["folder", "by", "word"], "left_semi")
        right = right.join(shares, "by").select(
            "by", "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "word", "ids")
        schema = T.StructType([found.schema[name] for name in ("query_id", "by", "id", "score")])
        place = ["by", "block", "share"]
        return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(
            lambda asked, rows: _scored(asked, rows, k), T.StructType([T.StructField(f.name, f.dataType) for f in schema]))


def _lists(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of one block, each with its distinct ids in order."""
    parts, most = [], HELD_PAIRS
    for batch in batches:
        words = pc.split_pattern(batch.column("words"), " ")
        pairs = pa.table({"word": pc.list_flatten(words), "id": batch.column("id").take(pc.list_parent_indices(words))})
        parts.append(pairs.filter(pc.not_equal(pairs["word"], "")))
        if sum(p.num_rows for p in parts) > most:
            words, ids, word, spot = _distinct(pa.concat_tables(parts))
            parts = [pa.table({"word": words.take(word), "id": ids.take(spot)})]
            most = max(HELD_PAIRS, 2 * len(word))
    words, ids, word, spot = _distinct(pa.concat_tables(parts))
    held = ids.take(spot)
    valid = held.is_valid()
    n = np.bincount(word, weights=valid.to_numpy(zero_copy_only=False), minlength=len(words)).astype(np.int64)
    ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    by, block = (pa.repeat(value, len(words)) for value in key)
    yield pa.RecordBatch.from_arrays(
        [by, words, block, pa.ListArray.from_arrays(ends, held.filter(valid)), pa.array(n)], ["by", "word", "block", "ids", "n"])


def _distinct(pairs: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Words, ids in order, and the distinct pairs as places in both, by word, then id."""
    coded = pairs["word"].combine_chunks().dictionary_encode()
    ids = pc.unique(pairs["id"])
    ids = ids.take(pc.array_sort_indices(ids))
    spot = pc.index_in(pairs["id"], value_set=ids).to_numpy()
    both = np.unique(coded.indices.to_numpy().astype(np.int64) * max(len(ids), 1) + spot)
    return coded.dictionary, ids, *np.divmod(both, max(len(ids), 1))


def _scored(asked: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Chunks of one block with their whole counts: of each query those with at least its k-th count here."""
    asked = asked.combine_chunks()
    given = pc.is_valid(asked["words"])
    chunks, words = asked.filter(pc.invert(given)), asked.filter(given)
    out = chunks.select(["query_id", "by", "id", "score"])
    if not out.num_rows:
        return out
    ids, queries = pc.unique(out["id"]), pc.unique(out["query_id"])
    spot = pc.index_in(out["id"], value_set=ids).to_numpy()
    query = pc.index_in(out["query_id"], value_set=queries).to_numpy()
    score = out["score"].to_numpy().copy()
    # The ids of each row, by their place among the chunks that are left.
    lists = rows["ids"].combine_chunks()
    held = pc.fill_null(pc.index_in(pc.list_flatten(lists), value_set=ids), -1).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(int)
    row_of = pc.fill_null(pc.index_in(pc.list_flatten(words["words"]), value_set=rows["word"].combine_chunks()), -1).to_numpy()
    word_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(words["words"]).to_numpy())]).astype(int)
    asks = pc.fill_null(pc.index_in(words["query_id"], value_set=queries), -1).to_numpy()
    asking = {q: row_of[word_ends[i]:word_ends[i + 1]] for i, q in enumerate(asks.tolist()) if q >= 0}
    order = np.argsort(query, kind="stable")
    bounds = np.searchsorted(query[order], np.arange(len(queries) + 1))
    keep = np.zeros(out.num_rows, dtype=bool)
    for q in range(len(queries)):
        mine = order[bounds[q]:bounds[q + 1]]
        under = [held[ends[r]:ends[r + 1]] for r in asking.get(q, ()) if r >= 0]
        if under:
            score[mine] += np.bincount(np.concatenate(under) + 1, minlength=len(ids) + 1)[spot[mine] + 1]
        least = np.partition(score[mine], -k)[-k] if len(mine) > k else 0
        keep[mine] = score[mine] >= least
    return out.set_column(3, "score", pa.array(score, pa.int64())).filter(pa.array(keep))
