"""Exact top-k by cosine over a stored index, skipping what bounds rule out.

The index gives each chunk the cell of its nearest pivot and keeps, for each cell, the
largest angle to the pivot, the least norm and the number of rows. The angle between a
query and any chunk of a cell is at least the query's angle to the pivot less that
radius, which bounds the scores in the cell. Queries go through the cells in waves: the
nearest cell first, then those of the nearest pivots, then the rest, each time only where
the bound reaches the k-th score found so far. Skipped cells are neither read nor
shuffled, and a query's vector is copied once for each block that it visits.

Pivots are chunks with the least hashes of their ids, a bounded number; any choice gives
the same hits. Vectors without a direction have cells of their own (null, not finite or
of another width score -1, zero vectors 0), so results equal those of ``search.top_k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codequarry.functions.vectors import NORM_GUARD, norm
from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.relational import top_n
from codequarry.operators.search import ROUNDING, _Best, _columns_of, _matrix, _result, _Vectors
from codequarry.session import materialise

PIVOTS = 256
PIVOT_BYTES = 32 << 20
BLOCK_ROWS = 8192
# Pivots of the second wave.
NEAR = 8
# More than rounding moves an angle, even a small one.
ANGLE_SLACK = 1e-7

NO_DIRECTION = -1
ZERO = -2


def _usable() -> Column:
    """Whether a vector has a direction, is zero, or neither."""
    length = norm("v")
    finite = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.isnan(length) & (length < F.lit(float("inf")))
    return F.when(~F.coalesce(finite, F.lit(False)), NO_DIRECTION).when(length == 0, ZERO).otherwise(0)


def _pivots_of(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Unit pivots of each width; their number is cut to what PIVOT_BYTES hold."""
    some = rows.filter(F.col("kind") == 0).select(F.size("v").alias("width"), "id", "v", F.xxhash64("id", "by").alias("_hash"))
    widths = some.select("width").distinct().count()
    widest = some.agg(F.max("width")).first()[0] or 0
    count = max(1, min(count, PIVOT_BYTES // max(1, 8 * widths * widest)))
    picked = top_n(some, ["width"], [F.col("_hash"), F.col("id")], count).select("width", "v").collect()
    found: dict[int, list] = {}
    for row in picked:
        found.setdefault(row["width"], []).append(row["v"])
    out = {}
    for width, vectors in sorted(found.items()):
        matrix = np.array(vectors, np.float64)
        out[width] = matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]
    return out


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return np.arccos(np.clip((vectors / norms[:, None]) @ pivots.T, -1.0, 1.0))


def _assign(shared, schema: pa.Schema):
    """Add the nearest pivot (``cell``) and the angle to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("kind").to_numpy(zero_copy_only=False)
            cell, angle = kind.astype(np.int32), np.zeros(len(kind))
            for width, pivots in shared.value.items():
                vectors, usable = _matrix(batch.column("v"), width)
                mine = np.flatnonzero(usable & (kind == 0))
                for start in range(0, len(mine), 4096):
                    rows = mine[start:start + 4096]
                    table = _angles(vectors[rows], pivots)
                    cell[rows] = table.argmin(axis=1)
                    angle[rows] = table.min(axis=1)
            columns = [batch.column(name) for name in schema.names if name not in ("cell", "angle")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cell, pa.int32()), pa.array(angle)], schema=schema)
    return run


def _query_angles(shared, schema: pa.Schema):
    """Add the angles to all pivots of the query's width (none without a direction)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column("kind").to_numpy(zero_copy_only=False)
            angles: list = [None] * len(kind)
            for width, pivots in shared.value.items():
                vectors, usable = _matrix(batch.column("v"), width)
                rows = np.flatnonzero(usable & (kind == 0))
                if len(rows):
                    for row, found in zip(rows.tolist(), _angles(vectors[rows], pivots)):
                        angles[row] = found
            columns = [batch.column(name) for name in schema.names if name != "angles"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(angles, schema.field("angles").type)], schema=schema)
    return run


class VectorIndex:
    """Chunk vectors by cell, below ``path``; written by ``build``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(
        cls, chunks: DataFrame, path: str, by: str | None = "repository_id", chunk_id: str = "id", vector: str = "embedding",
        pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS,
    ) -> VectorIndex:
        index = cls(chunks.sparkSession, path)
        rows = chunks.select(
            (F.col(by) if by else F.lit(0)).alias("by"), F.col(chunk_id).alias("id"), F.col(vector).cast("array<float>").alias("v"))
        rows = rows.withColumn("norm", F.coalesce(norm("v"), F.lit(0.0))).withColumn("kind", _usable())
        found = _pivots_of(rows, pivots)
        schema = T.StructType([f for f in rows.schema] + [T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])
        assigned = rows.mapInArrow(_assign(index.spark.sparkContext.broadcast(found), to_arrow_schema(schema)), schema)
        # Null vectors have no width; they share a cell with those that cannot be scored.
        width = F.when(F.col("cell") == NO_DIRECTION, F.lit(0)).otherwise(F.size("v"))
        placed = materialise(assigned.withColumn("width", width).drop("kind"), "vectors-assigned")
        cells = placed.groupBy("by", "width", "cell").agg(
            F.max("angle").alias("radius"), F.min("norm").alias("least_norm"), F.count(F.lit(1)).alias("rows"),
            F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
        cells.write.mode("errorifexists").parquet(f"{index.path}/cells")
        blocks = index.cells().select("by", "width", "cell", "blocks")
        members = placed.join(blocks, ["by", "width", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        members.select("by", "id", "v", "block", "width", "cell").repartition("width", "cell", "by", "block").write.partitionBy(
            "width", "cell").mode("errorifexists").parquet(f"{index.path}/members")
        table = [(width, i, row.tolist()) for width, matrix in found.items() for i, row in enumerate(matrix)]
        index.spark.createDataFrame(table, "width int, cell int, centre array<double>").write.parquet(f"{index.path}/pivots")
        return index

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def members(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/members")

    def _pivots(self) -> dict[int, np.ndarray]:
        found: dict[int, list] = {}
        for row in self.spark.read.parquet(f"{self.path}/pivots").orderBy("width", "cell").collect():  # at most PIVOT_BYTES
            found.setdefault(row["width"], []).append(row["centre"])
        return {width: np.array(rows) for width, rows in found.items()}

    def top_k(
        self, queries: DataFrame, k: int | None = None, by: str | None = "repository_id", chunk_id: str = "id",
        query_id: str = "query_id", vector: str = "embedding",
    ) -> DataFrame:
        """As ``search.top_k``: ``query_id, [by,] id, score, rank`` of the k best chunks of each query."""
        hits, _ = self._search(queries, k or DEFAULT_LIMITS.hits, by, query_id, vector)
        named = hits.withColumnsRenamed({"id": chunk_id, "query_id": query_id})
        return named.withColumnRenamed("by", by) if by else named.drop("by")

    def visited(
        self, queries: DataFrame, k: int | None = None, by: str | None = "repository_id", query_id: str = "query_id",
        vector: str = "embedding",
    ) -> DataFrame:
        """``query_id, scored, total, skipped``: rows scored for a query, all it might have seen, and the share left out."""
        _, seen = self._search(queries, k or DEFAULT_LIMITS.hits, by, query_id, vector)
        return seen.withColumnRenamed("query_id", query_id)

    def _search(self, queries: DataFrame, k: int, by: str | None, query_id: str, vector: str) -> tuple[DataFrame, DataFrame]:
        asked = queries.select(
            (F.col(by) if by else F.lit(0)).alias("by"), F.col(query_id).alias("query_id"),
            F.col(vector).cast("array<double>").alias("v"))
        asked = asked.withColumn("norm", F.coalesce(norm("v"), F.lit(0.0))).withColumn("kind", _usable())
        schema = T.StructType([f for f in asked.schema] + [T.StructField("angles", T.ArrayType(T.DoubleType()))])
        shared = self.spark.sparkContext.broadcast(self._pivots())
        asked = materialise(asked.mapInArrow(_query_angles(shared, to_arrow_schema(schema)), schema), "queries")
        pairs = self._bounded(asked)
        vectors = asked.select("by", "query_id", "v")

        # First the nearest cell that can fill the answer.
        nearest = pairs.groupBy("query_id").agg(F.max_by(
            F.struct("by", "width", "cell", "blocks", "rows"), F.struct((F.col("rows") >= k), -F.col("angle"), F.col("bound"))).alias("c"))
        wave = materialise(nearest.select("query_id", "c.*"), "wave")
        visits, hits = wave, materialise(self._scored(wave, vectors, k), "hits")
        for near in (True, False):
            floor = top_n(hits, ["query_id"], [F.desc("score"), F.col("id")], k).groupBy("query_id").agg(
                F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
            left = pairs.join(floor, "query_id", "left").filter(
                F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - F.lit(ROUNDING)))
            if near:
                left = left.filter(F.col("angle") <= F.coalesce(F.col("reach"), F.lit(float("inf"))))
            left = left.join(visits.select("query_id", "width", "cell"), ["query_id", "width", "cell"], "left_anti")
            wave = materialise(left.select("query_id", "by", "width", "cell", "blocks", "rows"), "wave")
            visits = visits.unionByName(wave)
            hits = hits.unionByName(materialise(self._scored(wave, vectors, k), "hits"))
        best = top_n(hits, ["query_id"], [F.desc("score"), F.col("id")], k)
        every = pairs.groupBy("query_id").agg(F.sum("rows").alias("total"))
        seen = visits.groupBy("query_id").agg(F.sum("rows").alias("scored")).join(every, "query_id").select(
            "query_id", "scored", "total", (1 - F.col("scored") / F.col("total")).alias("skipped"))
        return best, seen

    def _bounded(self, asked: DataFrame) -> DataFrame:
        """Each query with the cells of its key, the angle to the pivot and a bound of the scores inside."""
        reach = F.when(F.size("angles") > NEAR, F.element_at(F.array_sort("angles"), NEAR))
        sides = asked.select("by", "query_id", F.size("v").alias("asked_width"), "norm", "kind", "angles", reach.alias("reach"))
        both = sides.join(self.cells(), "by")
        here = (F.col("kind") != NO_DIRECTION) & (F.col("width") == F.col("asked_width"))
        angle = F.when(here & (F.col("cell") >= 0) & (F.col("kind") == 0), F.get("angles", F.col("cell")))
        cosine = F.cos(F.greatest(angle - F.col("radius") - F.lit(ANGLE_SLACK), F.lit(0.0)))
        # The guard in the score draws it towards 0, most of all for short vectors.
        shrunk = cosine * F.col("norm") * F.col("least_norm") / (F.col("norm") * F.col("least_norm") + F.lit(NORM_GUARD))
        bound = F.when(~here, F.lit(-1.0)).when(angle.isNull(), F.lit(0.0)).otherwise(F.greatest(cosine, shrunk) + F.lit(ROUNDING))
        return both.select(
            "query_id", "by", "width", "cell", "blocks", "rows", "reach",
            F.coalesce(angle, F.lit(float(np.pi))).alias("angle"), bound.alias("bound"))

    def _scored(self, wave: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
        """The k best rows of each query in each block that it visits."""
        here = wave.select("width", "cell").distinct().collect()  # cells are few: pivots of each width
        places: dict[int, list[int]] = {}
        for row in here:
            places.setdefault(row["width"], []).append(row["cell"])
        wanted = F.lit(False)
        for width, cells in places.items():
            wanted = wanted | ((F.col("width") == width) & F.col("cell").isin(cells))
        members = self.members().filter(wanted)
        sent = wave.join(vectors, ["by", "query_id"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "by", "query_id", "v", "width", "cell", "block")
        schema = T.StructType([
            T.StructField("by", members.schema["by"].dataType), T.StructField("query_id", sent.schema["query_id"].dataType),
            T.StructField("id", members.schema["id"].dataType), T.StructField("score", T.DoubleType())])
        out = to_arrow_schema(schema)

        def score(chunks: pa.Table, asked: pa.Table) -> pa.Table:
            best = _Best(k)
            if chunks.num_rows and asked.num_rows:
                _Vectors(asked).add(*_columns_of(chunks.combine_chunks().to_batches()[0]), best)
            return _result(best, asked, out)

        key = ["by", "width", "cell", "block"]
        return members.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(score, schema)
