"""Exact top-k of many queries over all chunks, by cosine or by shared words.

Chunks are scored in Arrow batches against a block of queries at a time, and a
task hands on no more than k rows per query: pairs are never materialised. A
query table that was counted to be small travels as a broadcast; a larger one
meets the chunks block by block in a cogrouped shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from codequarry.functions.text import shown
from codequarry.functions.vectors import NO_SCORE, NORM_GUARD, SCORE_DECIMALS
from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.relational import attach, first_wins, top_n
from codequarry.session import materialise

# Queries travel as a broadcast up to this many, and up to this size.
BROADCAST_QUERIES = 8192
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one block pair in the shuffled form (vectors; word lists are longer
# and come in blocks of an eighth), and queries of one product in memory.
CHUNK_BLOCK = 16384
QUERY_BLOCK = 8192
WORD_BLOCKS = 8
QUERY_STEP = 256
# Chunks of one product: few at first, until each query has k to compare with.
FIRST_CHUNKS = 512
CHUNK_STEP = 2048
# Lengths between which a product in single precision is as near as ``_slack`` says.
PLAIN_NORMS = (1e-2, 1e30)
# More than rounding can move two scores against each other.
ROUNDING = 2 * 10.0**-SCORE_DECIMALS
# Pairs scored exactly at once.
PAIRS_HELD = 8192
# Scores of one batch held at once when words are counted.
SCORES_HELD = 2_000_000


def top_k(
    chunks: DataFrame, queries: DataFrame, k: int | None = None, by: str | None = "repository_id",
    chunk_id: str = "id", query_id: str = "query_id", vector: str = "embedding",
    broadcast_queries: int = BROADCAST_QUERIES, one_of: str | None = None,
) -> DataFrame:
    """``query_id, [by,] id, score, rank`` of the k best chunks of each query.

    With ``by`` a query sees only chunks of its own key. Ties go to the lower
    id; a chunk without a usable vector scores -1 and stays in the ranking. With
    ``one_of`` only the best of the chunks that agree in that column is a hit.
    """
    left = _side(chunks, by, chunk_id, F.col(vector).cast("array<float>"), "id", one_of)
    right = _side(queries, by, query_id, F.col(vector).cast("array<double>"), "query_id")
    return _ranked(_Vectors, left, right, k, by, chunk_id, query_id, broadcast_queries, one_of)


def words_of(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}_]+")
    return F.array_distinct(F.filter(words, lambda word: word != ""))


def keyword_top_k(
    chunks: DataFrame, queries: DataFrame, k: int | None = None, by: str | None = "repository_id",
    chunk_id: str = "id", query_id: str = "query_id", chunk_text: str = "content",
    query_text: str = "question", broadcast_queries: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The k chunks with most of a query's distinct words; none without a match."""
    left = _side(chunks, by, chunk_id, words_of(F.col(chunk_text)), "id")
    right = _side(queries, by, query_id, words_of(F.col(query_text)), "query_id")
    return _ranked(_Words, left, right, k, by, chunk_id, query_id, broadcast_queries)


def _side(
    df: DataFrame, by: str | None, key: str, value: Column, name: str, one_of: str | None = None
) -> DataFrame:
    return df.select(
        F.col(by).alias("by") if by else F.lit(0).alias("by"), F.col(key).alias(name), value.alias("v"),
        *([F.col(one_of).alias("one_of")] if one_of else []),
    )


def _ranked(
    scorer, left: DataFrame, right: DataFrame, k: int | None, by: str | None, chunk_id: str,
    query_id: str, broadcast_queries: int, one_of: str | None = None,
) -> DataFrame:
    k = k or DEFAULT_LIMITS.hits
    schema = T.StructType([
        T.StructField("by", left.schema["by"].dataType),
        T.StructField("query_id", right.schema["query_id"].dataType),
        T.StructField("id", left.schema["id"].dataType),
        T.StructField("score", T.DoubleType()),
        *([left.schema["one_of"]] if one_of else []),
    ])
    # Measured before anything is fetched.
    measured = right.agg(F.count(F.lit(1)), F.sum(scorer.weight(F.col("v")))).first()
    if measured[0] <= broadcast_queries and (measured[1] or 0) <= BROADCAST_BYTES:
        sent = left.sparkSession.sparkContext.broadcast(right.toArrow())
        hits = left.mapInArrow(_scan(scorer, sent, k, schema), schema)
    else:
        hits = _block_join(scorer, left, right, k, schema)
    order = [F.desc("score"), F.col("id")]
    if one_of:
        hits = first_wins(hits, ["query_id", "one_of"], order)
    best = top_n(hits, ["query_id"], order, k)
    if one_of:
        best = best.withColumnRenamed("one_of", one_of) if one_of not in (chunk_id, query_id, by) else best.drop("one_of")
    named = best.withColumnsRenamed({"id": chunk_id, "query_id": query_id})
    return named.withColumnRenamed("by", by) if by else named.drop("by")


def hit_rows(
    hits: DataFrame, chunks: DataFrame, by: str | None = "repository_id", chunk_id: str = "id",
    chars: int | None = DEFAULT_LIMITS.hit_chars,
) -> DataFrame:
    """Attach entity, name, place and (cut) content to ranked hits.

    The hits, a few per question, are written down first: the search behind
    them then runs once.
    """
    hits = materialise(hits, "hits")
    on = ([by] if by else []) + [chunk_id]
    # A chunk names its entity, unless it is one itself.
    entity = [c for c in ("entity_id", "part") if c in chunks.columns and c not in hits.columns]
    details = chunks.select(
        *on, *entity, "entity_name", "entity_type", "file_path",
        shown("content", chars).alias("content"), "line_start", "line_end",
    )
    # A few hits per question against all chunks: the hits are the small side.
    wanted = hits.select(*on).distinct()
    picked = attach(details, wanted.withColumn("_hit", F.lit(True)), on, "inner").drop("_hit")
    # One chunk may be the hit of many questions; its text makes a row wide.
    return attach(hits, picked, on, "inner")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of doubles, and which of them have the right width."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    usable = sizes == width
    out = np.zeros((len(column), width))
    flat = column.filter(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
    out[usable] = flat.reshape(-1, width) if width else 0
    return out, usable


def _scores(vectors: np.ndarray, usable: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Score table, queries by vectors."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    query_norms = np.sqrt((queries * queries).sum(axis=1))
    with np.errstate(invalid="ignore", over="ignore"):
        raw = queries @ vectors.T / (np.outer(query_norms, norms) + NORM_GUARD)
    raw[:, ~usable] = NO_SCORE
    raw[np.isnan(raw)] = NO_SCORE
    return raw


class _Best:
    """Running k best (score, id, entity) of each query of a task, one of each entity.

    Scores compare rounded; what may still round up to the k-th stays in play. Without
    entities (None) each row is one of its own.
    """

    def __init__(self, k: int):
        self.k = k
        self.rows: dict[int, list[tuple[float, object, object]]] = {}

    def floors(self, queries: np.ndarray) -> np.ndarray:
        """Score below which a row cannot enter, per query."""
        kept = (self.rows.get(query, ()) for query in queries.tolist())
        return np.array([
            rows[-1][0] - ROUNDING if len(rows) == self.k else -np.inf for rows in kept
        ])

    def add(
        self, query: int, scores: np.ndarray, ids: pa.Array, floor: float = -np.inf,
        entities: pa.DictionaryArray | None = None,
    ) -> None:
        positions = np.flatnonzero(scores >= floor)
        codes = None if entities is None else entities.indices.to_numpy(zero_copy_only=False)[positions]
        if codes is not None and len(positions):
            # Of an entity only what may round to its best score.
            top = np.full(len(entities.dictionary), -np.inf)
            np.maximum.at(top, codes, scores[positions])
            near = scores[positions] >= top[codes] - ROUNDING
            positions, codes = positions[near], codes[near]
        if len(positions) > 2 * self.k:
            # Everything that ties with the k-th score stays until ids decide.
            above = scores[positions]
            best = above if codes is None else np.sort(top[np.unique(codes)])
            if len(best) > self.k:
                floor = np.partition(best, -self.k)[-self.k] - ROUNDING
                positions = positions[above >= floor]
        if len(positions) == 0:
            return
        picked = pa.array(positions)
        names = ids.take(picked).to_pylist()
        of = names if entities is None else entities.take(picked).to_pylist()
        self._merge(query, np.round(scores[positions], SCORE_DECIMALS).tolist(), names, of, entities is not None)

    def add_pairs(
        self, queries: np.ndarray, scores: np.ndarray, ids: pa.Array, entities: pa.Array | None = None
    ) -> None:
        """Scored pairs of a query (in ascending order) and a chunk."""
        rounded, names = np.round(scores, SCORE_DECIMALS).tolist(), ids.to_pylist()
        of = names if entities is None else entities.to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(queries)) + 1).tolist(), len(queries)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                self._merge(int(queries[a]), rounded[a:b], names[a:b], of[a:b], entities is not None)

    def _merge(self, query: int, rounded: list, names: list, of: list, by_entity: bool) -> None:
        merged = sorted([*self.rows.get(query, ()), *zip(rounded, names, of)], key=lambda row: (-row[0], row[1]))
        if by_entity:
            seen: set = set()
            merged = [row for row in merged if not (row[2] in seen or seen.add(row[2]))]
        self.rows[query] = merged[: self.k]


def _queries_of_key(few: pa.Table) -> dict[object, np.ndarray]:
    by_key: dict[object, list[int]] = {}
    for position, key in enumerate(few["by"].to_pylist()):
        by_key.setdefault(key, []).append(position)
    return {key: np.array(rows) for key, rows in by_key.items()}


class _Vectors:
    """A block of query vectors, ready to score batches of chunk vectors."""

    blocks_per_block = 1

    @staticmethod
    def weight(v: Column) -> Column:
        return F.size(v) * 8

    def __init__(self, few: pa.Table):
        sizes = few["v"].combine_chunks().value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        # Each width of query vectors is a table of its own: a chunk is scored
        # against a query by the query's width, whoever shares the block.
        self.widths: dict[int, tuple[_Units, dict[object, np.ndarray]]] = {}
        of_key = _queries_of_key(few)
        for width in np.unique(sizes).tolist():
            matrix, usable = _matrix(few["v"], width)
            mine = {key: rows[sizes[rows] == width] for key, rows in of_key.items()}
            self.widths[width] = _Units(matrix, usable), {key: rows for key, rows in mine.items() if len(rows)}

    def add(
        self, keys: pa.Array, ids: pa.Array, column: pa.Array, best: _Best, entities: pa.Array | None = None
    ) -> None:
        here = set(keys.unique().to_pylist())
        for width, (queries, by_key) in self.widths.items():
            vectors, usable = _matrix(column, width)
            if width == 0:  # queries without a vector
                usable[:] = False
            for key in here & by_key.keys():
                rows = _rows_of(keys, key)
                at, step = 0, FIRST_CHUNKS
                while at < len(rows):
                    part = rows[at : at + step]
                    at, step = at + len(part), CHUNK_STEP
                    picked = pa.array(part)
                    own = None if entities is None else entities.take(picked)
                    _add_part(_Units(vectors[part], usable[part]), ids.take(picked), queries, by_key[key], best, own)


class _Units:
    """Vectors with their lengths, and at length one in single precision."""

    def __init__(self, vectors: np.ndarray, usable: np.ndarray):
        self.vectors, self.usable = vectors, usable
        with np.errstate(invalid="ignore", over="ignore"):
            self.norms = np.sqrt((vectors * vectors).sum(axis=1))
            low, high = PLAIN_NORMS
            zero = ~vectors.any(axis=1)
            self.plain = zero | ~usable | ((self.norms >= low) & (self.norms <= high))
            length = np.where(self.plain & ~zero & usable, self.norms, np.inf)
            self.units = np.where(self.plain[:, None], vectors / length[:, None], 0).astype(np.float32)


def _slack(width: int) -> float:
    """More than a product of units in single precision can differ from the score."""
    return (width + 4) * 2.0**-23 + 2e-5


def _add_part(
    chunks: _Units, ids: pa.Array, queries: _Units, wanted: np.ndarray, best: _Best, entities: pa.Array | None
) -> None:
    """Score some chunks of a key against its queries.

    Where each query has its first k, single precision tells what may be among them, and
    only that is scored.
    """
    slack = _slack(chunks.vectors.shape[1])
    coded = None
    for start in range(0, len(wanted), QUERY_STEP):
        step = wanted[start : start + QUERY_STEP]
        floors = best.floors(step)
        if not (np.isfinite(floors).all() and chunks.plain.all() and queries.plain[step].all()):
            if coded is None and entities is not None:
                coded = entities.dictionary_encode("encode")
            table = _scores(chunks.vectors, chunks.usable, queries.vectors[step])
            for row in np.flatnonzero(table.max(axis=1) >= floors).tolist():
                best.add(int(step[row]), table[row], ids, floors[row], coded)
            continue
        near = queries.units[step] @ chunks.units.T
        near[:, ~chunks.usable] = NO_SCORE
        rows, at = np.nonzero(near >= (floors - slack).astype(np.float32)[:, None])
        for first in range(0, len(rows), PAIRS_HELD):
            row, place = rows[first : first + PAIRS_HELD], at[first : first + PAIRS_HELD]
            query = step[row]
            scores = np.einsum("ij,ij->i", queries.vectors[query], chunks.vectors[place])
            scores /= queries.norms[query] * chunks.norms[place] + NORM_GUARD
            scores[~chunks.usable[place]] = NO_SCORE
            in_ = scores >= floors[row]
            picked = pa.array(place[in_])
            best.add_pairs(query[in_], scores[in_], ids.take(picked), None if entities is None else entities.take(picked))


class _Words:
    """The words of a block of queries, ready to count them in batches of chunks."""

    blocks_per_block = WORD_BLOCKS

    @staticmethod
    def weight(v: Column) -> Column:
        return F.octet_length(F.array_join(v, "        "))

    def __init__(self, few: pa.Table):
        self.queries = few.num_rows
        self.asking: dict[tuple, list[int]] = {}
        for query, (key, words) in enumerate(zip(few["by"].to_pylist(), few["v"].to_pylist())):
            for word in words or ():
                self.asking.setdefault((key, word), []).append(query)

    def add(
        self, keys: pa.Array, ids: pa.Array, column: pa.Array, best: _Best, entities: pa.Array | None = None
    ) -> None:
        rows = max(1, SCORES_HELD // max(self.queries, 1))
        for start in range(0, len(ids), rows):
            part = zip(keys.slice(start, rows).to_pylist(), column.slice(start, rows).to_pylist())
            found = [
                [q for word in words or () for q in self.asking.get((key, word), ())]
                for key, words in part
            ]
            table = np.array([np.bincount(f, minlength=self.queries) for f in found], dtype=float)
            for query in np.flatnonzero(table.any(axis=0)).tolist():
                hit = np.flatnonzero(table[:, query])
                best.add(query, table[hit, query], ids.take(pa.array(start + hit)))


def _rows_of(keys: pa.Array, key) -> np.ndarray:
    same = pc.fill_null(pc.equal(keys, key), False)
    return np.flatnonzero(same.to_numpy(zero_copy_only=False))


def _result(best: _Best, few: pa.Table, schema: pa.Schema) -> pa.Table:
    query_ids, keys = few["query_id"].to_pylist(), few["by"].to_pylist()
    rows = [
        (keys[query], query_ids[query], chunk, score, entity)
        for query, found in best.rows.items()
        for score, chunk, entity in found
    ]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _columns_of(batch: pa.RecordBatch) -> tuple:
    return tuple(batch.column(name) for name in ("by", "id", "v"))


def _entities_of(batch: pa.RecordBatch) -> pa.Array | None:
    return batch.column("one_of") if "one_of" in batch.schema.names else None


def _scan(scorer, broadcast, k: int, schema: T.StructType):
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = broadcast.value
        block, best = scorer(few), _Best(k)
        for batch in batches:
            block.add(*_columns_of(batch), best, _entities_of(batch))
        yield from _result(best, few, out).to_batches()

    return run


def _blocks(df: DataFrame, size: int, count: str) -> DataFrame:
    """Number of blocks of each key, so that one holds about ``size`` rows."""
    return df.groupBy("by").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(count)
    )


def _block_join(
    scorer, left: DataFrame, right: DataFrame, k: int, schema: T.StructType
) -> DataFrame:
    """Every block of chunks meets every block of queries of its key once.

    Both sides are cut by id hash into blocks of bounded size, so no group
    grows with a key, and copies are sent per block, not per pair.
    """
    chunk_blocks = _blocks(left, max(1, CHUNK_BLOCK // scorer.blocks_per_block), "n_chunk_blocks")
    query_blocks = _blocks(right, max(1, QUERY_BLOCK // scorer.blocks_per_block), "n_query_blocks")
    sizes = chunk_blocks.join(query_blocks, "by")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    chunk_side = attach(left, sizes, ["by"], "inner").select(
        *left.columns,
        own("id", "n_chunk_blocks").alias("cb"),
        F.explode(every("n_query_blocks")).alias("qb"),
    )
    query_side = attach(right, sizes, ["by"], "inner").select(
        "by", "query_id", "v",
        own("query_id", "n_query_blocks").alias("qb"),
        F.explode(every("n_chunk_blocks")).alias("cb"),
    )
    out = to_arrow_schema(schema)

    def score(chunk_block: pa.Table, query_block: pa.Table) -> pa.Table:
        best = _Best(k)
        if chunk_block.num_rows and query_block.num_rows:
            chunk_block = chunk_block.combine_chunks().to_batches()[0]
            scorer(query_block).add(*_columns_of(chunk_block), best, _entities_of(chunk_block))
        return _result(best, query_block, out)

    key = ["by", "cb", "qb"]
    return chunk_side.groupBy(*key).cogroup(query_side.groupBy(*key)).applyInArrow(score, schema)


def vector_widths(chunks: DataFrame, by: str = "repository_id", vector: str = "embedding") -> DataFrame:
    """Vectors, missing ones, and the narrowest and widest of each key."""
    width = F.when(F.col(vector).isNotNull(), F.size(vector))
    return chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.col(vector).isNull()).alias("missing"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
        (F.min(width) == F.max(width)).alias("one_width"),
    )
