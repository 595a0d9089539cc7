"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine t or more lie within the squared distance 2 (1 - t). A fixed
random rotation spreads that distance over all coordinates; cut into m blocks of some
coordinates each, at least one block then keeps within its share, 2 (1 - t) / m. Each
block is a range join of its own: a grid over the block's first coordinates, with cells
at least twice as wide as the range, holds every vector in its own cell and shows it as
a visitor in those later cells (in lexicographic order) that its range touches, so any
two vectors within the range meet in exactly one cell. There the block's whole distance
is tested against the share. A pair that passes is verified with all coordinates, and
counts in the first of its blocks that passes, so the union of the blocks needs no list
of pairs: counts of links and a spanning set of links alone leave a task.

Equal vectors are one class from the start, so a vector that is a third of all rows is
compared once. A cell of very many vectors is dealt into blocks of rows, and each pair
of such blocks is a task's work of bounded size; all that meet are compared, none is
dropped. What meets is a fixed number of copies of each vector (at most 10 at 64
coordinates) as long as cells are small; in a crowded cell a copy for each of its blocks,
and the comparisons grow with its square, as vectors without any clusters make them. So
pairs of blocks meet in waves, each of which places the vectors anew and shuffles about
two copies of them, gone before the next: the disk does not grow with the square.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own components; vectors of different width are never
compared; repeated rows, and rows that share an id, are vectors of their own with links
to each other; a row without an id links as any other, but never names a component
that has an id, and one alone has none (and is kept); an empty table gives an empty
table; only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.components import components
from codequarry.llm.nearjoin import _spanning as spanning
from codequarry.llm.tables import WorkTables, partitions, release

THRESHOLD = 0.95
BLOCK_WIDTH = 16  # coordinates of a block
GRID = 2  # coordinates of a block that place a vector in the grid
CELL_ROWS = 8192  # vectors of a block of rows
TILE = 1024
WAVE_BYTES = 256 << 20  # of what meets at a time, if two copies of the vectors are less
ROW_BYTES = 25  # of a vector in a piece, besides its coordinates
SLACK = 1e-9
ROUGH = 1e-5  # more than single precision can be off


def rotation(width: int) -> np.ndarray:
    """The same random rotation in every task."""
    q, r = np.linalg.qr(np.random.default_rng(width).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def blocks(width: int) -> list[slice]:
    n = max(1, width // BLOCK_WIDTH)
    cuts = [i * width // n for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def units(matrix: np.ndarray) -> np.ndarray:
    """Unit vectors in doubles, summed column by column so that a row's result depends on that row alone."""
    x = matrix.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    square = np.zeros(len(x))
    for c in range(x.shape[1]):
        square += x[:, c] * x[:, c]
    return x / np.sqrt(square)[:, None]


_SIGNED = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("width", pa.int32()), ("vector", pa.binary())])


def _matrices(column: pa.Array):
    """(rows, matrix) for each width among the vectors that can link."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # null components become NaN
    size = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(offsets))
    for width in np.unique(size[size > 0]):
        mine = np.flatnonzero(size == width)
        matrix = values[offsets[:-1][mine][:, None] + np.arange(width)] + 0.0  # no negative zeros
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield mine[good], np.ascontiguousarray(matrix[good])


def _sign(batches):
    for batch in A.sliced(batches):
        key, vector, width = [None] * batch.num_rows, [None] * batch.num_rows, [None] * batch.num_rows
        for mine, matrix in _matrices(batch.column(1)):
            for i, row in zip(mine.tolist(), matrix):
                data = row.tobytes()
                key[i], vector[i], width[i] = xxhash.xxh3_128_digest(data), data, len(row)
        yield A.rows(_SIGNED, vec_id=batch.column(0), key=key, width=width, vector=vector)


def _joined(data: list[bytes], dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), dtype).reshape(len(data), width)


def _neighbours(y: np.ndarray, cell: np.ndarray, side: float, reach: float):
    """(rows, cells): the own cell first, then later cells that a row's range touches."""
    rows = np.arange(len(y))
    yield rows, cell
    low, high = y - reach < cell * side, y + reach >= (cell + 1) * side
    for step in itertools.product((-1, 0, 1), repeat=y.shape[1]):
        if step > (0,) * len(step):
            touched = np.ones(len(y), bool)
            for c, s in enumerate(step):
                if s:
                    touched &= (low if s < 0 else high)[:, c]
            mine = np.flatnonzero(touched)
            yield mine, cell[mine] + np.array(step)


def _grid(batch: pa.RecordBatch, dtype: str, threshold: float):
    """(names of cells, first row of each and the end, rows, whether they are at home, keys, copies, matrix)
    of each block of coordinates; rows lie cell by cell."""
    widths = batch.column("width").to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        picked = batch.take(pa.array(np.flatnonzero(widths == width)))
        matrix = _joined(picked.column("vector").to_pylist(), dtype, int(width))
        keys = np.frombuffer(b"".join(picked.column("key").to_pylist()), np.uint64).reshape(-1, 2)
        copies = picked.column("copies").to_numpy().astype(np.int64)
        y = units(matrix) @ rotation(int(width))
        cut = blocks(int(width))
        reach = np.sqrt(2 * (1 - threshold) / len(cut)) + SLACK
        for number, columns in enumerate(cut):
            grid = y[:, columns][:, :GRID]
            cell = np.floor(grid / (2 * reach)).astype(np.int32)
            found = list(_neighbours(grid, cell, 2 * reach, reach))
            rows = np.concatenate([r for r, _ in found])
            cells = np.concatenate([c for _, c in found]).astype(np.int32)
            home = np.arange(len(rows)) < len(grid)
            order = np.lexsort(cells.T[::-1])
            rows, cells, home = rows[order], cells[order], home[order]
            starts = np.flatnonzero(np.concatenate([[True], (cells[1:] != cells[:-1]).any(axis=1)]))
            names = [np.concatenate([[width, number], c]).astype(">i4").tobytes() for c in cells[starts]]
            yield names, np.append(starts, len(rows)), rows, home, keys, copies, matrix


_CELLS = pa.schema([("cell", pa.binary()), ("n", pa.int64())])


def _count(dtype: str, threshold: float):
    def run(batches):
        for batch in A.buffered(batches):
            for names, starts, *_ in _grid(batch, dtype, threshold):
                yield A.rows(_CELLS, cell=names, n=np.diff(starts))
    return run


_PLACED = pa.schema([("cell", pa.binary()), ("mine", pa.int32()), ("blocks", pa.int32()), ("first", pa.int32()), ("payload", pa.binary())])


def _place(dtype: str, threshold: float, crowded, wave: int, waves: int):
    """Pieces of the cells with what is to be met in this wave: the blocks ``first``, ``first + waves``, ...

    Which block of rows a vector is in depends on the vector alone, and whether two blocks
    meet in a wave on the cell and the blocks, so that all pairs of blocks meet in one wave each.
    """
    def run(batches):
        for batch in A.buffered(batches):
            for names, starts, rows, home, keys, copies, matrix in _grid(batch, dtype, threshold):
                for name, a, b in zip(names, starts, starts[1:]):
                    n_blocks = crowded.value.get(name, 1)
                    of_cell = A.hash_of(name) % waves
                    mine = (A.mix64(keys[rows[a:b], 0]) % np.uint64(n_blocks)).astype(np.int64)
                    order = np.argsort(mine, kind="stable")
                    cuts = np.searchsorted(mine[order], np.arange(n_blocks + 1))
                    for block in np.flatnonzero(np.diff(cuts)).tolist():
                        first = (wave - of_cell - block) % waves
                        if first >= n_blocks:
                            continue
                        at = a + order[cuts[block]:cuts[block + 1]]
                        for start in range(0, len(at), TILE):
                            part = at[start:start + TILE]
                            r = rows[part]
                            yield A.rows(_PLACED, cell=[name], mine=[block], blocks=[n_blocks], first=[first], payload=[A.pack(
                                keys[r, 0], keys[r, 1], copies[r], home[part].astype(np.uint8), np.ascontiguousarray(matrix[r]).reshape(-1))])
    return run


class _Rows:
    """Vectors of one block of rows of a cell."""

    def __init__(self, payloads: list[bytes], width: int, turn: np.ndarray, cut: list[slice]):
        pieces = [A.unpack(p) for p in payloads]
        self.keys = np.stack([np.concatenate([p[k] for p in pieces]) for k in (0, 1)], axis=1)
        self.copies = np.concatenate([p[2] for p in pieces])
        self.home = np.concatenate([p[3] for p in pieces]).astype(bool)
        matrix = np.concatenate([p[4] for p in pieces]).reshape(-1, width)
        # Those at home come first: visitors are not compared with each other.
        order = np.argsort(~self.home, kind="stable")
        self.keys, self.copies, self.home = self.keys[order], self.copies[order], self.home[order]
        self.homes = int(self.home.sum())
        self.unit = units(matrix[order])
        self.y = self.unit @ turn
        self.square = np.stack([(self.y[:, c] ** 2).sum(axis=1) for c in cut], axis=1)

    def __len__(self):
        return len(self.copies)


    def picked(self, at: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        for name in ("keys", "copies", "home", "unit", "y", "square"):
            setattr(out, name, getattr(self, name)[at])
        return out

    def factors(self, columns: slice, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Single-precision matrices; the product of one with another's is the block's squared distances."""
        y, square = self.y[:, columns], self.square[:, number, None]
        one = np.ones((len(y), 1))
        return (np.concatenate([-2 * y, square, one], axis=1).astype(np.float32),
                np.concatenate([y, one, square], axis=1).astype(np.float32))


def _within(a: np.ndarray, b: np.ndarray, turn: np.ndarray, share: float) -> np.ndarray:
    """Whether pairs keep within the share in the columns of ``turn``; the same wherever a pair is met."""
    out = np.zeros((len(a), turn.shape[1]))
    for c in range(len(turn)):
        out += (a[:, c] - b[:, c])[:, None] * turn[c][None, :]
    total = np.zeros(len(a))
    for c in range(out.shape[1]):
        total += out[:, c] * out[:, c]
    return total <= share


def _links(a: _Rows, b: _Rows, i: int, cut: list[slice], turn: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of the links that count in block ``i``, in double precision."""
    share = 2 * (1 - threshold) / len(cut)
    near = (a.home[:, None] | b.home[None, :]) & (a.unit @ b.unit.T >= threshold)
    for j in range(i + 1):
        d = a.square[:, j][:, None] + b.square[:, j][None, :] - 2 * (a.y[:, cut[j]] @ b.y[:, cut[j]].T)
        passes = d <= share
        x, y = np.nonzero(near & (np.abs(d - share) <= SLACK))
        for start in range(0, len(x), 1 << 16):  # too close to call by products
            p, q = x[start:start + (1 << 16)], y[start:start + (1 << 16)]
            passes[p, q] = _within(a.unit[p], b.unit[q], turn[:, cut[j]], share)
        near &= passes if j == i else ~passes
    return near


def _connected(link: np.ndarray):
    """Pairs (row, column or row) that connect what the matrix connects: each with the least row of its part."""
    some = np.flatnonzero(link.any(axis=1))
    columns = np.flatnonzero(link.any(axis=0))
    link = link[np.ix_(some, columns)]
    label = np.arange(len(some))
    while True:
        of_column = np.where(link, label[:, None], len(some)).min(axis=0, initial=len(some))
        step = np.minimum(label, np.where(link, of_column[None, :], len(some)).min(axis=1, initial=len(some)))
        if (step == label).all():
            return some, some[label], columns, some[of_column]
        label = step


_FOUND = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])


def _compare(threshold: float):
    turns: dict[int, np.ndarray] = {}

    def run(batches):
        for _, held in A.streamed(batches, "pair"):
            sides: list[list[bytes]] = [[], []]
            name = held[0].column("cell")[0].as_py()
            for batch in held:
                for mine, i, payload in zip(*(batch.column(c).to_pylist() for c in ("mine", "i", "payload"))):
                    sides[mine != i].append(payload)
            width, block = np.frombuffer(name, ">i4")[:2].tolist()
            if not sides[0]:
                continue
            turn = turns.setdefault(width, rotation(width))
            cut = blocks(width)
            inside = held[0].column("i")[0].as_py() == held[0].column("j")[0].as_py()
            if not inside and not sides[1]:
                continue
            left = _Rows(sides[0], width, turn, cut)
            right = left if inside else _Rows(sides[1], width, turn, cut)
            yield from _group(left, right, block, cut, turn, threshold, inside)

    return run


def _group(left: _Rows, right: _Rows, block: int, cut, turn, threshold: float, inside: bool):
    """Counts of links and spanning links of one pair of blocks of rows, tile by tile.

    A tile is looked through in single precision, with a margin; only rows and columns
    that have something near are computed in double precision.
    """
    shift = 0 if inside else len(left)
    links = np.zeros(len(left) + (0 if inside else len(right)), np.int64)
    edges = []
    limit = np.float32(2 * (1 - threshold) / len(cut) + ROUGH)
    first, second = left.factors(cut[block], block)[0], right.factors(cut[block], block)[1]
    for x in range(0, left.homes if inside else len(left), TILE):
        for y in range(x if inside else 0, len(right) if x < left.homes else right.homes, TILE):
            near = first[x:x + TILE] @ second[y:y + TILE].T <= limit
            if inside and x == y:
                near = np.triu(near, 1)
            rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(rows):
                continue
            near = near[np.ix_(rows, columns)]
            rows, columns = rows + x, columns + y
            near &= _links(left.picked(rows), right.picked(columns), block, cut, turn, threshold)
            if not near.any():
                continue
            links[rows] += near @ right.copies[columns]
            links[columns + shift] += left.copies[rows] @ near
            some, top, others, over = _connected(near)
            edges += zip(rows[some].tolist(), rows[top].tolist())
            edges += zip((columns[others] + shift).tolist(), rows[over].tolist())
    keys = left.keys if inside else np.concatenate([left.keys, right.keys])
    some = np.flatnonzero(links)
    if len(some):
        yield A.rows(_FOUND, a=[keys[k].tobytes() for k in some], b=[None] * len(some), links=links[some])
    tied = list(spanning(np.array([e[0] for e in edges], np.int64), np.array([e[1] for e in edges], np.int64)))
    if tied:
        yield A.rows(_FOUND, a=[keys[a].tobytes() for a, _ in tied], b=[keys[b].tobytes() for _, b in tied], links=[0] * len(tied))


def _pairs(placed: DataFrame, waves: int) -> DataFrame:
    """Each piece of a cell once for every pair of blocks of rows that its own block is part of in this wave."""
    dealt = placed.withColumn("other", F.explode(F.sequence(F.col("first"), F.col("blocks") - 1, F.lit(waves))))
    dealt = dealt.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    number = lambda c: F.unhex(F.lpad(F.hex(c), 8, "0"))
    return dealt.select(F.concat("cell", number("i"), number("j")).alias("pair"), "cell", "mine", "i", "j", "payload")


def _waves(classes: DataFrame, cells: DataFrame, item: int, wave_bytes: int) -> int:
    """Waves in which the cells meet, so that the shuffle of one holds about two copies of the vectors, or ``wave_bytes``."""
    width = F.conv(F.hex(F.substring("cell", 1, 4)), 16, 10).cast("long")
    moved = cells.agg(F.sum(F.col("n") * F.col("blocks") * (width * item + ROW_BYTES))).first()[0] or 0
    once = classes.agg(F.sum(F.octet_length("vector"))).first()[0] or 0
    return max(1, -(-moved // max(wave_bytes, 2 * once)))


def join(vectors: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding", vec_id: str = "vec_id",
         cell_rows: int = CELL_ROWS, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``.

    ``n_links`` counts the other rows with cosine ``threshold`` or more, ``component_id``
    is the smallest id that links reach, ``kept`` marks the row of that id.
    """
    spark = vectors.sparkSession
    work = WorkTables(spark)
    single = isinstance(vectors.schema[vector].dataType.elementType, T.FloatType)
    dtype = "<f4" if single else "<f8"
    wanted = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                            F.col(f"`{vector}`").cast("array<float>" if single else "array<double>").alias("vector"))
    known = wanted.mapInArrow(_sign, "vec_id long, key binary, width int, vector binary")
    signed = work.write(known.select("vec_id", "key"), "vectors-signed")
    classes = work.write(known.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("width").alias("width"), F.first("vector").alias("vector"), F.count("*").alias("copies"),
        F.min("vec_id").alias("vec_id")), "vectors-classes")
    release(spark)
    vectors_of = classes.select("key", "width", "vector", "copies")
    cells = work.write(vectors_of.mapInArrow(_count(dtype, threshold), "cell binary, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).withColumn("blocks", F.ceil(F.col("n") / F.lit(cell_rows)).cast("int")), "vectors-cells")
    # One cell for thousands of vectors.
    crowded = spark.sparkContext.broadcast({bytes(r["cell"]): r["blocks"] for r in cells.filter("blocks > 1").collect()})
    waves = _waves(classes, cells, 4 if single else 8, wave_bytes)
    for wave in range(waves):
        placed = vectors_of.mapInArrow(
            _place(dtype, threshold, crowded, wave, waves), "cell binary, mine int, blocks int, first int, payload binary")
        met = _pairs(placed, waves).repartition(max(partitions(spark), 12), "pair").sortWithinPartitions("pair")
        found = work.append(met.mapInArrow(_compare(threshold), "a binary, b binary, links long"), "vectors-links")
        del placed, met
        if waves > 1:
            release(spark)
    work.drop("vectors-cells")
    labels = components(found.filter("b IS NOT NULL").select("a", "b"), work, "vectors-parts")
    degree = found.filter("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    named = classes.select("key", "copies", "vec_id").join(labels.withColumnRenamed("node", "key"), "key", "left").join(degree, "key", "left")
    named = named.withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("vec_id").alias("component_id"))
    named = work.write(named.join(least, "label").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vectors-named")
    linked = signed.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))
