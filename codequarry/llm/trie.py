"""Prefix trie of conversations, with subtree totals by time-forward processing.

Turns are cut to a digest and a length in one sort by conversation and turn. The sort is
by range, so a conversation of any length is spread over tasks; where it crosses from
one task to the next, counts (and later digests) of the parts in front of it are carried
over, one number for each part. A prefix is named by its depth and two 64-bit sums (XOR)
of hashes of its turns with their places; sums can be carried, so no task needs a whole
conversation. Nodes are the distinct names, with their members counted map-side.

Totals go from children to parents. A node whose members have at most ``shard_rows``
turns from there on is light: its subtree has at most as many nodes, and subtrees of the
topmost light nodes are shards. The others, at most (depth of the trie) * turns /
``shard_rows``, form the top, cut into shards at every ``band`` levels. Spark sorts each
shard externally by reverse level order; the task reads it once and keeps what children
send to parents not yet read in a priority queue, which spills sorted runs. Messages hold
the child's row, so it is given out with its parent's name once the parent is read. What
is left in the queue at a shard's end is for another shard: sums of those messages (made
before the shuffle) are part of the top's input, shards of the top get their lower
neighbours' totals from one more such pass over the shards' roots alone.

A spilled run is a nameless file in the folder that Spark gives a task for its own
spills; nothing else reads it, and a lost task starts again.

Defined cases: rows without a conv_id belong to no conversation; null roles and texts
are empty ones; texts of any length are used whole; turns come by number, null first,
equal ones by role and then text; repeated rows are repeated turns; an empty table has
no conversation and gives no node; other columns are not read, so they cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codequarry.llm import arrays as A
from codequarry.llm.tables import WorkTables, partitions

FAMILY = 5
HEADS = 9
SHARD_ROWS = 1 << 16
BAND = 4096
QUEUE_ROWS = 1 << 18

_NODE = ["depth", "a", "b"]


def turns(conversations: DataFrame, work: WorkTables) -> DataFrame:
    """(conv_id, share, at, digest, size): ``at`` numbers all turns in order, ``share`` is the range that holds it."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    count = max(partitions(conversations.sparkSession), 12)
    dealt = rows.repartitionByRange(count, F.col("conv_id"), F.col("turn").asc_nulls_first())
    ordered = dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    numbered = ordered.select("conv_id", F.monotonically_increasing_id().alias("at"), digest.alias("digest"),
                              F.octet_length("text").cast("long").alias("size"))
    return work.write(numbered.withColumn("share", F.shiftright("at", 33)), "trie-turns")


def _before(value: Column) -> Column:
    """The running aggregate over the shares of a conversation in front of this one."""
    return value.over(Window.partitionBy("conv_id").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))


def rebuilt(rows: DataFrame, work: WorkTables, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns): each conversation begins with the first ``h`` turns of its
    family's first one and goes on with its own turns behind its own first ``h``."""
    parts = work.write(rows.groupBy("conv_id", "share").agg(F.min("at").alias("first"), F.count("*").alias("n")), "trie-parts")
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    base = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    head = F.least(F.col("h"), F.coalesce("base_n", F.lit(0)))
    convs = own.join(base, "base", "left").select(
        "conv_id", "h", head.alias("head"), (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = work.write(convs, "trie-convs")
    carried = parts.withColumn("before", F.coalesce(_before(F.sum("n")), F.lit(0))).join(convs, "conv_id")
    placed = rows.join(carried.select("conv_id", "share", "first", "before", "h", "head"), ["conv_id", "share"]).withColumn(
        "place", F.col("at") - F.col("first") + 1 + F.col("before"))
    mine = placed.filter("place > h").select(
        "conv_id", "share", (F.col("place") - F.col("h") + F.col("head")).alias("depth"), "digest", "size")
    # A family's first turns go to each of its conversations; ids of a family lie around its first one's.
    near = F.explode(F.sequence(F.lit(1 - family), F.lit(family - 1)))
    first = placed.filter((F.col("place") < heads) & (F.col("conv_id") % family == 0)).select(
        F.col("conv_id").alias("base"), "place", "digest", "size", near.alias("step"))
    first = first.withColumn("conv_id", F.try_add("base", "step")).filter(F.col("conv_id") - F.col("conv_id") % family == F.col("base"))
    shared = first.join(convs.select("conv_id", "h"), "conv_id").filter("place <= h").select(
        "conv_id", F.lit(-1).cast("long").alias("share"), F.col("place").alias("depth"), "digest", "size")
    return convs, mine.unionByName(shared)


def paths(convs: DataFrame, rows: DataFrame, work: WorkTables) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, size, rest): the nodes on the way of each conversation."""
    marked = work.write(rows.withColumn("x", F.xxhash64("depth", "digest")).withColumn("y", F.xxhash64("digest", "depth")), "trie-rebuilt")
    parts = marked.groupBy("conv_id", "share").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    nothing = F.lit(0).cast("long")
    carried = parts.select("conv_id", "share", *[F.coalesce(_before(F.bit_xor(c)), nothing).alias(f"before_{c}") for c in "xy"])
    carried = carried.join(convs.select("conv_id", "length"), "conv_id")
    upto = Window.partitionBy("conv_id", "share").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("sum_x", F.bit_xor("x").over(upto)).withColumn("sum_y", F.bit_xor("y").over(upto))
    a, b = (F.col(f"sum_{c}").bitwiseXOR(F.col(f"before_{c}")) for c in "xy")
    found = local.join(carried, ["conv_id", "share"]).select(
        "conv_id", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("pa"), b.bitwiseXOR(F.col("y")).alias("pb"),
        "size", (F.col("length") - F.col("depth")).alias("rest"))
    return work.write(found, "trie-paths")


def nodes(convs: DataFrame, path: DataFrame, work: WorkTables) -> DataFrame:
    """One row for each distinct prefix; ``weight`` bounds the number of nodes from it down."""
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    nothing = F.lit(0).cast("long")
    root = root.select(*[nothing.alias(c) for c in (*_NODE, "pa", "pb")], "conv_id", "n_convs", nothing.alias("saved"),
                       F.lit((1 << 63) - 1).alias("weight"))
    others = path.groupBy(*_NODE).agg(
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        ((F.count("*") - 1) * F.max("size")).alias("saved"), F.sum(F.col("rest") + 1).alias("weight"))
    return work.write(root.unionByName(others), "trie-nodes")


class Queue:
    """A priority queue that keeps ``rows`` entries and spills the rest as sorted runs."""

    def __init__(self, rows: int = QUEUE_ROWS):
        self.rows, self.heap, self.runs = rows, [], []

    def push(self, entry) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.rows:
            self.heap.sort()
            # The later half is not wanted soon.
            later = self.heap[self.rows // 2:]
            del self.heap[self.rows // 2:]
            run = self._run(later)
            heapq.heappush(self.runs, (next(run), len(self.runs), id(run), run))

    @staticmethod
    def _run(entries):
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        with tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None) as file:
            for entry in entries:
                pickle.dump(entry, file)
            count = len(entries)
            del entries
            file.seek(0)
            for _ in range(count):
                yield pickle.load(file)

    def _least(self):
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop_of(self, key):
        """All entries whose first item is ``key`` or comes before it."""
        while True:
            least = self._least()
            if least is None or least[0] > key:
                return
            if self.runs and least is self.runs[0][0]:
                _, *rest, run = heapq.heappop(self.runs)
                following = next(run, None)
                if following is not None:
                    heapq.heappush(self.runs, (following, *rest, run))
            else:
                heapq.heappop(self.heap)
            yield least

    def drain(self):
        yield from self.pop_of((float("inf"),))


_ROW = ["depth", "a", "b", "pa", "pb", "conv_id", "n_convs", "children", "leaves", "saved"]
_OUT = pa.schema([(c, pa.int64()) for c in _ROW] + [("parent_conv_id", pa.int64()), ("done", pa.bool_())])
_OUT_DDL = ", ".join([f"{c} long" for c in _ROW] + ["parent_conv_id long", "done boolean"])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return A.rows(_OUT, **{f.name: list(columns[i]) for i, f in enumerate(_OUT)})


def _forward(queue_rows: int):
    def run(batches):
        shard, queue, out = None, Queue(queue_rows), []
        for batch in batches:
            for name, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", *_ROW))):
                if name != shard:
                    out += [(*entry[1], None, False) for entry in queue.drain()]
                    shard = name
                depth, a, b, pa_, pb, conv_id, n_convs, children, leaves, saved = row
                for _, child in queue.pop_of((-depth, a, b)):
                    children += 1
                    leaves += child[8]
                    saved += child[9]
                    out.append((*child, conv_id, True))
                leaves += children == 0
                queue.push(((1 - depth, pa_, pb), (depth, a, b, pa_, pb, conv_id, n_convs, children, leaves, saved)))
                if len(out) >= 4096:
                    yield _batch(out)
                    out = []
        out += [(*entry[1], None, False) for entry in queue.drain()]
        for start in range(0, len(out), 4096):
            yield _batch(out[start:start + 4096])
    return run


def forward(rows: DataFrame, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """Totals of the nodes of each ``shard``. ``children``, ``leaves`` and ``saved`` bring
    what comes from elsewhere; rows that are not ``done`` are for a parent elsewhere."""
    count = max(partitions(rows.sparkSession), 12)
    ordered = rows.select("shard", *_ROW).repartition(count, "shard").sortWithinPartitions("shard", F.col("depth").desc(), "a", "b")
    return ordered.mapInArrow(_forward(queue_rows), _OUT_DDL)


def _shard(kind: str, *columns: str) -> Column:
    return F.concat_ws(":", F.lit(kind), *[F.col(c).cast("string") for c in columns])


def _messages(rows: DataFrame) -> DataFrame:
    """What children send to each parent, summed: (depth, a, b, m_children, m_leaves, m_saved)."""
    return rows.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("m_children"), F.sum("leaves").alias("m_leaves"), F.sum("saved").alias("m_saved"))


def _received(rows: DataFrame, messages: DataFrame) -> DataFrame:
    both = rows.join(messages, _NODE, "left")
    for c in ("children", "leaves", "saved"):
        both = both.withColumn(c, F.col(c) + F.coalesce(f"m_{c}", F.lit(0)))
    return both.drop("m_children", "m_leaves", "m_saved")


def totals(path: DataFrame, found: DataFrame, work: WorkTables, shard_rows: int = SHARD_ROWS, band: int = BAND,
           queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """Every node with its children, leaves and savings, and its parent's conv_id."""
    nothing = F.lit(0).cast("long")
    found = found.withColumn("children", nothing).withColumn("leaves", nothing)
    top = work.write(found.filter(F.col("weight") > shard_rows).drop("weight"), "trie-top")
    # Where each conversation leaves the top, and the first light node on its way.
    upper = path.join(top.select(*_NODE), _NODE, "left_semi").groupBy("conv_id").agg((F.max("depth") + 1).alias("cut"))
    cut = path.select("conv_id", "depth", "a", "b").join(upper, "conv_id", "left").filter(F.col("depth") == F.coalesce("cut", F.lit(1)))
    cut = cut.select("conv_id", _shard("light", *_NODE).alias("shard"))
    light = found.filter(F.col("weight") <= shard_rows).drop("weight").join(cut, "conv_id")
    below = work.write(forward(light, queue_rows), "trie-below")
    from_below = _messages(below.filter("NOT done"))

    # Shards of the top: a root, or a node ``band`` levels down, and what is below it.
    start = F.col("depth") - F.col("depth") % band
    at_start = path.filter(F.col("depth") % band == 0).select(
        "conv_id", F.col("depth").alias("start"), F.col("a").alias("ra"), F.col("b").alias("rb"))
    held = top.withColumn("start", start).join(at_start, ["conv_id", "start"], "left").withColumn(
        "shard", F.concat_ws(":", "start", F.coalesce("ra", nothing), F.coalesce("rb", nothing)))
    roots = top.filter((F.col("depth") % band == 0) & (F.col("depth") > 0))
    held = work.write(_received(held, from_below), "trie-held")
    if roots.isEmpty():
        above = work.write(forward(held, queue_rows), "trie-above")
    else:
        # A lower shard counts as a child at once, its totals come from the pass over the roots.
        known = _received(held, _messages(roots.withColumn("saved", nothing)))
        local = work.write(forward(known, queue_rows).filter("NOT done"), "trie-local")
        of_parent = held.select(*_NODE, F.col("start").alias("up"), F.coalesce("ra", nothing).alias("ua"), F.coalesce("rb", nothing).alias("ub"))
        linked = local.withColumn("d", F.col("depth") - 1).join(
            of_parent.select(F.col("depth").alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), "up", "ua", "ub"), ["d", "pa", "pb"], "left")
        # Roots by band; the root of the trie is its own band.
        contracted = linked.select(
            F.lit("roots").alias("shard"), F.floor(F.col("depth") / band).alias("depth"), "a", "b",
            F.coalesce("ua", nothing).alias("pa"), F.coalesce("ub", nothing).alias("pb"), "conv_id", "n_convs",
            F.lit(1).cast("long").alias("children"), "leaves", "saved")
        whole = forward(contracted, queue_rows).select((F.col("depth") * band).alias("depth"), "a", "b", "leaves", "saved")
        sent = roots.select(*_NODE, "pa", "pb").join(whole, _NODE)
        above = work.write(forward(_received(held, _messages(sent)), queue_rows), "trie-above")
    every = below.unionByName(above)
    parents = top.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("upper"))
    open_ = every.filter("NOT done").drop("parent_conv_id").join(parents, ["depth", "pa", "pb"], "left").withColumnRenamed("upper", "parent_conv_id")
    return every.filter("done").unionByName(open_).drop("done", "pa", "pb")


_IDS = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("conv_id", pa.int64()), ("ids", pa.large_binary())])


def _joined_ids(batches):
    """Ids of one node in one value, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        depth, a, b, ids = (batch.column(c).to_numpy() for c in (*_NODE, "conv_id"))
        new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])) + 1
        starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(a)]])
        yield A.rows(_IDS, depth=depth[starts], a=a[starts], b=b[starts], conv_id=ids[starts],
                     ids=[",".join(map(str, ids[x:y].tolist())).encode() for x, y in zip(starts, ends)])


_ENDS = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])


def _hashed(batches):
    """SHA-256 over all values of a node, read one after the other."""
    key, state = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if node != key:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256(ids)
            else:
                state.update(b"," + ids)
        if done:
            yield A.rows(_ENDS, **{f.name: list(c) for f, c in zip(_ENDS, zip(*done))})
    if state is not None:
        yield A.rows(_ENDS, **{f.name: [v] for f, v in zip(_ENDS, (*key, state.hexdigest()))})


def ends(convs: DataFrame, path: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): hash of the ids of the conversations that end in a node.

    Sorted by range, so a node where very many end is joined up in many tasks; the one
    that hashes it reads a few long values.
    """
    nothing = F.lit(0).cast("long")
    last = path.filter("rest = 0").select(*_NODE, "conv_id").unionByName(
        convs.filter("length = 0").select(*[nothing.alias(c) for c in _NODE], "conv_id"))
    count = max(partitions(convs.sparkSession), 12)
    order = ["a", "b", "depth", "conv_id"]
    joined = last.repartitionByRange(count, *order).sortWithinPartitions(*order).mapInArrow(
        _joined_ids, "depth long, a long, b long, conv_id long, ids binary")
    return joined.repartition(count, "a", "b", "depth").sortWithinPartitions(*order).mapInArrow(
        _hashed, "depth long, a long, b long, ends_sha256 string")


def build(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS, shard_rows: int = SHARD_ROWS, band: int = BAND,
          queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, a, b): one row a node."""
    work = WorkTables(conversations.sparkSession)
    convs, rows = rebuilt(turns(conversations, work), work, family, heads)
    path = paths(convs, rows, work)
    work.drop("trie-turns", "trie-rebuilt")
    found = nodes(convs, path, work)
    whole = totals(path, found, work, shard_rows, band, queue_rows)
    closed = whole.join(ends(convs, path), _NODE, "left")
    return closed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "a", "b")
