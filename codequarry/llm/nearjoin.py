"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

Documents with equal shingle sets form one class from the start. Each class has a
signature of ``TREES`` sequences of minima; equal prefixes of a sequence are a node
of that tree's trie. Members of a node are candidates, joined by an edge to the
node's smallest member (never by pairs), and candidates connected in this way form
a group. Within a group all similarities are computed exactly, block against block,
by products of shingle incidence matrices inside the tasks; only link counts and a
spanning set of links leave a task.

The prefix starts long, which keeps chance matches out. From the similarities of
the links found follows how many links such prefixes miss (each link found with
probability p stands for 1/p links); while the recall estimated like this is below
the target, prefixes are shortened by one and the search is done again. The first
length is one at which links exactly at the threshold are found with FLOOR at least.

Shingles are runs of five words (A-Z lower-cased, split at white space); a shorter
text has one shingle, all its words. Similarity is Jaccard's, 0.8 or more links.

Defined cases: null and empty texts have no shingles and are similar to nothing, not
even to each other: each keeps its own id as class; texts of any length are used
whole; repeated rows are copies of one class; a null doc_id is never the name of a
class that has another id; an empty table gives an empty table; only doc_id and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codequarry.llm import arrays as A
from codequarry.llm.components import components
from codequarry.llm.tables import WorkTables, partitions, release

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 5
TARGET = 0.9999
FLOOR = 0.999
BLOCK = 1024
COLUMNS = 4096

_A, _B = (np.random.default_rng(7).integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) for _ in range(2))
_A = _A * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, given its words' hashes."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(A.gram_hashes(hashes, min(SHINGLE, len(hashes)), len(hashes) if len(hashes) < SHINGLE else 0))


def signature(found: np.ndarray) -> np.ndarray:
    """Minima under TREES · DEPTH hash functions, 32 bits each."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):  # bounds memory for very long texts
        piece = found[start:start + 4096]
        np.minimum(low, (_A[:, None] * piece[None, :] + _B[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _of_batch(batch: pa.RecordBatch, column: int):
    words, codes, offsets = A.word_codes(A.lower_ascii(batch.column(column)))
    hashes = A.word_hashes(words)[codes]
    for i in range(batch.num_rows):
        yield shingles(hashes[offsets[i]:offsets[i + 1]])


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary()), ("n", pa.int32()), ("sig", pa.list_(pa.int32()))])


def _sign(batches):
    for batch in A.sliced(batches):
        sets = list(_of_batch(batch, 2))
        yield A.rows(
            _SIGNED, doc_id=batch.column(0), row=batch.column(1),
            digest=[xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            n=[len(s) for s in sets], sig=[signature(s) if len(s) else None for s in sets])


def found_with(similarity: float, depth: int) -> float:
    """Probability that a pair shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity ** depth) ** TREES


def _candidates(classes: DataFrame, depth: int) -> DataFrame:
    """Edges (a, b) from each member of a trie node to the node's smallest member."""
    nodes = classes.select("digest", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.xxhash64(F.slice("sig", t * DEPTH + 1, depth)).alias("prefix")),
    )).alias("at")).select("digest", "at.tree", "at.prefix")
    least = nodes.groupBy("tree", "prefix").agg(F.min("digest").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return nodes.join(least, ["tree", "prefix"]).filter("digest <> b").select(F.col("digest").alias("a"), "b").distinct()


_SETS = pa.schema([("label", pa.binary()), ("blocks", pa.int32()), ("digest", pa.binary()), ("set", pa.binary())])


def _sets(batches):
    for batch in A.sliced(batches):
        for i, found in enumerate(_of_batch(batch, 3)):
            yield A.rows(_SETS, label=batch.column(0)[i:i + 1], blocks=batch.column(1)[i:i + 1],
                         digest=batch.column(2)[i:i + 1], set=[found.tobytes()])


def overlaps(rows: list[np.ndarray], n_left: int) -> np.ndarray:
    """Shared shingles of each of the first ``n_left`` sets with every set of ``rows``."""
    sizes = np.array([len(r) for r in rows])
    values, column, counts = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), sizes)
    # A shingle of one set is no overlap.
    useful = counts > 1
    place = np.cumsum(useful) - 1
    keep = useful[column]
    row, column = row[keep], place[column[keep]]
    out = np.zeros((n_left, len(rows)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(useful.sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(rows), min(COLUMNS, int(useful.sum()) - start)), np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[:n_left] @ part.T
    return out


_FOUND = pa.schema([
    ("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64()), ("standing", pa.float64())])


def _spanning(left: np.ndarray, right: np.ndarray):
    """Links that connect what all links connect, at most one less than there are nodes."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            yield a, b


def _compare(threshold: float, depth: int):
    def run(batches):
        for _, held in A.streamed(batches, "pair"):
            left, right = [], []
            for b in held:
                for digest, data, block, i, j in zip(*(b.column(c).to_pylist() for c in ("digest", "set", "block", "i", "j"))):
                    (left if block == i else right).append((digest, np.frombuffer(data, np.uint64)))
            inside = not right
            every = left + right
            if len(every) < 2 or not left:
                continue
            sizes = np.array([len(s) for _, s in every], np.float64)
            links = np.zeros(len(every), np.int64)
            edges, standing = [], 0.0
            shared = overlaps([s for _, s in every], len(left))
            total = sizes[:len(left), None] + sizes[None, :] - shared
            ok = shared >= threshold * total - 1e-9 * total
            if inside:
                ok &= np.arange(len(every))[None, :] > np.arange(len(left))[:, None]
            else:
                ok[:, :len(left)] = False
            x, y = np.nonzero(ok)
            if not len(x):
                continue
            links += np.bincount(x, minlength=len(every)) + np.bincount(y, minlength=len(every))
            near = (shared[x, y] / total[x, y]).astype(np.float64)
            standing = float((1 / (1 - (1 - near ** depth) ** TREES)).sum())
            edges = list(_spanning(x, y))
            some = np.flatnonzero(links)
            yield A.rows(_FOUND, a=[every[k][0] for k in some], b=[None] * len(some), links=links[some],
                         standing=[standing] + [0.0] * (len(some) - 1))
            yield A.rows(_FOUND, a=[every[k][0] for k, _ in edges], b=[every[k][0] for _, k in edges],
                         links=[0] * len(edges), standing=[0.0] * len(edges))
    return run


def _verified(docs: DataFrame, classes: DataFrame, depth: int, threshold: float, work: WorkTables) -> DataFrame:
    """Rows (a, b, links, standing) of all links inside the candidate groups."""
    groups = components(_candidates(classes, depth), work, f"near-candidates-{depth}")
    sizes = groups.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wanted = groups.withColumnRenamed("node", "digest").join(classes.select("digest", "row"), "digest").join(sizes, "label")
    texts = docs.select("row", "text").join(wanted, "row").dropDuplicates(["digest"])
    sets = texts.select("label", "blocks", "digest", "text").mapInArrow(
        _sets, "label binary, blocks int, digest binary, set binary")
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    # A set goes to each pair of blocks that its own block is part of.
    paired = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select(
        "digest", "set", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "label")
    paired = paired.withColumn("pair", F.xxhash64("label", "i", "j"))
    out = paired.repartition(max(partitions(docs.sparkSession), 12), "pair").sortWithinPartitions("pair")
    found = out.select("pair", "digest", "set", "block", "i", "j").mapInArrow(
        _compare(threshold, depth), "a binary, b binary, links long, standing double")
    return work.write(found, f"near-links-{depth}")


def join(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, text: str = "text",
         doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row, class_id, n_links, n_copies, class_key): one row for each row of ``docs``.

    ``class_id`` is the smallest doc_id of all documents connected by links;
    ``n_links`` counts the other shingle sets that are linked to this one's;
    ``n_copies`` the rows with this shingle set. ``row`` is a hash of id and text;
    ``class_key`` tells classes apart even where texts share an id, and is null for
    documents without words.
    """
    work = WorkTables(docs.sparkSession)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                        F.xxhash64(F.col(f"`{doc_id}`").cast("string"), t).alias("row"), t.alias("text"))
    signed = keyed.mapInArrow(_sign, "doc_id long, row long, digest binary, n int, sig array<int>")
    signed = work.write(signed, "near-signed")
    real = signed.filter("n > 0")
    classes = work.write(real.groupBy("digest").agg(
        F.first("sig").alias("sig"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.count("*").alias("copies")),
        "near-classes")
    depth = DEPTH
    while depth > 1 and found_with(threshold, depth) < FLOOR:
        depth -= 1
    while True:
        links = _verified(keyed, classes, depth, threshold, work)
        release(docs.sparkSession)
        seen, standing = links.agg(F.sum("links") / 2, F.sum("standing")).first()
        if depth == 1 or not seen or seen / standing >= target:
            break
        work.drop(f"near-links-{depth}")
        depth -= 1
    labels = components(links.filter("b IS NOT NULL").select("a", "b"), work, "near-classes-of")
    degree = links.filter("b IS NULL").groupBy(F.col("a").alias("digest")).agg(F.sum("links").alias("n_links"))
    named = classes.select("digest", "copies", "doc_id").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
    named = named.withColumn("label", F.coalesce("label", "digest")).join(degree, "digest", "left")
    least = named.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    named = named.join(least, "label").select("digest", "label", "class_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return signed.select("doc_id", "row", "digest", "n").join(named, "digest", "left").select(
        "doc_id", "row", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"), F.col("label").alias("class_key"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id.

    Ties (one id, several texts, or repeated rows) are settled by the row's hash and
    then by any one of equal rows. Documents without words all stay.
    """
    joined = join(docs, threshold, TARGET, text, doc_id)
    words = joined.filter("class_key IS NOT NULL")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    stays = words.groupBy("class_key").agg(F.min(first).alias("first")).select(
        F.col("first.row").alias("_row"), F.lit(True).alias("_one"))
    stays = stays.union(joined.filter("class_key IS NULL").select("row", F.lit(False)).distinct())
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("_doc"), F.xxhash64(
        F.col(f"`{doc_id}`").cast("string"), F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_row"))
    kept = keyed.join(stays, "_row")
    once = kept.withColumn("_n", F.row_number().over(Window.partitionBy("_row").orderBy("_one")))
    return once.filter("_n = 1 OR NOT _one").select("_doc.*")
