"""Line dedup with two Bloom filters: seen once and seen twice.

Each task hashes the line keys of its documents; a key counts once a document. The
hashes travel packed, by part of the hash space. Each part fills a first Bloom
filter and, with the hashes it already knows, a second one: keys of two or more
documents. Only lines found in the second filter are suspects. The suspects alone
are shuffled, as text, for the exact count; false positives of the filters drop out
there, and a filter never misses a repeat, so results do not depend on its size.

All hashes move once, packed, as no task could hold a filter for all lines. The second
filters of all parts are sent to the tasks when together they stay below
``broadcast_bytes``; beyond, hashes go to the filters: each part gets its hashes with
the digests of their documents, tests them, and hands on the suspects, which meet their
documents again by digest. Dropped keys likewise: sent when small, else joined, each
text's outcome keyed by its digest.

Defined cases: a null or empty text is one empty line; keys shorter than ``least``
code points are never dropped; each row counts as a document of its own, whatever
its id (so repeated rows count as often as they are there); very long texts are
read whole; an empty table gives an empty table; columns of other names stay (the
text column is replaced, ``n_lines`` and ``n_dropped`` are added or replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.tables import BROADCAST_BYTES, WorkTables, others, release, restored

MIN_DOCUMENTS = 10
LEAST = 1
BITS_PER_KEY = 12
PROBES = 4
KEYS_PER_PART = 1_000_000

_TRIM = bytes((9, 10, 11, 12, 13, 32))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_keys(text: str | None) -> list[bytes]:
    return [x.strip(_TRIM).translate(_LOWER) for x in (text or "").encode().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    """At least ``least`` code points, counted only where the bytes leave it open."""
    return len(key) >= least and (least <= 1 or len(key) >= 4 * least or len(key.decode()) >= least)


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions of each hash: (PROBES, n)."""
    first = hashes >> np.uint64(32)
    step = (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return np.stack([(first + np.uint64(k) * step) % np.uint64(bits) for k in range(PROBES)]).astype(np.int64)


def _bits_of(n: int) -> int:
    return max(1024, -(-n * BITS_PER_KEY // 8) * 8)


class _Bloom:
    def __init__(self, bits: int, data: np.ndarray | None = None):
        self.bits = bits
        self.data = np.zeros(bits // 8, np.uint8) if data is None else data

    def add(self, hashes: np.ndarray) -> None:
        at = _probes(hashes, self.bits).ravel()
        np.bitwise_or.at(self.data, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _probes(hashes, self.bits)
        return ((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _document_hashes(batch: pa.RecordBatch, least: int) -> np.ndarray:
    """Hashes of the distinct keys of each document, one document after the other."""
    out = []
    for text in batch.column(0).to_pylist():
        out.extend(A.hash_of(k) for k in set(line_keys(text)) if _long_enough(k, least))
    return np.array(out, np.uint64)


_PACKED = pa.schema([("part", pa.int32()), ("payload", pa.binary())])


def _spread(parts: int, least: int):
    def run(batches):
        for batch in A.buffered(batches):
            found, times = np.unique(_document_hashes(batch, least), return_counts=True)
            # More than two sightings in one buffer say no more than two do.
            found = np.concatenate([found, found[times > 1]])
            part = (A.mix64(found) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, found = part[order], found[order]
            names, at = np.unique(part, return_index=True)
            for name, piece in zip(names, np.split(found, at[1:])):
                yield A.rows(_PACKED, part=[name], payload=[A.pack(piece)])
    return run


_FILTERS = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("filter", pa.binary())])


def _filters(batches):
    """The second filter of each part, sized by the hashes that came."""
    for part, held in A.streamed(batches, "part"):
        pieces = [A.unpack(p)[0] for b in held for p in b.column("payload").to_pylist()]
        bits = _bits_of(sum(len(p) for p in pieces))
        once = _Bloom(bits)
        repeats = []
        for piece in pieces:
            # Sorted by hash inside a buffer but for the doubled ones at the end.
            found, times = np.unique(piece, return_counts=True)
            repeats.append(found[(times > 1) | once.has(found)])
            once.add(found)
        again = np.unique(np.concatenate(repeats))
        twice = _Bloom(_bits_of(len(again)))
        twice.add(again)
        yield A.rows(_FILTERS, part=[part], n=[len(again)], filter=[twice.data.tobytes()])


def _suspect_test(filters: dict[int, _Bloom], parts: int):
    def test(hashes: np.ndarray) -> np.ndarray:
        part = (A.mix64(hashes) % np.uint64(parts)).astype(np.int64)
        out = np.zeros(len(hashes), bool)
        for name in np.unique(part):
            if name in filters:
                mine = part == name
                out[mine] = filters[name].has(hashes[mine])
        return out
    return test


_ASKED = pa.schema([("part", pa.int32()), ("turn", pa.int32()), ("payload", pa.binary())])


def _ask(parts: int, least: int):
    """Hashes of the keys of each text, with the text's digest, by part."""
    def run(batches):
        for batch in A.buffered(batches, 4 << 20):
            digests = [np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in (1, 2)]
            found, owner = [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                mine = {A.hash_of(k) for k in set(line_keys(text)) if _long_enough(k, least)}
                found.extend(mine)
                owner.extend([i] * len(mine))
            found, owner = np.array(found, np.uint64), np.array(owner, np.int64)
            part = (A.mix64(found) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, found, owner = part[order], found[order], owner[order]
            names, at = np.unique(part, return_index=True)
            for name, piece in zip(names, np.split(np.arange(len(part)), at[1:])):
                yield A.rows(_ASKED, part=[name], turn=[1], payload=[A.pack(found[piece], *[d[owner[piece]] for d in digests])])
    return run


_ANSWERED = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("hash", pa.int64())])


def _answer(batches):
    """Each part's filter comes first; what of its hashes is in it goes on."""
    for _, held in A.streamed(batches, "part"):
        bloom = None
        for batch in held:
            for turn, payload in zip(batch.column("turn").to_pylist(), batch.column("payload").to_pylist()):
                if turn == 0:
                    bloom = _Bloom(len(payload) * 8, np.frombuffer(payload, np.uint8))
                elif bloom is not None:
                    found, d1, d2 = A.unpack(payload)
                    mine = np.flatnonzero(bloom.has(found))
                    if len(mine):
                        yield A.rows(_ANSWERED, d1=d1[mine], d2=d2[mine], hash=found[mine].view(np.int64))


_KEYS = pa.schema([("key", pa.binary())])


def _named(least: int):
    """Keys of each text that are among its suspects, once for each document with the text."""
    def run(batches):
        for batch in A.sliced(batches):
            out = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wanted = set(np.array(wanted, np.int64).view(np.uint64).tolist())
                out += [k for k in set(line_keys(text)) if _long_enough(k, least) and A.hash_of(k) in wanted]
            if out:
                yield A.rows(_KEYS, key=out)
    return run


def _asked(texts: DataFrame, filters: DataFrame, parts: int, least: int) -> DataFrame:
    """(key) of suspects, found where the filters lie."""
    digests = [F.xxhash64(F.lit(seed), F.coalesce("text", F.lit(""))).alias(name) for seed, name in ((1, "d1"), (2, "d2"))]
    coded = texts.select("text", *digests)
    payloads = coded.mapInArrow(_ask(parts, least), "part int, turn int, payload binary")
    held = filters.select("part", F.lit(0).alias("turn"), F.col("filter").alias("payload"))
    met = held.unionByName(payloads).repartitionById(min(parts, 10_000), F.col("part")).sortWithinPartitions("part", "turn")
    found = met.mapInArrow(_answer, "d1 long, d2 long, hash long")
    wanted = found.groupBy("d1", "d2").agg(F.collect_set("hash").alias("hashes"))
    return coded.join(wanted, ["d1", "d2"]).select("text", "hashes").mapInArrow(_named(least), "key binary")




def _suspects(shared, parts: int, least: int):
    def run(batches):
        test = _suspect_test({k: _Bloom(len(v) * 8, np.frombuffer(v, np.uint8)) for k, v in shared.value.items()}, parts)
        for batch in A.sliced(batches):
            keys = [k for t in batch.column(0).to_pylist() for k in set(line_keys(t)) if _long_enough(k, least)]
            if keys:
                hashes = np.fromiter((A.hash_of(k) for k in keys), np.uint64, len(keys))
                yield A.rows(_KEYS, key=[keys[i] for i in np.flatnonzero(test(hashes))])
    return run


def _keys_column(text):
    """The keys of a text's lines as a native array: the same bytes as ``line_keys``."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.split(lower, "\n"), lambda x: F.btrim(x, F.lit(A.SPACE)))


def repeated_keys(
    docs: DataFrame, work: WorkTables, min_documents: int = MIN_DOCUMENTS, least: int = LEAST, text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(key, n_documents): line keys of at least ``min_documents`` documents."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("text"))
    n_lines = texts.agg(F.sum(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0]
    parts = max(1, -(-(n_lines or 0) // KEYS_PER_PART))
    packed = texts.mapInArrow(_spread(parts, least), "part int, payload binary")
    # Filters are sized by what comes: a part never drops a hash.
    filters = work.write(
        packed.repartitionById(min(parts, 10_000), F.col("part")).sortWithinPartitions("part")
        .mapInArrow(_filters, "part int, n long, filter binary"), "line-filters")
    size = filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size <= broadcast_bytes:
        held = {r["part"]: bytes(r["filter"]) for r in filters.collect()}
        keys = texts.mapInArrow(_suspects(spark.sparkContext.broadcast(held), parts, least), "key binary")
    else:
        keys = _asked(texts, filters, parts, least)
    counted = keys.groupBy("key").agg(F.count("*").alias("n_documents")).filter(F.col("n_documents") >= min_documents)
    out = work.write(counted, "line-keys")
    work.drop("line-filters")
    del packed, keys, counted
    release(spark)
    return out


def _removal(shared):
    def run(batches):
        drop = shared.value
        for batch in A.sliced(batches):
            at = batch.schema.get_field_index("_t")
            texts, lines, dropped = [], [], []
            for text in batch.column(at).to_pylist():
                pieces = (text or "").encode().split(b"\n")
                stay = [p for p in pieces if p.strip(_TRIM).translate(_LOWER) not in drop]
                lines.append(len(pieces))
                dropped.append(len(pieces) - len(stay))
                texts.append(text if len(stay) == len(pieces) else b"\n".join(stay).decode())
            out = pa.StructArray.from_arrays(
                [pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                ["text", "n_lines", "n_dropped"])
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["row", "out"])
    return run


def dedup_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, least: int = LEAST, text: str = "text",
    keep_first: bool = False, doc_id: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with repeated lines dropped, plus ``n_lines`` and ``n_dropped``.

    With ``keep_first`` the first occurrence of a dropped key (smallest doc_id, null
    last; then first line) stays; else all its lines go.
    """
    work = WorkTables(docs.sparkSession)
    keys = repeated_keys(docs, work, min_documents, least, text, broadcast_bytes)
    size = keys.agg(F.sum(F.length("key") + 64)).first()[0] or 0
    added = ("n_lines", "n_dropped")
    shaped = docs.select(others(docs, text, *added).alias("row"), F.col(f"`{text}`").alias("_t"))
    if keep_first:
        out = _keep_first(shaped, keys, text, doc_id)
    elif size <= broadcast_bytes:
        held = frozenset(bytes(r["key"]) for r in keys.toLocalIterator())
        out = shaped.mapInArrow(_removal(docs.sparkSession.sparkContext.broadcast(held)), _ddl(shaped))
    else:
        out = _joined(shaped, keys)
    return out.select(*restored(docs, text, F.col("out.text"), "row", *added), "out.n_lines", "out.n_dropped")


def _ddl(shaped: DataFrame):
    return T.StructType([shaped.schema["row"], T.StructField("out", T.StructType([
        T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType())]))])


def _without(lines, gone):
    """Struct of the text without the lines at the positions ``gone``."""
    stay = F.filter(lines, lambda x, i: ~F.array_contains(gone, i))
    return F.struct(
        F.array_join(stay, "\n").alias("text"), F.size(lines).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"))


def _joined(shaped: DataFrame, keys: DataFrame) -> DataFrame:
    """The outcome of a text depends on the text alone: positions by digest, joined back."""
    coded = shaped.withColumn("d", F.sha2(F.coalesce("_t", F.lit("")), 256))
    lines = coded.select("d", F.posexplode(_keys_column(F.col("_t"))).alias("at", "key"))
    gone = lines.join(keys.select(F.col("key").cast("string").alias("key")), "key", "left_semi")
    gone = gone.groupBy("d").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    found = coded.join(gone, "d", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    return found.withColumn("lines", F.split(F.coalesce("_t", F.lit("")), "\n")).select(
        "row", F.when(F.size("gone") == 0, F.struct(
            F.col("_t").alias("text"), F.size("lines").cast("long").alias("n_lines"),
            F.lit(0).cast("long").alias("n_dropped"))).otherwise(_without(F.col("lines"), F.col("gone"))).alias("out"))


def _keep_first(shaped: DataFrame, keys: DataFrame, text: str, doc_id: str) -> DataFrame:
    """As ``_joined``, but the first place of each key, by (doc_id, digest, line), stays."""
    coded = shaped.withColumn("d", F.sha2(F.coalesce("_t", F.lit("")), 256)).withColumn("id", F.col(f"row.`{doc_id}`"))
    lines = coded.select("id", "d", F.posexplode(_keys_column(F.col("_t"))).alias("at", "key"))
    lines = lines.join(keys.select(F.col("key").cast("string").alias("key")), "key", "left_semi")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "d", "at")
    first = lines.groupBy("key").agg(F.min(place).alias("first"))
    later = lines.join(first, "key").filter(~place.eqNullSafe(F.col("first")))
    gone = later.groupBy("id", "d").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    gone = gone.select(F.col("id").alias("id2"), F.col("d").alias("d2"), "gone")
    found = coded.join(gone, (F.col("d") == F.col("d2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
    found = found.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    return found.withColumn("lines", F.split(F.coalesce("_t", F.lit("")), "\n")).select(
        "row", F.when(F.size("gone") == 0, F.struct(
            F.col("_t").alias("text"), F.size("lines").cast("long").alias("n_lines"),
            F.lit(0).cast("long").alias("n_dropped"))).otherwise(_without(F.col("lines"), F.col("gone"))).alias("out"))
