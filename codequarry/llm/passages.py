"""Substring dedup: recurring passages found with sharded Aho-Corasick automata.

A window is 20 consecutive words of one document. Each word is removed that lies in a
window whose word sequence also starts earlier (smaller doc_id, or earlier in the
same document).

1. Seeds. Of the 10-word runs in a window the one with the smallest hash is its seed;
   equal windows have equal seeds, and a text has about one seed for six words. Seeds
   that occur twice or more are kept, with the first document that has them: their
   home. Nothing else of a document can recur.
2. Pieces. Stretches of windows with recurring seeds are cut out, as text. All windows
   with one seed go to the same shard, chosen by the seed's home, so that the parts of
   a passage stay together; homes with very many seeds are spread seed by seed.
   The windows of these pieces are counted by their hashes, summed up in each task
   first, and the pieces are cut down to the windows that recur: the words beside a
   passage, which differ from document to document, stay at home. Equal pieces are
   sent once: all but the first are repeats as a whole. A shard whose distinct pieces
   are still too large (one seed in very many recurring windows) is spread window by
   window.
3. Automata. Each shard confirms the windows that recur among its pieces, joins their
   first occurrences to phrases and compiles blocks of ten words of them into
   Aho-Corasick automata of bounded size. All pieces are streamed through: at each hit
   the windows around it are compared word by word with the one place where each was
   first, so every removal rests on equal words and the work grows with the hits.
4. The ranges found are joined to the documents by row.

Recurring seeds and windows travel to the tasks while they stay below
``broadcast_bytes`` (windows as a filter of two bytes each, if eight are too many), else they are joined to each document's seeds and each piece's
windows. A shard's distinct pieces are bounded by ``HEAVY_SHARD`` times ``SHARD_BYTES``,
beyond which its windows are dealt by their hashes.

Defined cases: null and empty texts have no words; shorter texts than a window lose
nothing; a null doc_id comes after all others; rows of one id are ordered by a hash
of id and text, and rows equal in both are one document, so equal rows have equal
results; an empty table gives an empty table; columns of other names stay (the text
is replaced, ``n_words`` and ``n_removed`` are added or replaced).
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.tables import BROADCAST_BYTES, WorkTables, others, release, restored

WINDOW = 20
RUN = 10
SHARD_BYTES = 24 << 20  # of text for each part of the seeds, and each shard
HEAVY_SHARD = 2
SEEDS_PER_HOME = 200_000
AUTOMATON_WORDS = 200_000
_DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+-", np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _runs_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total *= _ODD
        total += hashes[k:k + n]
    return A.mix64(total)


def _windows(text: pa.Array):
    """(words, codes, offsets, runs' hashes, seed of each window, which windows lie in one text)."""
    words, codes, offsets = A.word_codes(text)
    hashes = A.word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64)
    runs = _runs_hash(hashes, RUN)
    seeds = A.sliding_min(runs, WINDOW - RUN + 1)
    whole = np.zeros(len(seeds), bool)
    n = np.maximum(np.diff(offsets) - WINDOW + 1, 0)
    whole[A.segments(offsets[:-1], n)] = True
    return words, codes, offsets, runs, seeds, whole


def _seed_places(runs: np.ndarray, seeds: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Places of runs that are the seed of some window: the largest seed around is the run itself."""
    if not len(seeds):
        return np.zeros(0, np.int64)
    span = WINDOW - RUN + 1
    around = np.zeros(len(runs) + span - 1, np.uint64)
    around[span - 1:span - 1 + len(seeds)] = np.where(whole, seeds, np.uint64(0))
    top = ~A.sliding_min(~around, span)
    return np.flatnonzero((top == runs) & (top > 0))


_PACKED = pa.schema([("part", pa.int32()), ("payload", pa.binary())])


def _spread(parts: int):
    def run(batches):
        for batch in A.buffered(batches):
            _, _, offsets, runs, seeds, whole = _windows(batch.column(2))
            at = _seed_places(runs, seeds, whole)
            value = runs[at]
            doc = batch.column(0).to_numpy(zero_copy_only=False)[np.searchsorted(offsets, at, side="right") - 1]
            order = np.lexsort((doc, value))
            value, doc = value[order], doc[order]
            first = np.ones(len(value), bool)
            first[1:] = value[1:] != value[:-1]
            starts = np.flatnonzero(first)
            times = np.diff(np.append(starts, len(value)))
            value, doc = value[starts], doc[starts]
            part = (A.mix64(value) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            names, cut = np.unique(part[order], return_index=True)
            for name, mine in zip(names, np.split(order, cut[1:])):
                yield A.rows(_PACKED, part=[name], payload=[A.pack(
                    value[mine], doc[mine].astype(np.int64), times[mine].astype(np.uint32))])
    return run


_HOMES = pa.schema([("seed", pa.int64()), ("home", pa.int64()), ("n", pa.int64())])


def _homes(batches):
    """Seeds that occur twice or more, with their first document."""
    for _, held in A.streamed(batches, "part"):
        pieces = [A.unpack(p) for b in held for p in b.column("payload").to_pylist()]
        value, doc, times = (np.concatenate([p[k] for p in pieces]) for k in range(3))
        order = np.lexsort((doc, value))
        value, doc, times = value[order], doc[order], times[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        total = np.add.reduceat(times, starts)
        often = total > 1
        yield A.rows(_HOMES, seed=value[starts][often].view(np.int64), home=doc[starts][often], n=total[often])


def _packed_table(batches):
    for batch in A.buffered(batches):
        seed, shard = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([A.pack(seed.view(np.uint64), shard)], pa.binary())], ["payload"])


_PIECES = pa.schema([
    ("shard", pa.int32()), ("piece", pa.binary()), ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()),
    ("n", pa.int64()), ("text", pa.string())])
_PIECES_DDL = "shard int, piece binary, doc long, row long, start long, n long, text string"


def _cut(batch: pa.RecordBatch, shard_of) -> pa.RecordBatch:
    """The pieces of a batch: maximal stretches of windows that go to one shard."""
    words, codes, offsets, _, seeds, whole = _windows(batch.column(2))
    shard = np.full(len(seeds), -1, np.int64)
    inside = np.flatnonzero(whole)
    shard[inside] = shard_of(seeds[inside], np.searchsorted(offsets, inside, side="right") - 1)
    return _stretches(batch, words, codes, offsets, shard)


def _stretches(batch: pa.RecordBatch, words: pa.Array, codes: np.ndarray, offsets: np.ndarray, shard: np.ndarray, base=0) -> pa.RecordBatch:
    """A piece for each stretch of windows with one shard; ``base`` is where the texts start in their rows."""
    change = np.ones(len(shard), bool)
    change[1:] = shard[1:] != shard[:-1]
    # A text's last window and the next text's first one never touch: windows across texts lie between.
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(shard))
    used = shard[starts] >= 0
    starts, ends = starts[used], ends[used]
    text_of = np.searchsorted(offsets, starts, side="right") - 1
    plain = np.array(words.to_pylist(), object)
    texts = [" ".join(plain[codes[a:b + WINDOW - 1]]) for a, b in zip(starts, ends)]
    return A.rows(
        _PIECES, shard=shard[starts], piece=[xxhash.xxh3_128_digest(t.encode()) for t in texts],
        doc=batch.column(0).to_numpy(zero_copy_only=False)[text_of],
        row=batch.column(1).to_numpy(zero_copy_only=False)[text_of],
        start=starts - offsets[text_of] + (base if np.isscalar(base) else base[text_of]), n=ends - starts + WINDOW - 1, text=texts)


def _cut_sent(shared):
    def run(batches):
        known, shards = shared.value

        def shard_of(seeds, _):
            if not len(known):
                return np.full(len(seeds), -1, np.int64)
            at = np.minimum(np.searchsorted(known, seeds), len(known) - 1)
            return np.where(known[at] == seeds, shards[at], -1)

        for batch in A.sliced(batches):
            yield _cut(batch, shard_of)
    return run


def _cut_joined(batches):
    """As ``_cut_sent``, with each row's own recurring seeds and shards beside its text."""
    for batch in A.sliced(batches):
        known, own = batch.column(3), batch.column(4)

        def shard_of(seeds, text_of):
            out = np.full(len(seeds), -1, np.int64)
            for i in np.unique(text_of):
                table = dict(zip(known[int(i)].as_py() or (), own[int(i)].as_py() or ()))
                mine = np.flatnonzero(text_of == i)
                out[mine] = [table.get(s, -1) for s in seeds[mine].view(np.int64).tolist()]
            return out

        yield _cut(batch, shard_of)


_SEEN = pa.schema([("row", pa.int64()), ("seed", pa.int64())])


def _row_seeds(batches):
    for batch in A.buffered(batches):
        _, _, offsets, runs, seeds, whole = _windows(batch.column(2))
        at = _seed_places(runs, seeds, whole)
        row = batch.column(1).to_numpy(zero_copy_only=False)[np.searchsorted(offsets, at, side="right") - 1]
        yield A.rows(_SEEN, row=row, seed=runs[at].view(np.int64))


def _piece_windows(text: pa.Array):
    """(words, codes, offsets, hash of each window, which windows lie in one text)."""
    words, codes, offsets = A.word_codes(text)
    value = _runs_hash(A.word_hashes(words)[codes] if len(words) else np.zeros(0, np.uint64), WINDOW)
    whole = np.zeros(len(value), bool)
    whole[A.segments(offsets[:-1], np.maximum(np.diff(offsets) - WINDOW + 1, 0))] = True
    return words, codes, offsets, value, whole


def _count_windows(parts: int):
    def run(batches):
        for batch in A.buffered(batches):
            _, _, _, value, whole = _piece_windows(batch.column(0))
            value, times = np.unique(value[whole], return_counts=True)
            part = (value % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            names, cut = np.unique(part[order], return_index=True)
            for name, mine in zip(names, np.split(order, cut[1:])):
                # Twice is as good as more.
                yield A.rows(_PACKED, part=[name], payload=[A.pack(
                    value[mine], np.minimum(times[mine], 2).astype(np.uint8))])
    return run


def _often(batches):
    """Windows that occur twice or more."""
    for _, held in A.streamed(batches, "part"):
        pieces = [A.unpack(p) for b in held for p in b.column("payload").to_pylist()]
        value, times = (np.concatenate([p[k] for p in pieces]) for k in range(2))
        order = np.argsort(value)
        value, times = value[order], times[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        often = np.add.reduceat(times, starts) > 1
        yield pa.RecordBatch.from_arrays([pa.array(value[starts][often].view(np.int64))], ["window"])


def _packed_windows(batches):
    for batch in A.buffered(batches):
        yield pa.RecordBatch.from_arrays([pa.array([A.pack(batch.column(0).to_numpy().view(np.uint64))], pa.binary())], ["payload"])


def _recut(batch: pa.RecordBatch, shard_of) -> pa.RecordBatch:
    """Pieces (doc, row, text, shard, start, ...) cut anew; ``shard_of`` gives -1 to windows to leave out."""
    words, codes, offsets, value, whole = _piece_windows(batch.column(2))
    shard = np.full(len(value), -1, np.int64)
    inside = np.flatnonzero(whole)
    text_of = np.searchsorted(offsets, inside, side="right") - 1
    shard[inside] = shard_of(value[inside], text_of, batch.column(3).to_numpy()[text_of])
    return _stretches(batch, words, codes, offsets, shard, batch.column(4).to_numpy())


_RECUT = ("doc", "row", "text", "shard", "start")


def _recut_sent(shared):
    def run(batches):
        known = shared.value

        def shard_of(value, _, old):
            if not len(known):
                return np.full(len(value), -1, np.int64)
            at = np.minimum(np.searchsorted(known, value), len(known) - 1)
            return np.where(known[at] == value, old, -1)

        for batch in A.sliced(batches):
            yield _recut(batch, shard_of)
    return run


def _bits(value: np.ndarray, size: int):
    """The three bits of each window in a filter of ``size`` bits."""
    for k in range(1, 4):
        yield A.mix64(value + np.uint64(k) * _ODD) % np.uint64(size)


def _recut_filtered(shared):
    """As ``_recut_sent``; a window that the filter takes by mistake is one more word in a piece, no more."""
    def run(batches):
        held = shared.value

        def shard_of(value, _, old):
            known = np.ones(len(value), bool)
            for bit in _bits(value, 8 * len(held)):
                known &= (held[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
            return np.where(known, old, -1)

        for batch in A.sliced(batches):
            yield _recut(batch, shard_of)
    return run


def _recut_joined(batches):
    """As ``_recut_sent``, with each piece's own recurring windows beside its text."""
    for batch in A.sliced(batches):
        own = batch.column(5)

        def shard_of(value, text_of, old):
            out = np.full(len(value), -1, np.int64)
            for i in np.unique(text_of):
                mine = np.flatnonzero(text_of == i)
                known = np.array(own[int(i)].as_py(), np.int64).view(np.uint64)
                out[mine] = np.where(np.isin(value[mine], known), old[mine], -1)
            return out

        yield _recut(batch, shard_of)


_INSIDE = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("window", pa.int64())])


def _windows_inside(batches):
    for batch in A.sliced(batches):
        _, _, offsets, value, whole = _piece_windows(batch.column(2))
        inside = np.flatnonzero(whole)
        text_of = np.searchsorted(offsets, inside, side="right") - 1
        yield A.rows(_INSIDE, row=batch.column(1).to_numpy()[text_of], start=batch.column(4).to_numpy()[text_of],
                     window=value[inside].view(np.int64))


def _spread_heavy(heavy: list[int], parts: int):
    """Pieces of heavy shards dealt window by window: equal windows stay together."""
    def run(batches):
        def shard_of(value, _, old):
            return np.where(np.isin(old, heavy), (value % np.uint64(parts)).astype(np.int64), old)

        for batch in A.sliced(batches):
            yield _recut(batch, shard_of)
    return run


def locate(codes: np.ndarray, repeat: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Starts of windows that are equal to an earlier one, found by automata.

    ``codes`` are the words of all pieces in order, each piece followed by a code of
    its own; ``repeat`` marks the windows that recur, ``place`` has where each was first.
    """
    found = np.zeros(len(codes), bool)
    canonical = repeat & (place == np.arange(len(codes)))
    starts = np.flatnonzero(canonical & ~np.concatenate([[False], canonical[:-1]]))
    ends = np.flatnonzero(canonical & ~np.concatenate([canonical[1:], [False]])) + WINDOW  # one past the phrase
    if not len(starts):
        return found
    blocks = A.segments(np.zeros(len(starts), np.int64), (ends - starts) // RUN) * RUN + np.repeat(starts, (ends - starts) // RUN)
    # Words as digits of a small alphabet: an automaton's nodes stay narrow.
    width = 1
    while 64 ** width <= int(codes.max()):
        width += 1
    digits = np.stack([_DIGITS[(codes >> (6 * k)) & 63] for k in reversed(range(width))], axis=1).tobytes().decode()
    per = AUTOMATON_WORDS // RUN
    for at in range(0, len(blocks), per):
        automaton = ahocorasick.Automaton()
        for block in {digits[b * width:(b + RUN) * width] for b in blocks[at:at + per].tolist()}:
            automaton.add_word(block, 0)
        automaton.make_automaton()
        x = np.fromiter((end for end, _ in automaton.iter(digits)), np.int64) + 1 - RUN * width
        x = x[x % width == 0] // width
        # A window of 20 has a whole block of its phrase in its first 19 words.
        for j in range(RUN):
            w = x[x >= j] - j
            w = w[repeat[w] & (place[w] < w) & ~found[w]]
            y = place[w]
            equal = np.ones(len(w), bool)
            for t in range(WINDOW):
                equal &= codes[w + t] == codes[y + t]
            found[w[equal]] = True
    return found


_RANGES = pa.schema([
    ("piece", pa.binary()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64())])


def _automata(batches):
    for _, held in A.streamed(batches, "shard"):
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        doc, row, start = (table.column(c).to_numpy() for c in ("doc", "row", "start"))
        order = np.lexsort((start, row, doc))
        table = table.take(pa.array(order))
        words, codes, offsets = A.word_codes(table.column("text"))
        n = np.diff(offsets)
        # Each piece is closed by a code of its own, so nothing matches across pieces.
        closed = np.empty(len(codes) + len(n), np.int64)
        at = np.arange(len(codes)) + np.repeat(np.arange(len(n)), n)
        closed[at] = codes
        begins = offsets[:-1] + np.arange(len(n))
        closed[begins + n] = len(words) + np.arange(len(n))
        hashes = np.zeros(len(closed), np.uint64)
        hashes[at] = A.word_hashes(words)[codes]
        value = _runs_hash(hashes, WINDOW)
        places = A.segments(begins, n - WINDOW + 1)
        _, first_at, group, times = np.unique(value[places], return_index=True, return_inverse=True, return_counts=True)
        repeat, place = np.zeros(len(closed), bool), np.full(len(closed), -1, np.int64)
        repeat[places] = times[group] > 1
        place[places] = places[first_at][group]
        removed = locate(closed, repeat, place)
        depth = np.zeros(len(closed) + 1, np.int64)
        hit = np.flatnonzero(removed)
        np.add.at(depth, hit, 1)
        np.add.at(depth, hit + WINDOW, -1)
        covered = np.cumsum(depth)[:-1] > 0
        edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        owner = np.searchsorted(begins, a, side="right") - 1
        cut = np.searchsorted(owner, np.arange(len(n) + 1))
        yield A.rows(
            _RANGES, piece=table.column("piece"),
            starts=[(a[cut[i]:cut[i + 1]] - begins[i]).tolist() for i in range(len(n))],
            ends=[(b[cut[i]:cut[i + 1]] - begins[i]).tolist() for i in range(len(n))],
            doc=table.column("doc"), row=table.column("row"), start=table.column("start"))


_OUT = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])


def _remove(batches):
    for batch in A.sliced(batches):
        out = []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            words = (text or "").encode().split()
            stay = np.ones(len(words), bool)
            for r in ranges or ():
                stay[r["a"]:r["b"]] = False
            kept = [w for w, s in zip(words, stay.tolist()) if s] if ranges else words
            out.append({"text": b" ".join(kept).decode(), "n_words": len(words), "n_removed": len(words) - len(kept)})
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _OUT)], ["row", "out"])


def _confirmed(pieces: DataFrame, work: WorkTables, broadcast_bytes: int) -> DataFrame:
    """The pieces cut down to windows that recur among them."""
    spark = pieces.sparkSession
    size = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-4 * size // SHARD_BYTES))
    packed = pieces.select("text").mapInArrow(_count_windows(parts), "part int, payload binary")
    often = work.write(packed.repartition(min(parts, 20_000), "part").sortWithinPartitions("part").mapInArrow(
        _often, "window long"), "passage-windows")
    plain = pieces.select(*_RECUT)
    n_windows = often.count()
    if 8 * n_windows <= broadcast_bytes:
        held = [A.unpack(r["payload"])[0] for r in often.mapInArrow(_packed_windows, "payload binary").collect()]
        sent = spark.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.uint64), *held])))
        return plain.mapInArrow(_recut_sent(sent), _PIECES_DDL)
    if 2 * n_windows <= broadcast_bytes:
        held = np.zeros(broadcast_bytes, np.uint8)
        for r in often.mapInArrow(_packed_windows, "payload binary").toLocalIterator():
            for bit in _bits(A.unpack(r["payload"])[0], 8 * len(held)):
                np.bitwise_or.at(held, bit >> np.uint64(3), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        return plain.mapInArrow(_recut_filtered(spark.sparkContext.broadcast(held)), _PIECES_DDL)
    inside = plain.mapInArrow(_windows_inside, "row long, start long, window long").distinct()
    mine = inside.join(often, "window").groupBy("row", "start").agg(F.collect_list("window").alias("own"))
    return plain.join(mine, ["row", "start"]).select(*_RECUT, "own").mapInArrow(_recut_joined, _PIECES_DDL)


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with repeated passages removed; kept words are joined by single spaces."""
    spark = docs.sparkSession
    work = WorkTables(spark)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    row_of = F.xxhash64(F.col(f"`{doc_id}`").cast("string"), t)
    keyed = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), row_of.alias("row"), t.alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-size // SHARD_BYTES))
    packed = keyed.mapInArrow(_spread(parts), "part int, payload binary")
    homes = work.write(packed.repartition(min(parts, 20_000), "part").sortWithinPartitions("part").mapInArrow(
        _homes, "seed long, home long, n long"), "passage-seeds")
    del packed
    release(spark)
    # Homes of very many seeds: few, as each has its share of all seeds.
    heavy = homes.groupBy("home").agg(F.sum("n").alias("all")).filter(F.col("all") > SEEDS_PER_HOME).select("home", F.lit(True).alias("heavy"))
    placed = work.write(homes.join(heavy, "home", "left").select("seed", F.pmod(
        F.xxhash64(F.when(F.col("heavy"), F.col("seed")).otherwise(F.col("home"))), F.lit(parts)).cast("int").alias("shard")),
        "passage-shards")
    n_seeds = placed.count()
    if 12 * n_seeds <= broadcast_bytes:
        held = [A.unpack(r["payload"]) for r in placed.mapInArrow(_packed_table, "payload binary").collect()]
        known, shards = (np.concatenate([kind[:0], *[h[k] for h in held]]) for k, kind in enumerate(
            (np.zeros(0, np.uint64), np.zeros(0, np.int32))))
        order = np.argsort(known)
        sent = spark.sparkContext.broadcast((known[order], shards[order]))
        pieces = keyed.mapInArrow(_cut_sent(sent), _PIECES_DDL)
    else:
        seen = keyed.mapInArrow(_row_seeds, "row long, seed long").distinct()
        mine = seen.join(placed, "seed").groupBy("row").agg(F.collect_list(F.struct("seed", "shard")).alias("own"))
        pieces = keyed.join(mine, "row").select("doc", "row", "text", "own.seed", "own.shard").mapInArrow(_cut_joined, _PIECES_DDL)
    pieces = work.write(pieces, "passage-wide")
    release(spark)
    pieces = work.write(_confirmed(pieces, work, broadcast_bytes), "passage-pieces")
    work.drop("passage-wide", "passage-windows")
    release(spark)
    bytes_of = pieces.groupBy("shard", "piece").agg(F.first(F.octet_length("text")).alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
    heavy = [r["shard"] for r in bytes_of.filter(F.col("n") > HEAVY_SHARD * SHARD_BYTES).collect()]
    if heavy:
        pieces = work.write(pieces.select(*_RECUT).mapInArrow(_spread_heavy(heavy, parts), _PIECES_DDL), "passage-dealt")
        work.drop("passage-pieces")
    release(spark)
    once = pieces.groupBy("shard", "piece").agg(
        F.min(F.struct("doc", "row", "start")).alias("at"), F.first("text").alias("text"))
    once = once.select("shard", "piece", "at.doc", "at.row", "at.start", "text")
    ranges = work.write(once.repartition(min(parts, 20_000), "shard").sortWithinPartitions("shard").mapInArrow(
        _automata, "piece binary, starts array<long>, ends array<long>, doc long, row long, start long"), "passage-ranges")
    del once
    release(spark)
    firsts = ranges.select("piece", F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b")).alias("inner"),
                           F.struct("doc", "row", "start").alias("at"))
    places = pieces.select("piece", "row", "start", "n", F.struct("doc", "row", "start").alias("mine")).join(firsts, "piece")
    # A piece can lie in two shards only if its windows do; ranges of one place add up.
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b")))
    own = F.transform("inner", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b")))
    gone = places.select("row", F.explode(F.when(F.col("mine") == F.col("at"), own).otherwise(whole)).alias("r"))
    gone = work.write(gone.groupBy("row").agg(F.collect_set("r").alias("ranges")), "passage-gone")
    work.drop("passage-seeds", "passage-shards", "passage-dealt" if heavy else "passage-pieces", "passage-ranges")
    release(spark)
    added = ("n_words", "n_removed")
    shaped = docs.select(others(docs, text, *added).alias("d"), F.col(f"`{text}`").alias("t"), row_of.alias("row"))
    joined = shaped.join(gone, "row", "left").select(F.col("d").alias("row"), "t", "ranges")
    schema = T.StructType([joined.schema["row"], T.StructField("out", T.StructType([
        T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]))])
    done = joined.mapInArrow(_remove, schema)
    return done.select(*restored(docs, text, F.col("out.text"), "row", *added), "out.n_words", "out.n_removed")
