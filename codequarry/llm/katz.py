"""Katz backoff language model of whole texts: training and scoring in one shuffle.

Order two: every token is predicted from the one before it. Words are 64-bit hashes.
Each task turns its documents into distinct (previous, word, document) entries with
counts and sends them, packed, to the part of the hash space that owns the word. A
part then knows all counts of its words and of the pairs that end in them, so it

* sums, for each document, what the score takes from those counts,
* sums, for each previous word, what its backoff weight takes from them, and
* lists the pairs never seen in training, whose score also needs that weight.

All of it goes into one table partitioned by kind, together with the n-gram counts
(kinds ``unigram`` and ``bigram``, see ``unigrams`` and ``bigrams``), from which the
sums by previous word are taken. Good-Turing discounts come from the counts of
counts of all parts; sums are kept by count (one to five), so that discounts can be
applied afterwards and no part has to be read again. Backoff weights are exact:

    P(w | p) = d(r) r / c(p)             if (p, w) was seen r times in training
             = alpha(p) P(w)             if p was seen, but not with w
             = P(w)                      else
    P(w)     = (c(w) + 1) / (N + V + 1)  with one class for all unknown words
    alpha(p) = (1 - sum of seen P(w | p)) / (1 - sum of P(w) over the same words)

so each context's probabilities, the unknown class included, sum to one. Counts
above five lose a constant (``LARGE_DISCOUNT``), so that a weight is never zero;
where counts of counts give no proper discount, half a count is taken off.

A word with more tokens than a part should hold is split over several parts by its
previous words. Its pairs stay whole; what needs its total count is left open in rows
of their own (kinds ``hot``, ``hotdoc``, ``hotcontext``) and closed once the parts'
counts are summed. A first pass finds such words; which ones it takes changes the
load of the parts, never a result.

Memory: a task holds one buffer of text or one part; parts are made for about
``part_bytes`` of text. Equal entries of one document are counted, not repeated.

Defined cases: a null text is empty, and an empty text has one token, the end;
texts of any length are used whole; repeated rows all train and all get a score; a
null doc_id belongs to training; an empty table gives an empty table, and without
training rows each token has the probability of the unknown class; only doc_id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.llm import arrays as A
from codequarry.llm.tables import WorkTables, release

FOLDS, HELD_FOLD = 7, 2
TOP = 5  # counts up to this one are discounted by Good-Turing
LARGE_DISCOUNT = 0.1
PART_BYTES = 16 << 20
BUFFER_BYTES = 6 << 20  # text of one buffer of a task
BATCH_ROWS = 1 << 15  # rows of the table handed on at a time
SHARE = 250_000  # entries of a part handled at a time

BEGIN = np.uint64(A.hash_of(b"\r"))
END = np.uint64(A.hash_of(b"\n"))

_PACKED = pa.schema([("part", pa.int32()), ("payload", pa.binary())])


def held_out(doc_id: Column) -> Column:
    """True for the documents kept out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def _events(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct word, word and previous word of each event, its document)."""
    words, codes, offsets = A.word_codes(A.lower_ascii(text))
    hashes = np.concatenate([A.word_hashes(words), [END, BEGIN]])
    end, begin = len(words), len(words) + 1
    del words
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n), dtype=np.int32), n + 1)
    word = np.empty(len(doc), np.int32)
    ends = np.zeros(len(doc), bool)
    ends[offsets[1:] + np.arange(len(n))] = True
    word[ends] = end
    word[~ends] = codes
    del codes, ends
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[offsets[:-1] + np.arange(len(n))] = begin
    return hashes, word, before, doc


_FREQUENT = pa.schema([("word", pa.int64()), ("n", pa.int64())])


def _frequent(parts: int):
    """Words with more than a quarter of an even part's share of a buffer."""
    def run(batches):
        for batch in A.buffered(batches, BUFFER_BYTES // 4):
            words, codes, _ = A.word_codes(A.lower_ascii(batch.column(0)))
            n = np.bincount(codes, minlength=len(words))
            least = (len(codes) + batch.num_rows) / (4 * parts)
            del codes
            often = np.flatnonzero(n > least)
            hashes, n = A.word_hashes(words.take(pa.array(often))), n[often]
            if batch.num_rows > least:
                hashes, n = np.append(hashes, END), np.append(n, batch.num_rows)
            del words
            A.give_back()
            yield A.rows(_FREQUENT, word=hashes.view(np.int64), n=n)
    return run


def hot_words(texts: DataFrame, parts: int, part_tokens: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, shares): words of more tokens than an even part, fewer than there are parts."""
    found = texts.mapInArrow(_frequent(parts), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    rows = sorted((r["word"], r["n"]) for r in found.filter(F.col("n") > part_tokens).collect())
    hashes = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([math.ceil(2 * r[1] / part_tokens) for r in rows], np.int64)[order]


def _places(hot: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Index of each hash among the hot ones, -1 elsewhere."""
    if not len(hot):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
    return np.where(hot[at] == hashes, at, -1)


def _spread(parts: int, shared):
    def run(batches):
        hot, shares = shared.value
        for batch in A.buffered(batches, BUFFER_BYTES):
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            hashes, word, before, doc = _events(batch.column(2))
            del batch
            A.give_back()
            part_of = (A.mix64(hashes) % np.uint64(parts)).astype(np.int32)
            # Words renumbered part by part, so that sorted entries lie part by part.
            order = np.argsort(part_of, kind="stable")
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.arange(len(order), dtype=np.uint64)
            hashes, part_of = hashes[order], part_of[order]
            wide, long = max(1, len(hashes).bit_length()), max(1, len(keys).bit_length())
            if 2 * wide + long > 64:
                raise ValueError("a buffer has too many words for one code")
            code = rank[word]
            del word
            code <<= np.uint64(wide)
            code |= rank[before]
            del before
            code <<= np.uint64(long)
            code |= doc.view(np.uint32)
            del doc
            code.sort()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            times = np.diff(np.append(first, len(code))).astype(np.uint32)
            code = code[first]
            del first
            w = (code >> np.uint64(wide + long)).astype(np.int32)
            p = ((code >> np.uint64(long)) & np.uint64((1 << wide) - 1)).astype(np.int32)
            d = (code & np.uint64((1 << long) - 1)).astype(np.int32)
            del code
            to = part_of[w]
            at = _places(hot, hashes)[w]
            split = np.flatnonzero(at >= 0)
            if len(split):
                moved = (A.mix64(hashes[p[split]]) % shares[at[split]].astype(np.uint64)).astype(np.int64)
                to[split] = (to[split] + moved) % parts
                del moved
                order = np.argsort(to, kind="stable")
                to, w, p, d, times = to[order], w[order], p[order], d[order], times[order]
            names, starts = np.unique(to, return_index=True)
            del to, at, split
            A.give_back()
            for name, a, b in zip(names, starts, np.append(starts[1:], len(w))):
                mine = [np.unique(x[a:b], return_inverse=True) for x in (w, p, d)]
                yield A.rows(_PACKED, part=[name], payload=[A.pack(
                    hashes[mine[0][0]], mine[0][1].astype(np.uint32), hashes[mine[1][0]], mine[1][1].astype(np.uint32),
                    keys[mine[2][0]], train[mine[2][0]], mine[2][1].astype(np.uint32), times[a:b].astype(np.uint32))])
    return run


# One table for all that a part gives; the meaning of the columns depends on the kind.
_COUNTS = [f"n{i}" for i in range(TOP + 3)]
_REALS = ["base", "big", "low", "context"]
_TABLE = pa.schema(
    [("kind", pa.string()), ("id", pa.int64()), ("doc", pa.int64())] + [(c, pa.int64()) for c in _COUNTS]
    + [(c, pa.float64()) for c in _REALS] + [("payload", pa.binary())])
_TABLE_DDL = ", ".join(
    ["kind string", "id long", "doc long"] + [f"{c} long" for c in _COUNTS] + [f"{c} double" for c in _REALS]
    + ["payload binary"])


def _rows(kind: str, n: int, **columns):
    """Rows of one kind, in batches: columns that a kind leaves null take as much room as others."""
    for start in range(0, n, BATCH_ROWS):
        size, arrays = min(BATCH_ROWS, n - start), []
        for field in _TABLE:
            if field.name == "kind":
                arrays.append(pa.array([kind] * size, field.type))
            elif field.name in columns:
                arrays.append(pa.array(columns[field.name][start:start + size], field.type))
            else:
                arrays.append(pa.nulls(size, field.type))
        yield pa.RecordBatch.from_arrays(arrays, schema=_TABLE)


def _joined(pieces: list[list], table: int, index: int):
    """Distinct values of all payloads' tables, and each entry's place among them.

    What is joined is taken out of the pieces, so that it is not held twice.
    """
    every = np.concatenate([x[table] for x in pieces])
    every.sort()
    values = every[np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))]
    del every
    out, at = np.empty(sum(len(x[index]) for x in pieces), np.uint32), 0
    for x in pieces:
        size = len(x[index])
        out[at:at + size] = np.searchsorted(values, x[table])[x[index]]
        x[table] = x[index] = None
        at += size
    return values, out


def _summed(codes: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct codes and the sums of each one's counts."""
    new, at = np.unique(codes, return_inverse=True)
    return new, *(np.bincount(at, n, len(new)).astype(np.int64) for n in counts)


def _log(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(x > 0, np.log10(np.maximum(x, 1e-300)), 0.0)


def _by_context(places: np.ndarray, n: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """For each context how many of its pairs were seen once, twice, ..., how many more often, and the tokens of those."""
    sums = {f"n{i}": np.bincount(places, n == i, size) for i in range(1, TOP + 1)}
    sums |= {"n6": np.bincount(places, n > TOP, size), "n7": np.bincount(places, n * (n > TOP), size)}
    return {k: v.astype(np.int64) for k, v in sums.items()}


def _part(payloads, hot: np.ndarray, keep_counts: bool):
    """All that a part gives. Pairs are handled in shares of its contexts, so that a
    frequent word, whose entries all lie here, needs little more than they take."""
    pieces = [A.unpack(p) for p in payloads]
    times = np.concatenate([x[7] for x in pieces])
    train_of = np.concatenate([x[5][x[6]] for x in pieces]).astype(bool)
    for x in pieces:
        x[5] = x[7] = None
    words, w = _joined(pieces, 0, 1)
    A.give_back()
    contexts, p = _joined(pieces, 2, 3)
    A.give_back()
    docs, d = _joined(pieces, 4, 6)
    del pieces, x
    A.give_back()
    size, n = len(docs), len(contexts)
    c = np.bincount(w, np.where(train_of, times, 0), len(words)).astype(np.int64)
    by_doc = {k: np.zeros(size) for k in (*_COUNTS, *_REALS)}
    kinds = np.zeros(TOP + 2, np.int64)
    log_plus, log_c, known, plus_one = np.log10(c + 1.0), _log(c.astype(float)), c > 0, c + 1
    log_c[words == END] = 0.0
    is_hot = _places(hot, words) >= 0  # their counts are not whole here
    for values in (log_plus, log_c, known, plus_one):
        values[is_hot] = 0
    A.give_back()
    shares = -(-len(w) // SHARE)
    of_hot: list[tuple] = []
    for share in range(shares):
        mine = np.flatnonzero(p % np.uint32(shares) == share) if shares > 1 else slice(None)
        ww, pp, dd, tt, train = w[mine], p[mine], d[mine], times[mine].astype(np.int64), train_of[mine]
        pairs, pair = np.unique((ww.astype(np.uint64) << np.uint64(32)) | pp, return_inverse=True)
        r = np.bincount(pair, tt * train, len(pairs)).astype(np.int64)
        seen = r[pair]
        fresh = seen == 0

        def add(name, values):
            by_doc[name] += np.bincount(dd, values, size)

        for i in range(TOP + 1):
            add(f"n{i}", tt * (seen == i))
        add("n6", tt)
        add("n7", tt * known[ww])
        plus = tt * log_plus[ww]
        add("base", plus)
        add("low", plus * fresh)
        add("big", tt * _log(np.where(seen > TOP, seen - LARGE_DISCOUNT, 0.0)))
        add("context", tt * log_c[ww])
        live = r > 0
        pw, px = (pairs[live] >> np.uint64(32)).astype(np.int64), (pairs[live] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rr = r[live]
        for i in range(1, TOP + 2):
            kinds[i] += int((rr == i).sum())
        some, places = np.unique(px, return_inverse=True)
        n0 = np.bincount(places, plus_one[pw], len(some)).astype(np.int64)
        if not keep_counts:
            yield from _rows("context", len(some), id=contexts[some].view(np.int64), n0=n0, **_by_context(places, rr, len(some)))
        elif len(pw):
            # Pairs are sorted by word: each word once with the number of its pairs, each context once. What a
            # context's backoff weight takes from its pairs is read off them again, but for the words' own counts.
            heads = np.flatnonzero(np.concatenate([[True], pw[1:] != pw[:-1]]))
            yield from _rows("bigram", 1, payload=[A.pack(
                words[pw[heads]], np.diff(np.append(heads, len(pw))).astype(np.uint32), contexts[some], n0,
                places.astype(np.uint32), rr.astype(np.uint32))])
            del heads
        new, at = np.unique((dd[fresh].astype(np.uint64) << np.uint64(32)) | pp[fresh], return_inverse=True)
        yield from _rows("unseen", len(new), id=contexts[(new & np.uint64(0xFFFFFFFF)).astype(np.int64)].view(np.int64),
                    doc=docs[(new >> np.uint64(32)).astype(np.int64)],
                    n0=np.bincount(at, tt[fresh], len(new)).astype(np.int64))
        if is_hot.any():
            mine = is_hot[pw]
            yield from _rows("hotcontext", int(mine.sum()), id=contexts[px[mine]].view(np.int64), doc=words[pw[mine]].view(np.int64))
            mine = np.flatnonzero(is_hot[ww])
            of_hot.append(_summed((dd[mine].astype(np.uint64) << np.uint64(32)) | ww[mine], tt[mine], tt[mine] * fresh[mine]))
        del ww, pp, dd, tt, train, pairs, pair, r, seen, fresh, plus, live, pw, px, rr, some, places, n0, at, new, mine
        A.give_back()
    del w, p, d, times, train_of
    if of_hot:
        new, n0, n1 = _summed(*(np.concatenate(x) for x in zip(*of_hot)))
        of_hot.clear()
        yield from _rows("hotdoc", len(new), id=docs[(new >> np.uint64(32)).astype(np.int64)],
                    doc=words[(new & np.uint64(0xFFFFFFFF)).astype(np.int64)].view(np.int64), n0=n0, n1=n1)
    yield from _rows("doc", size, id=docs, **{k: v.astype(np.int64) if k in _COUNTS else v for k, v in by_doc.items()})
    yield from _rows("hot", int(is_hot.sum()), id=words[is_hot].view(np.int64), n0=c[is_hot])
    if keep_counts and c.any():
        # A frequent word has a count in each part that holds some of its pairs.
        yield from _rows("unigram", 1, payload=[A.pack(words[c > 0], c[c > 0])])
    c[is_hot] = 0
    del by_doc
    yield from _rows("stats", 1, n0=[int(c.sum())], n7=[int((c > 0).sum())], **{f"n{i}": [int(kinds[i])] for i in range(1, TOP + 2)})


def _payloads(held: list[pa.RecordBatch]):
    """Payloads of the batches one at a time; a batch that was read is let go."""
    while held:
        for payload in held.pop(0).column("payload"):
            yield payload.as_buffer()


def _parts(shared, keep_counts: bool):
    def run(batches):
        hot, _ = shared.value
        for _, held in A.streamed(batches, "part"):
            yield from _part(_payloads(held), hot, keep_counts)
    return run


def discounts(n: list[int]) -> list[float]:
    """d(1) … d(TOP) from the numbers of pairs seen once, twice, … TOP + 1 times."""
    out = []
    common = (TOP + 1) * n[TOP] / n[0] if n[0] else 1.0
    for r in range(1, TOP + 1):
        value = None
        if n[r - 1] and n[r] and common < 1:
            value = ((r + 1) * n[r] / n[r - 1] / r - common) / (1 - common)
        out.append(value if value is not None and 0 < value < 1 else (r - 0.5) / r)
    return out


def model(docs: DataFrame, work: WorkTables, text: str = "text", doc_id: str = "doc_id",
          keep_counts: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """The partitioned table of all kinds; ``docs`` needs ``_key`` and ``_train`` besides the text."""
    size, gaps = docs.agg(
        F.sum(F.octet_length(text) + 16), F.sum(F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit(""))) + 2),
    ).first()
    parts = max(1, -(-(size or 0) // part_bytes))
    texts = docs.select(F.col(text).alias("text"))
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hot = hot_words(texts, parts, gaps / parts) if parts > 1 else none
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    packed = docs.select("_key", "_train", F.col(text).alias("text")).mapInArrow(_spread(parts, shared), "part int, payload binary")
    # One task for each part: dealt by hash, several would meet in one and others idle.
    table = packed.repartitionById(min(parts, 20_000), F.col("part")).sortWithinPartitions("part").mapInArrow(
        _parts(shared, keep_counts), _TABLE_DDL)
    stored = work.partitioned(table, "katz", "kind")
    del packed, table
    release(docs.sparkSession)
    return stored


_BIGRAM = pa.schema([("word", pa.int64()), ("context", pa.int64()), ("n", pa.int64())])


def _unigrams(batches):
    for batch in batches:
        for payload in batch.column("payload"):
            words, n = A.unpack(payload.as_buffer())
            yield A.rows(_FREQUENT, word=words.view(np.int64), n=n)


def _bigrams(batches):
    for batch in batches:
        for payload in batch.column("payload"):
            words, pairs, contexts, _, places, n = A.unpack(payload.as_buffer())
            yield A.rows(_BIGRAM, word=np.repeat(words, pairs).view(np.int64), context=contexts[places].view(np.int64), n=n.astype(np.int64))


_CONTEXT = pa.schema([("id", pa.int64())] + [(c, pa.int64()) for c in _COUNTS])


def _contexts(batches):
    for batch in batches:
        for payload in batch.column("payload"):
            _, _, contexts, n0, places, n = A.unpack(payload.as_buffer())
            yield A.rows(_CONTEXT, id=contexts.view(np.int64), n0=n0, **_by_context(places, n.astype(np.int64), len(contexts)))


def unigrams(table: DataFrame) -> DataFrame:
    """(word, n): how often each word, by its hash, is in the training texts."""
    counted = table.filter("kind = 'unigram'").select("payload").mapInArrow(_unigrams, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def bigrams(table: DataFrame) -> DataFrame:
    """(word, context, n): how often each word follows another one there; every pair lies in one part."""
    return table.filter("kind = 'bigram'").select("payload").mapInArrow(_bigrams, "word long, context long, n long")


def backoff(table: DataFrame, hot: DataFrame, d: list[float], total: int, kinds: int) -> DataFrame:
    """(id, c, alpha) of each context seen in training."""
    lacking = table.filter("kind = 'hotcontext'").select("id", F.col("doc").alias("word")).join(hot, "word").select(
        "id", (F.col("c") + 1).alias("n0"), *[F.lit(0).cast("long").alias(c) for c in _COUNTS[1:]])
    of_pairs = table.filter("kind = 'bigram'").select("payload").mapInArrow(
        _contexts, ", ".join(["id long"] + [f"{c} long" for c in _COUNTS]))
    sums = table.filter("kind = 'context'").select("id", *_COUNTS).unionByName(of_pairs).unionByName(lacking).groupBy("id").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    c, mass = F.col("n7"), F.col("n7") - F.lit(LARGE_DISCOUNT) * F.col("n6")
    for r in range(1, TOP + 1):
        c = c + r * F.col(f"n{r}")
        mass = mass + F.lit(r * d[r - 1]) * F.col(f"n{r}")
    lower = F.lit(1.0) - F.col("n0") / F.lit(float(total + kinds + 1))
    return sums.select("id", c.alias("c"), ((F.lit(1.0) - mass / c) / lower).alias("alpha"))


def score(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_counts: bool = True,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """Each row's (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    work = WorkTables(docs.sparkSession)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    out = held_out(F.col(f"`{doc_id}`"))
    # Rows of equal id and text share a key; their sums are divided by their number.
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), t.alias("text"), out.alias("held_out"),
                        (~out).alias("_train"), F.xxhash64(F.col(f"`{doc_id}`").cast("string"), t).alias("_key"))
    table = model(keyed, work, "text", "doc_id", keep_counts, part_bytes)
    stats = table.filter("kind = 'stats'").agg(*[F.sum(c).alias(c) for c in _COUNTS]).first()
    hot = work.write(table.filter("kind = 'hot'").groupBy(F.col("id").alias("word")).agg(F.sum("n0").alias("c")), "katz-hot")
    more_total, more_kinds = hot.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long"))).first()
    total, kinds = (stats["n0"] or 0) + (more_total or 0), (stats["n7"] or 0) + (more_kinds or 0)
    d = discounts([stats[f"n{i}"] or 0 for i in range(1, TOP + 2)])
    train_rows = keyed.filter("_train").count()
    weights = backoff(table, hot, d, total, kinds)
    norm = F.lit(math.log10(total + kinds + 1))
    # All that is known of a document, part by part, as four numbers: tokens, known
    # ones, and the two logarithms as far as they do not depend on the totals.
    seen = F.col("big") + F.col("low") - F.col("n0") * norm - F.col("context")
    for r in range(1, TOP + 1):
        seen = seen + F.col(f"n{r}") * F.lit(math.log10(d[r - 1] * r))
    by_part = table.filter("kind = 'doc'")
    # A document has a row in nearly every part; a task that reads several parts adds them up before the shuffle.
    by_part = by_part.coalesce(max(1, by_part.rdd.getNumPartitions() // 4))
    of_parts = by_part.select(
        "id", F.col("n6").alias("tokens"), F.col("n7").alias("known"), F.col("base"), seen.alias("model"))
    nothing = F.lit(0).cast("long")
    of_contexts = table.filter("kind = 'unseen'").select("id", "doc", "n0").join(weights, "id").select(
        F.col("doc").alias("id"), nothing.alias("tokens"), nothing.alias("known"), F.lit(0.0).alias("base"),
        (F.col("n0") * (F.log10("c") + F.log10("alpha"))).alias("model"))
    plus = F.log10(F.col("c") + 1)
    alone = F.when((F.col("c") > 0) & (F.col("word") != F.lit(int(END.view(np.int64)))), F.log10("c")).otherwise(0.0)
    of_hot = table.filter("kind = 'hotdoc'").select("id", F.col("doc").alias("word"), "n0", "n1").join(hot, "word").select(
        "id", nothing.alias("tokens"), F.when(F.col("c") > 0, F.col("n0")).otherwise(nothing).alias("known"),
        (F.col("n0") * plus).alias("base"), (F.col("n1") * plus - F.col("n0") * alone).alias("model"))
    sums = of_parts.unionByName(of_contexts).unionByName(of_hot).groupBy("id").agg(
        *[F.sum(c).alias(c) for c in ("tokens", "known", "base", "model")])
    same = keyed.groupBy("_key").agg(F.count("*").alias("rows"))
    first = F.lit(math.log10(train_rows) if train_rows else 0.0)
    known = sums.join(same, F.col("id") == F.col("_key")).select(
        "_key", (F.col("tokens") / F.col("rows")).cast("long").alias("n_tokens"),
        (F.col("known") / F.col("rows")).cast("long").alias("n_known"),
        ((F.col("base") - F.col("tokens") * norm) / F.col("rows")).alias("base_score"),
        (F.col("model") / F.col("rows") - first).alias("score"))
    return keyed.select("doc_id", "held_out", "_key").join(known, "_key").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
