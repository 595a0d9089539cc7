"""Importance resampling towards a target corpus.

Features are runs of consecutive words, hashed to buckets. Both corpora are counted
once into an array of buckets, which gives each bucket a gain: the logarithm of how
much more frequent it is in the target. A document's weight is the mean gain of its
features; Gumbel noise from its id makes the highest scores a draw without replacement
in proportion to the weights. The order of the scores comes from a distributed radix
sort, so every rank is known without any task seeing all rows.

What tasks send for the counts are arrays of at most ``buckets`` numbers, summed before
and after the shuffle; the driver holds one such array, whatever the corpus.

Defined cases: null and empty texts have no features and weight 0; texts of any length
are used whole; repeated rows each have a row and a rank of their own; ties go to the
smaller doc_id, then by the order of reading (rows of one id and score differ at most
in ``n_features``); a null doc_id has the noise of an empty one and comes last among
equal scores; an empty table gives an empty table, and an empty target counts nothing;
only the text and the id are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.llm import arrays as A
from codequarry.llm.radix import Key, ranks
from codequarry.llm.tables import WorkTables

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

# Bytes of words: ASCII letters (A-Z lower-cased), ASCII digits, all that is not ASCII.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def plain(text: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and a blank for all that is in no word."""
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = data.to_pybytes()[offsets[0]:offsets[-1]] if data is not None else b""
    body = pa.py_buffer(data.translate(_WORD_BYTES))
    return pa.Array.from_buffers(pa.large_string(), len(text), [None, pa.py_buffer((offsets - offsets[0]).tobytes()), body])


def features(text: pa.Array, buckets: int, runs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its document, words of each document) of runs of 1 to ``runs`` words."""
    words, codes, offsets = A.word_codes(plain(text))
    n_words = np.diff(offsets)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    single = [w.encode() for w in words.to_pylist()]
    names, gram, of, found, owners = single, codes, doc, [], []
    for k in range(1, runs + 1):
        if k > 1:
            # Runs of k words: each run of k - 1 and the word behind it, inside one document.
            inside = of[:-1] == doc[k - 1:] if len(of) > 1 else np.zeros(0, bool)
            both = gram[:-1][inside].astype(np.int64) * max(1, len(single)) + codes[k - 1:][inside]
            of = of[:-1].copy()
            of[~inside] = -1
            some, at = np.unique(both, return_inverse=True)
            names = [names[x // len(single)] + b" " + single[x % len(single)] for x in some.tolist()]
            gram = np.zeros(len(of), np.int64)
            gram[inside] = at
        bucket = np.fromiter((zlib.crc32(x) % buckets for x in names), np.int64, len(names))
        real = of >= 0
        found.append(bucket[gram[real]] if len(names) else np.zeros(0, np.int64))
        owners.append(of[real])
    return np.concatenate(found), np.concatenate(owners), n_words


_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])


def _counted(buckets: int, runs: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in A.sliced(batches):
            total += np.bincount(features(batch.column(0), buckets, runs)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield A.rows(_COUNTS, bucket=some, n=total[some])
    return run


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, runs: int = 1) -> np.ndarray:
    """Features in each bucket: one array of fixed size."""
    parts = docs.select(F.col(f"`{text}`")).mapInArrow(_counted(buckets, runs), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over that in the corpus."""
    s, t, size = own.astype(float), target.astype(float), float(len(own))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


_WEIGHED = pa.schema([("doc_id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64())])


def _weighed(gain: np.ndarray, runs: int):
    def run(batches):
        for batch in A.sliced(batches):
            bucket, doc, n_words = features(batch.column(1), len(gain), runs)
            n = np.bincount(doc, minlength=batch.num_rows)
            at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=batch.num_rows))])
            order = np.argsort(doc, kind="stable")
            sums = np.concatenate([[0], np.cumsum(gain[bucket][order])])
            total = sums[at[1:]] - sums[at[:-1]]  # whole numbers, exact
            yield A.rows(_WEIGHED, doc_id=batch.column(0), n_features=n, n_words=n_words,
                         weight=np.where(n > 0, total // np.maximum(n, 1), 0))
    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a standard Gumbel draw) that depends on the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT,
    least_words: int = LEAST_WORDS, buckets: int = BUCKETS, runs: int = 1, seed: int = SEED, share_rows: int | None = None,
) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of each row; undrawn ones have no rank.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn.
    """
    work = WorkTables(docs.sparkSession)
    gain = gains(bucket_counts(docs, text, buckets, runs), bucket_counts(target, text, buckets, runs))
    wanted = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    weighed = wanted.mapInArrow(_weighed(gain, runs), "doc_id long, n_features long, n_words long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = work.write(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scored")
    able = scored.filter(F.col("n_words") >= least_words).select("row", "score", "doc_id")
    drawn = able.count() * percent // 100
    order = ranks(able, [Key("score", False), Key("doc_id")], work, "importance-rank", share_rows)
    taken = order.filter(F.col("rank") <= drawn).select("row", "rank")
    return scored.join(taken, "row", "left").select("doc_id", "n_features", "n_words", "weight", "score", "rank")
