"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Runs of three words of the test items are counted over all documents. A rare run, one
for a thousand documents at most, is a seed; each item is also cut into short
stretches, and the rarest run that starts in a stretch is a seed however common it is,
so every item has seeds along its whole length. Where a seed stands in a document, the words around it, as many as
the item and some more, are aligned with the item: +1 for an equal word, less for a
changed, left-out or added one. The score is the best local alignment by the number
of the item's words: 1 for a whole copy, lower with every edit.

Seeds and items travel to the tasks in shares of a bounded size, one share after the
other, so both passes over the documents are narrow, nothing is shuffled but the
seeds' counts, and a document is dealt with in the task that reads it.

Words are runs of ASCII letters and digits (A-Z lower-cased) and all other
characters; other ASCII characters separate them.

Defined cases: null and empty texts match nothing; an item of fewer words than a
seed matches nothing; several equal items all match; very long texts are searched
whole; rows are dealt with one by one, so repeated rows have equal results; without
documents or without items nothing is found; columns of other names stay (the result
column is added or replaced).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.tables import others, restored

SEED = 3
STRETCH = 4
RARE, RARE_SHARE = 100, 1000  # a run is rare up to 100 places, or one for 1000 documents
THRESHOLD = 0.5
CHANGE, GAP = -0.5, -0.5
SHARE_BYTES = 8 << 20  # of item texts

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


class Items:
    """A share of test items as word numbers, with their runs of SEED words."""

    def __init__(self, rows):
        self.ids = [r[0] for r in rows]
        split = [words_of(r[1]) for r in rows]
        vocabulary: dict[bytes, int] = {}
        self.words = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in ws], np.int64) for ws in split]
        self.vocabulary = vocabulary
        self.base = len(vocabulary) + 1
        if self.base ** SEED >= 1 << 63:
            raise ValueError("a share of the items has too many different words")
        runs = [self.code(w, np.arange(max(0, len(w) - SEED + 1))) for w in self.words]
        self.runs = np.unique(np.concatenate([np.zeros(0, np.int64), *runs]))
        self.at = [np.searchsorted(self.runs, r) for r in runs]

    def code(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        total = np.zeros(len(starts), np.int64)
        for k in range(SEED):
            total = total * self.base + words[starts + k]
        return total

    def seeds(self, counts: np.ndarray, rare: int) -> dict[int, list[tuple[int, int]]]:
        """Run → (item, offset) of the runs chosen: rare ones, and the rarest of each stretch."""
        out = defaultdict(list)
        for item, runs in enumerate(self.at):
            for start in range(0, len(runs), STRETCH):
                piece = counts[runs[start:start + STRETCH]]
                for offset in {int(piece.argmin()), *np.flatnonzero(piece <= rare).tolist()}:
                    out[int(runs[start + offset])].append((item, start + offset))
        return dict(out)

    def places(self, text: pa.Array):
        """(word numbers, first word of each text, places of runs, the runs there)."""
        plain = pa.array([t.encode().translate(_TO_WORDS) if t else b"" for t in text.to_pylist()], pa.large_binary())
        words, codes, offsets = A.word_codes(plain.cast(pa.large_string()))
        known = self.vocabulary
        number = np.fromiter((known.get(w.encode(), 0) for w in words.to_pylist()), np.int64, len(words))
        number = number[codes] if len(words) else np.zeros(0, np.int64)
        if len(number) < SEED or not len(self.runs):
            return number, offsets, np.zeros(0, np.int64), np.zeros(0, np.int64)
        all_known = number[:len(number) - SEED + 1] > 0
        for k in range(1, SEED):
            all_known = all_known & (number[k:len(number) - SEED + 1 + k] > 0)
        ends = offsets[1:-1]
        for k in range(1, SEED):  # not across two texts
            cross = ends - k
            all_known[cross[(cross >= 0) & (cross < len(all_known))]] = False
        at = np.flatnonzero(all_known)
        code = self.code(number, at)
        run = np.minimum(np.searchsorted(self.runs, code), len(self.runs) - 1)
        hit = self.runs[run] == code
        return number, offsets, at[hit], run[hit]


def align(item: np.ndarray, words: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: (score, first and last word of ``words`` in it).

    One vector step for each word of the item; gaps along the row follow from a
    running maximum, as their cost is linear.
    """
    n = len(words)
    steps = np.arange(n + 1) * -GAP
    row = np.zeros(n + 1)
    rows = [row]
    for word in item:
        best = np.maximum(row + GAP, 0.0)
        best[1:] = np.maximum(best[1:], row[:-1] + np.where(words == word, 1.0, CHANGE))
        row = np.maximum.accumulate(best + steps) - steps
        rows.append(row)
    table = np.stack(rows)
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, last = float(table[i, j]), int(j) - 1
    # Back along the steps that gave each value.
    while i > 0 and j > 0 and table[i, j] > 1e-9:
        step = 1.0 if words[j - 1] == item[i - 1] else CHANGE
        if abs(table[i, j] - (table[i - 1, j - 1] + step)) < 1e-9:
            i, j = i - 1, j - 1
        elif abs(table[i, j] - (table[i - 1, j] + GAP)) < 1e-9:
            i -= 1
        else:
            j -= 1
    return score, int(j), last


def _passages(items: Items, seeds, at, run, length: int):
    """(item, start, end): merged surroundings of an item's seeds in one text."""
    spans: dict[int, list[list[int]]] = {}
    for place, found in zip(at.tolist(), run.tolist()):
        for item, offset in seeds.get(found, ()):
            n = len(items.words[item])
            low, high = max(0, place - offset - n // 2), min(length, place - offset + n + n // 2)
            mine = spans.setdefault(item, [])
            if mine and low <= mine[-1][1]:
                mine[-1][0], mine[-1][1] = min(low, mine[-1][0]), max(high, mine[-1][1])
            else:
                mine.append([low, high])
    for item, mine in spans.items():
        for low, high in mine:
            yield item, low, high


_LEAK = pa.struct([
    ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
_LEAKS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType())]))


def leaks_of(items: Items, seeds, words: np.ndarray, at, run, threshold: float) -> list[dict]:
    """The best passage of each item that reaches the threshold, in one text."""
    best: dict[int, tuple[float, int, int]] = {}
    for item, low, high in _passages(items, seeds, at, run, len(words)):
        wanted, piece = items.words[item], words[low:high]
        # Each equal word counts one at most: no alignment can score above their number.
        if np.isin(wanted, piece).sum() < threshold * len(wanted):
            continue
        # A run of seeds may join many copies: overlapping pieces keep the table small.
        size = 4 * len(wanted)
        for start in range(0, max(1, len(piece) - 2 * len(wanted)), size - 2 * len(wanted)):
            score, first, last = align(wanted, piece[start:start + size])
            score /= len(wanted)
            if score >= threshold and score > best.get(item, (0.0,))[0]:
                best[item] = (score, low + start + first, low + start + last)
    return [{"item_id": items.ids[i], "score": s, "first_word": a, "last_word": b} for i, (s, a, b) in sorted(best.items())]


def _counting(shared):
    def run(batches):
        items = shared.value
        total, n = np.zeros(len(items.runs), np.int64), 0
        for batch in A.sliced(batches):
            n += batch.num_rows
            total += np.bincount(items.places(batch.column(0))[3], minlength=len(total))
        some = np.flatnonzero(total)
        # The last row counts the documents.
        yield pa.RecordBatch.from_arrays([
            pa.array([*some.tolist(), len(items.runs)], pa.int64()), pa.array([*total[some].tolist(), n], pa.int64())], ["run", "n"])
    return run


def _finding(shared, threshold: float):
    def run(batches):
        items, seeds = shared.value
        chosen = np.zeros(len(items.runs) + 1, bool)
        chosen[list(seeds)] = True
        for batch in A.sliced(batches):
            number, offsets, at, found = items.places(batch.column(1))
            keep = chosen[found]
            at, found = at[keep], found[keep]
            cuts = np.searchsorted(at, offsets)
            leaks = batch.column(2).to_pylist()
            for i in np.unique(np.searchsorted(offsets, at, side="right") - 1):
                a, b = cuts[i], cuts[i + 1]
                leaks[i] = leaks[i] + leaks_of(
                    items, seeds, number[offsets[i]:offsets[i + 1]], at[a:b] - offsets[i], found[a:b], threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(leaks, pa.list_(_LEAK))], ["row", "t", "leaks"])
    return run


def find(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", share_bytes: int = SHARE_BYTES, into: str = "leaks",
) -> DataFrame:
    """``docs`` plus an array of (item_id, score, first_word, last_word), one for each item found."""
    spark = docs.sparkSession
    named = items.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text"))
    size = named.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    shares = max(1, -(-size // share_bytes))
    out = docs.select(others(docs, text, into).alias("row"), F.col(f"`{text}`").alias("t"), F.array().cast(_LEAKS).alias("leaks"))
    texts = out.select("t")
    schema = T.StructType([out.schema["row"], T.StructField("t", T.StringType()), T.StructField("leaks", _LEAKS)])
    for share in range(shares):
        mine = named.filter(F.pmod(F.xxhash64("id", "text"), F.lit(shares)) == share)
        held = Items(sorted(mine.collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
        counts = np.zeros(len(held.runs) + 1, np.int64)
        counted = texts.mapInArrow(_counting(spark.sparkContext.broadcast(held)), "run long, n long")
        for row in counted.groupBy("run").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[row["run"]] = row["n"]
        sent = spark.sparkContext.broadcast((held, held.seeds(counts, max(RARE, int(counts[-1]) // RARE_SHARE))))
        out = out.mapInArrow(_finding(sent, threshold), schema)
    return out.select(*restored(docs, text, F.col("t"), "row", into), F.col("leaks").alias(into))


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` without those that hold an item."""
    return find(docs, items, threshold, text, into="_leaks").filter(F.size("_leaks") == 0).drop("_leaks")
