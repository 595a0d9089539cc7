"""License scans: fuzzy search for short notices.

A text is brought to words (A-Z lower-cased, words of ASCII letters and digits and
of all other characters) joined by single spaces. A notice with at most k edits,
cut into k+1 pieces, holds at least one piece unchanged, so exact places of the
pieces, all found in one pass of an automaton, give every candidate. Around each, in a
window of the notice's length and k characters on either side, the regex library's
bounded-error matching verifies the notice and counts its edits; so a text costs as much
as it has places of pieces, however long it is. The words that tell a notice from others
must stand in the place found: short ones as they are, those of five letters and more
with one edit at most. Where places overlap, the one with the fewest edits for its length
stays. Exact phrases are found besides, word by word.

Defined cases: null and empty texts have no words, no labels and score 0; texts of
any length are searched whole; each row stands alone, so repeated rows have equal
results; an empty table gives an empty table; columns of other names stay, the
results go into one struct column.
"""

from __future__ import annotations

import bisect
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.tables import others, restored

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Notice(NamedTuple):
    """A sentence, its label, and the words of it that must be there."""

    words: str
    label: str
    must: tuple[str, ...] = ()

    @property
    def edits(self) -> int:
        """One edit for each ten characters."""
        return max(1, len(self.words) // 10)

    def pieces(self) -> list[tuple[int, str]]:
        """(offset, piece): k+1 consecutive pieces of nearly equal length."""
        n, parts = len(self.words), self.edits + 1
        cuts = [i * n // parts for i in range(parts + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]


NOTICES = (
    Notice("licensed under the apache license version 2 0", "apache-2.0", ("apache",)),
    Notice("released under the apache license", "apache", ("apache",)),
    Notice("boost software license", "boost", ("boost",)),
    Notice("redistribution and use in source and binary forms", "bsd", ("binary",)),
    Notice("released under the bsd license", "bsd", ("bsd",)),
    Notice("licensed under the bsd license", "bsd", ("bsd",)),
    Notice("creative commons attribution", "cc-by", ("creative",)),
    Notice("licensed under cc by nc", "cc-by-nc", ("cc", "nc")),
    Notice("creative commons attribution noncommercial", "cc-by-nc", ("noncommercial",)),
    Notice("licensed under cc by nd", "cc-by-nd", ("cc", "nd")),
    Notice("creative commons attribution noderivatives", "cc-by-nd", ("noderivatives",)),
    Notice("licensed under cc by sa", "cc-by-sa", ("cc", "sa")),
    Notice("creative commons attribution sharealike", "cc-by-sa", ("sharealike",)),
    Notice("creative commons zero", "cc0", ("zero",)),
    Notice("common development and distribution license", "cddl", ("development",)),
    Notice("eclipse public license", "epl", ("eclipse",)),
    Notice("gnu affero general public license", "agpl", ("affero",)),
    Notice("gnu free documentation license", "gfdl", ("documentation",)),
    Notice("gnu general public license", "gpl", ("gnu", "general")),
    Notice("gnu lesser general public license", "lgpl", ("lesser",)),
    Notice("permission to use copy modify and or distribute this software", "isc", ("modify",)),
    Notice("permission is hereby granted free of charge to any person", "mit", ("charge",)),
    Notice("released under the mit license", "mit", ("mit",)),
    Notice("licensed under the mit license", "mit", ("mit",)),
    Notice("mozilla public license", "mpl", ("mozilla",)),
    Notice("python software foundation license", "psf", ("python",)),
    Notice("dedicated to the public domain", "public-domain", ("domain",)),
    Notice("all rights reserved", "reserved", ("rights",)),
    Notice("free and unencumbered software released into the public domain", "unlicense", ("unencumbered",)),
)

_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str | None) -> tuple[str, int]:
    """(words joined by single spaces, number of words)."""
    words = (text or "").encode().translate(_TO_WORDS).split()
    return b" ".join(words).decode(), len(words)


def phrase_places(joined: str, phrase: str) -> list[int]:
    """Indexes of the words at which the phrase's words stand consecutively."""
    if phrase not in joined:
        return []
    padded, wanted = f" {joined} ", f" {phrase} "
    out, at, word, seen = [], padded.find(wanted), 0, 0
    while at >= 0:
        word += padded.count(" ", seen, at)
        seen = at
        out.append(word)
        at = padded.find(wanted, at + 1)
    return out


class Searcher:
    """The pieces of all notices in one automaton, and a verifier for each notice."""

    def __init__(self, notices):
        self.notices = notices
        self.pieces = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for offset, piece in notice.pieces():
                found.setdefault(piece, []).append((i, offset))
        for piece, where in found.items():
            self.pieces.add_word(piece, (len(piece), where))
        if found:
            self.pieces.make_automaton()
        self.verify = [
            regex.compile(f"(?b)(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}") for n in notices]
        self.must = [[
            (word, regex.compile(f"(?:{regex.escape(word)}){{e<=1}}") if len(word) >= 5 else None) for word in n.must]
            for n in notices]

        # With one edit at most, one half of a word is unchanged.
        self.parts = [[
            (word,) if close is None else (word[:len(word) // 2], word[len(word) // 2:]) for word, close in pairs]
            for pairs in self.must]

    def windows(self, joined: str):
        """(notice, start, end): the surroundings of each piece found, once."""
        seen: set[tuple[int, int]] = set()
        if not self.notices:
            return
        for last, (size, where) in self.pieces.iter(joined):
            for i, offset in where:
                notice = self.notices[i]
                start = last - size + 1 - offset
                if (i, start) not in seen:
                    seen.add((i, start))
                    yield i, max(0, start - notice.edits), min(len(joined), start + len(notice.words) + notice.edits)

    def _has(self, i: int, words: list[str]) -> bool:
        """Whether the words that must be there are among ``words``."""
        return all(
            word in words or (close is not None and any(abs(len(w) - len(word)) < 2 and close.fullmatch(w) for w in words))
            for word, close in self.must[i])

    def find(self, joined: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits): verified places, characters of the joined words, from left to right."""
        found = set()
        for i, low, high in self.windows(joined):
            around = joined[max(0, low - 1):high + 1]
            if not all(any(part in around for part in parts) for parts in self.parts[i]):
                continue
            m = self.verify[i].search(joined, low, high)
            if m is None:
                continue
            start, end = m.span()
            # Words as they are in the text, also where the place cuts one.
            first, behind = joined.rfind(" ", 0, start + 1) + 1, joined.find(" ", max(start, end - 1))
            if self._has(i, joined[first:behind if behind >= 0 else len(joined)].split(" ")):
                found.add((i, start, end, sum(m.fuzzy_counts)))
        # The best first; what overlaps a better one goes.
        ranked = sorted(found, key=lambda f: (f[3] / len(self.notices[f[0]].words), -len(self.notices[f[0]].words), f[1], f[0]))
        out: list[tuple[int, int, int, int]] = []
        starts: list[int] = []
        for i, start, end, edits in ranked:
            at = bisect.bisect(starts, start)
            if (at == 0 or out[at - 1][2] <= start) and (at == len(out) or end <= out[at][1]):
                out.insert(at, (i, start, end, edits))
                starts.insert(at, start)
        return out


_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("edits", T.LongType())]))),
])

_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([
        ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))),
])


def scan_text(text: str | None, searcher: Searcher, phrases: dict[str, str]) -> dict:
    joined, n = plain(text)
    places, base = [], set()
    for phrase, label in phrases.items():
        if at := phrase_places(joined, phrase):
            places += at
            base.add(label)
    labels, score, spans, word, seen = set(base), 1.0 if base else 0.0, [], 0, 0
    for i, start, end, edits in searcher.find(joined):
        notice = searcher.notices[i]
        labels.add(notice.label)
        score = max(score, 1.0 - edits / len(notice.words))
        begin = start + (joined[start:start + 1] == " ")
        word += joined.count(" ", seen, begin)
        seen = begin
        last = word + joined.count(" ", begin, end - (joined[end - 1:end] == " "))
        spans.append({"label": notice.label, "first_word": word, "last_word": last, "edits": edits})
    return {
        "n_words": n, "n_base": len(places), "first_word": min(places, default=None),
        "last_word": max(places, default=None), "base_labels": sorted(base), "labels": sorted(labels), "score": score,
        "spans": sorted(spans, key=lambda s: (s["first_word"], s["last_word"], s["label"])),
    }


def scan(docs: DataFrame, text: str = "text", notices=NOTICES, phrases=None, into: str = "licence") -> DataFrame:
    """``docs`` plus one struct: words, exact phrase places, labels, score and spans of notices."""
    phrases = PHRASES if phrases is None else phrases
    shaped = docs.select(others(docs, text, into).alias("row"), F.col(f"`{text}`").alias("t"))

    def run(batches):
        searcher = Searcher(notices)
        for batch in A.sliced(batches):
            found = [scan_text(t, searcher, phrases) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW)], ["row", "t", "found"])

    schema = T.StructType([*shaped.schema.fields, T.StructField("found", _RESULT)])
    return shaped.mapInArrow(run, schema).select(
        *restored(docs, text, F.col("t"), "row", into), F.col("found").alias(into))
