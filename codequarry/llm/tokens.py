"""Edit-aware token counts: segment trees of pre-tokens, kept up with edits.

A byte-pair vocabulary encodes each pre-token of a text by itself, so a text's token
count is the sum over its pre-tokens. The tree of a document has a leaf for each
pre-token (its length and its tokens) and nodes of up to ``FAN`` children with their
sums. An edit descends to the leaves it touches, goes back ``BACK`` leaves for the
context that the pattern may look at, splits and encodes from there until the new
boundaries meet an old one behind the edit, and replaces those leaves; only the nodes
above them get new sums.

The pattern never looks behind a boundary, so all boundaries after such a meeting are
the old ones; it looks at most at a run of white space and one character ahead, which
``BACK`` leaves cover.

Defined cases: a null or empty text has no leaves and no tokens; edits of one text
must not overlap (an error names the text's edits), touch at most its length (ends
beyond are cut), and refer to the text before all of them; edits at one place are
made in their order; a null edit list is empty, a null replacement an empty string;
texts of any length are used whole; rows are dealt with one by one, so repeated rows
have equal results; an empty table gives an empty table; columns of other names stay,
the results go into one struct column.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry.llm import arrays as A
from codequarry.llm.tables import others, restored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FAN = 64
BACK = 4
CACHE = 500_000  # distinct pre-tokens remembered by a task

# White space as the vocabulary's own pattern means it. Fixed values.
_WS = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _WS + r"\p{L}\p{N}]+|[" + _WS + r"]+(?![^" + _WS + r"])|[" + _WS + r"]+")
LIBRARY_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("vocabulary", pat_str=LIBRARY_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Splits texts and counts the tokens of pre-tokens, remembering the counts."""

    def __init__(self, path: str = VOCABULARY):
        self.encode = encoding(path).encode_ordinary
        self.split = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = len(self.encode(piece))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def leaves(self, text: str) -> np.ndarray:
        """(length, tokens) of each pre-token: an array of two columns."""
        pieces = self.split.findall(text)
        return np.stack([np.fromiter(map(len, pieces), np.int64, len(pieces)), self.counts(pieces)], axis=1)


def _grouped(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(children, length, tokens) of the nodes over ``rows``, ``sizes`` children each."""
    if not len(sizes):
        return np.zeros((0, 3), np.int64)
    starts = np.cumsum(sizes) - sizes
    return np.column_stack([sizes, np.add.reduceat(rows[:, -2:], starts, axis=0)])


def _even(n: int) -> np.ndarray:
    """Sizes of nodes for n children, FAN at most and nearly equal."""
    if n == 0:
        return np.zeros(0, np.int64)
    nodes = -(-n // FAN)
    return np.diff(np.arange(nodes + 1) * n // nodes)


class Tree:
    """Levels of (children, length, tokens) from the leaves to the root."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    @classmethod
    def over(cls, leaves: np.ndarray) -> Tree:
        levels = [np.column_stack([np.ones(len(leaves), np.int64), leaves])]
        while len(levels[-1]) > FAN:
            levels.append(_grouped(levels[-1], _even(len(levels[-1]))))
        return cls(levels)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][:, 2].sum())

    @property
    def n_leaves(self) -> int:
        return len(self.levels[0])

    def find(self, offset: int) -> tuple[int, int]:
        """(leaf, its start) of the leaf that holds character ``offset``; past the end: the number of leaves."""
        node, start, last = 0, 0, len(self.levels[-1])
        for level in range(len(self.levels) - 1, -1, -1):
            ends = start + np.cumsum(self.levels[level][node:last, 1])
            at = int(np.searchsorted(ends, offset, side="right"))
            if at == len(ends):
                return self.n_leaves, int(ends[-1]) if len(ends) else start
            start = int(ends[at - 1]) if at else start
            node += at
            if level:
                # First child: the children of the nodes before it.
                first = int(self.levels[level][:node, 0].sum())
                last = first + int(self.levels[level][node, 0])
                node = first
        return node, start

    def replace(self, first: int, last: int, leaves: np.ndarray) -> None:
        """Put ``leaves`` in place of the leaves first … last - 1 and sum again above them only."""
        rows = np.column_stack([np.ones(len(leaves), np.int64), leaves]) if len(leaves) else np.zeros((0, 3), np.int64)
        for level in range(len(self.levels)):
            table = self.levels[level]
            self.levels[level] = np.concatenate([table[:first], rows, table[last:]])
            if level + 1 == len(self.levels):
                break
            above = self.levels[level + 1]
            if not len(above):
                rows, first, last = _grouped(self.levels[level], _even(len(self.levels[level]))), 0, 0
                continue
            ends = np.cumsum(above[:, 0])
            # Nodes with a replaced child; at a mere insertion, the one that takes it in.
            a = min(int(np.searchsorted(ends, first, side="right")), len(above) - 1)
            b = max(a, int(np.searchsorted(ends, last - 1, side="right")) if last > first else a)
            begin = int(ends[a - 1]) if a else 0
            held = int(ends[b]) - begin - (last - first) + len(rows)
            rows = _grouped(self.levels[level][begin:begin + held], _even(held))
            first, last = a, b + 1
        while len(self.levels[-1]) > FAN:
            self.levels.append(_grouped(self.levels[-1], _even(len(self.levels[-1]))))

    def pack(self) -> bytes:
        small = [level.astype(np.uint32 if level.size == 0 or level.max() < 1 << 32 else np.int64) for level in self.levels]
        return A.pack(np.array([len(x) for x in small], np.uint32), *[x[:, k] for x in small for k in range(3)])

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        _, *columns = A.unpack(data)
        return cls([np.stack(columns[k:k + 3], axis=1).astype(np.int64) for k in range(0, len(columns), 3)])


def edit(text: str, tree: Tree, start: int, end: int, put: str, encoder: Encoder) -> tuple[str, int]:
    """The edited text and the number of pre-tokens encoded; ``tree`` is brought up to date."""
    start, end = min(start, len(text)), min(max(start, end), len(text))
    new = text[:start] + put + text[end:]
    leaf, _ = tree.find(start)
    first = max(0, leaf - BACK)
    begin = int(tree.levels[0][:first, 1].sum()) if first else 0
    shift = len(put) - (end - start)
    safe = start + len(put)
    pieces, at = [], begin
    last, behind = tree.find(end)
    if behind < end:  # the boundary at or after the end of the edit
        behind += int(tree.levels[0][last, 1]) if last < tree.n_leaves else 0
        last = min(last + 1, tree.n_leaves)
    lengths = tree.levels[0][:, 1]
    for found in encoder.split.finditer(new, begin):
        if at >= safe:
            while last < tree.n_leaves and behind + shift < at:
                behind += int(lengths[last])
                last += 1
            if behind + shift == at:
                break
        pieces.append(found.group())
        at = found.end()
    else:
        last = tree.n_leaves
    leaves = np.stack([np.array([len(p) for p in pieces], np.int64), encoder.counts(pieces)], axis=1)
    tree.replace(first, last, leaves)
    return new, len(pieces)


_TREE = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("n_pretokens", T.LongType()), T.StructField("tree", T.BinaryType())])
_TREE_ARROW = pa.struct([("n_tokens", pa.int64()), ("n_pretokens", pa.int64()), ("tree", pa.binary())])


def build(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, into: str = "tokens") -> DataFrame:
    """``docs`` plus a struct: tokens, pre-tokens and the packed tree of each text."""
    shaped = docs.select(others(docs, text, into).alias("row"), F.col(f"`{text}`").alias("t"))

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in A.sliced(batches):
            out = []
            for t in batch.column(1).to_pylist():
                tree = Tree.over(encoder.leaves(t or ""))
                out.append({"n_tokens": tree.tokens, "n_pretokens": tree.n_leaves, "tree": tree.pack()})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, _TREE_ARROW)], ["row", "t", "out"])

    schema = T.StructType([*shaped.schema.fields, T.StructField("out", _TREE)])
    return shaped.mapInArrow(run, schema).select(
        *restored(docs, text, F.col("t"), "row", into), F.col("out").alias(into))


EDITS = "array<struct<start:bigint,end:bigint,put:string>>"
_EDITED = T.StructType([T.StructField("text", T.StringType()), *_TREE.fields, T.StructField("n_encoded", T.LongType())])
_EDITED_ARROW = pa.struct([("text", pa.string()), *_TREE_ARROW, ("n_encoded", pa.int64())])


def apply_edits(
    built: DataFrame, edits: str = "edits", text: str = "text", tokens: str = "tokens", vocabulary: str = VOCABULARY,
    into: str = "edited",
) -> DataFrame:
    """``built`` plus a struct: the edited text, its tokens, pre-tokens and tree, and how many pre-tokens were encoded.

    The column ``edits`` holds, for each row, (start, end, put): characters start … end - 1
    give way to ``put``.
    """
    shaped = built.select(others(built, text, into).alias("row"), F.col(f"`{text}`").alias("t"),
                          F.col(f"`{tokens}`.`tree`").alias("tree"), F.col(f"`{edits}`").cast(EDITS).alias("e"))

    def run(batches):
        encoder = Encoder(vocabulary)
        for batch in A.sliced(batches):
            out = []
            for t, packed, changes in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                t, tree, encoded = t or "", Tree.unpack(packed), 0
                changes = sorted(((max(0, c["start"]), c["end"], c["put"] or "") for c in changes or ()), key=lambda c: c[:2])
                for one, two in zip(changes, changes[1:]):
                    if two[0] < one[1]:
                        raise ValueError(f"edits overlap: {changes}")
                for start, end, put in reversed(changes):  # from the end, so that places stay valid
                    t, n = edit(t, tree, start, end, put, encoder)
                    encoded += n
                out.append({"text": t, "n_tokens": tree.tokens, "n_pretokens": tree.n_leaves, "tree": tree.pack(),
                            "n_encoded": encoded})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, _EDITED_ARROW)], ["row", "t", "out"])

    schema = T.StructType([shaped.schema["row"], shaped.schema["t"], T.StructField("out", _EDITED)])
    return shaped.mapInArrow(run, schema).select(
        *restored(built, text, F.col("t"), "row", into), F.col("out").alias(into))
