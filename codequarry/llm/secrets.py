"""Secret scans: named patterns, and sliding-window entropy over candidate strings.

Everything is built-in column functions: one narrow stage without Python. Spans are
code points, end exclusive. A pattern's places come from the pieces between matches.

Entropy: a candidate is a maximal run of one character class. A window slides over
it; the count of each character is kept in an array and changed by the character
that enters and the one that leaves, and with it the sum of c·log2(c). Those sums
are whole numbers (millionths of a bit), so no rounding builds up. A window is
suspicious when its Shannon entropy reaches the class's bound; the span reported
goes from the first suspicious window to the last one. Spans that the allow-list knows are
suppressed, as are candidates without what their class must hold (``Class.must``, a
digit: words and paths are long runs as well; of random strings of 24 letters and
digits about two in a hundred have none); spans of the named patterns never are.

Defined cases: null and empty texts have no spans; texts of any length are scanned
whole; rows are judged one by one, so repeated rows have equal results; an empty
table gives an empty table; columns of other names stay, the results go into one
struct column.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Patterns that decide results: fixed values.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

SCALE = 1_000_000


class Class(NamedTuple):
    """A character class: its alphabet, as code points and as a regular expression."""

    kind: str
    alphabet: str
    pattern: str
    window: int
    bits: float
    must: str  # what a candidate must hold besides


_LOWER = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    Class("entropy_hex", "0123456789abcdef", r"[0-9a-f]{20,}", 20, 3.0, r"[0-9]"),
    Class("entropy_upper", "0123456789" + _LOWER.upper(), r"[0-9A-Z]{20,}", 20, 3.5, r"[0-9]"),
    Class("entropy_base64", "0123456789" + _LOWER + _LOWER.upper() + "+/_-", r"[0-9A-Za-z+/_-]{24,}", 24, 3.75, r"[0-9]"),
)

# Candidates that hold one of these are examples or plain counting.
ALLOW = (r"(?i)example", r"(?i)0123456789", r"(?i)abcdefgh", r"^[0-9]+$", r"(?i)placeholder|changeme|xxxxxx")


def weight(count: int) -> int:
    """count · log2(count) in millionths of a bit."""
    return round(count * math.log2(count) * SCALE) if count > 1 else 0


def bound(c: Class) -> int:
    """The largest sum of weights at which a window's entropy reaches the class's bound."""
    return math.floor((math.log2(c.window) - c.bits) * c.window * SCALE)


def _places(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, whole, value>> of the leftmost, non-overlapping matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))
    # One more gap than matches: the text after the last.
    zipped = F.filter(zipped, lambda z: z["whole"].isNotNull())
    return F.get(F.transform(F.array(zipped), _positions), F.lit(0))


def _positions(zipped: Column) -> Column:
    """Matches with their places, which are running sums of lengths.

    An array that grows match by match is copied each time; so matches are taken in
    as many pieces as a piece has matches, and whole pieces are moved to their place.
    """
    kind = "array<struct<start:int,end:int,whole:string,value:string>>"
    size = F.greatest(F.ceil(F.sqrt(F.size(zipped))).cast("int"), F.lit(1))

    def step(acc, z):
        start = acc["at"] + F.char_length(z["gap"])
        end = start + F.char_length(z["whole"])
        one = F.struct(start.alias("start"), end.alias("end"), z["whole"].alias("whole"), z["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def within(number):
        first = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(F.slice(zipped, number * size + 1, size), first, step)

    def moved(pieces):
        starts = F.aggregate(pieces, F.array(F.lit(0)), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + p["at"])))
        return F.get(F.transform(F.array(starts), lambda s: F.flatten(F.transform(pieces, lambda p, i: F.transform(p["out"], lambda x: F.struct(
            (x["start"] + F.get(s, i)).alias("start"), (x["end"] + F.get(s, i)).alias("end"), x["whole"], x["value"]))))), F.lit(0))

    count = F.ceil(F.size(zipped) / size).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.get(F.transform(F.array(F.transform(numbers, within)), moved), F.lit(0))


def _spans(places: Column, kind: str, rank: int) -> Column:
    return F.transform(places, lambda p: F.struct(
        p["start"].alias("start"), F.lit(rank).alias("rank"), p["end"].alias("end"), F.lit(kind).alias("kind")))


_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _none() -> Column:
    return F.array().cast(_SPAN)


def _base(text: Column) -> list[Column]:
    lower = F.lower(text)
    named = F.lit(False)
    for word in WORDS:
        named = named | lower.contains(word)
    assign = F.filter(_places(text, ASSIGN, 2), lambda p: F.char_length(p["value"]) >= MIN_VALUE)
    access = F.filter(_places(text, ACCESS), lambda p: p["end"] - p["start"] >= MIN_ACCESS)
    # Runs are maximal, so shorter ones may be left out of the pattern itself.
    hexes = _places(text, HEX[:-1] + "{%d,}" % MIN_HEX)
    return [
        F.when(named, _spans(assign, KINDS[0], 0)).otherwise(_none()),
        F.when(text.contains("AKIA"), _spans(access, KINDS[1], 1)).otherwise(_none()),
        F.when(text.rlike(HEX[:-1] + "{%d}" % MIN_HEX), _spans(hexes, KINDS[2], 2)).otherwise(_none()),
    ]


def _window_span(value: Column, c: Class) -> Column:
    """struct<first, last>: starts of the first and last suspicious window, -1 if none."""
    weights = F.array(*[F.lit(weight(n)).cast("long") for n in range(c.window + 2)])
    letters = F.filter(F.split(value, ""), lambda ch: ch != "")
    codes = F.transform(letters, lambda ch: F.instr(F.lit(c.alphabet), ch) - 1)
    zero = F.array_repeat(F.lit(0), len(c.alphabet))
    start = F.struct(
        zero.alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("at"),
        F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    # Each step knows the character that enters and, once the window is full, the one that leaves.
    gone = F.concat(F.array_repeat(F.lit(-1), c.window), codes)
    steps = F.filter(F.arrays_zip(codes.alias("enters"), gone.alias("leaves")), lambda s: s["enters"].isNotNull())

    def step(acc, s):
        enters, leaves, counts = s["enters"], s["leaves"], acc["counts"]
        old_in = F.get(counts, enters)
        old_out = F.get(counts, leaves)
        gain = F.get(weights, old_in + 1) - F.get(weights, old_in)
        loss = F.when(leaves >= 0, F.get(weights, old_out) - F.get(weights, old_out - 1)).otherwise(F.lit(0).cast("long"))
        total = F.when(enters == leaves, acc["sum"]).otherwise(acc["sum"] + gain - loss)
        now = F.transform(counts, lambda n, j: n + (j == enters).cast("int") - (j == leaves).cast("int"))
        at = acc["at"] + 1
        hit = (at >= c.window) & (total <= bound(c))
        return F.struct(
            now.alias("counts"), total.alias("sum"), at.alias("at"),
            F.when(hit & (acc["first"] < 0), at - c.window).otherwise(acc["first"]).alias("first"),
            F.when(hit, at - c.window).otherwise(acc["last"]).alias("last"))

    return F.aggregate(steps, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def _entropy(text: Column, c: Class, rank: int, allow) -> Column:
    candidates = F.filter(_places(text, c.pattern), lambda p: p["whole"].rlike(c.must))
    judged = F.transform(candidates, lambda p: F.struct(
        p["start"].alias("start"), p["whole"].alias("whole"), _window_span(p["whole"], c).alias("w")))

    def wanted(p):
        span = F.substring(p["whole"], p["w"]["first"] + 1, p["w"]["last"] - p["w"]["first"] + c.window)
        ok = p["w"]["first"] >= 0
        for pattern in allow:
            ok = ok & ~span.rlike(pattern)
        return ok

    found = F.transform(F.filter(judged, wanted), lambda p: F.struct(
        (p["start"] + p["w"]["first"]).alias("start"), F.lit(rank).alias("rank"),
        (p["start"] + p["w"]["last"] + c.window).alias("end"), F.lit(c.kind).alias("kind")))
    return F.when(text.rlike(c.pattern), found).otherwise(_none())


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(
    docs: DataFrame, text: str = "text", classes=CLASSES, allow=ALLOW, into: str = "secrets",
) -> DataFrame:
    """``docs`` plus a struct: counts by kind, ``base`` and ``spans`` (arrays of spans), and both as text."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    step = docs.select(F.struct(*kept).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    t = F.col("t")
    step = step.select(
        "row", *[e.alias(f"base{i}") for i, e in enumerate(_base(t))],
        *[_entropy(t, c, len(KINDS) + i, allow).alias(f"more{i}") for i, c in enumerate(classes)])
    base = F.concat(*[F.col(f"base{i}") for i in range(len(KINDS))])
    every = F.concat(base, *[F.col(f"more{i}") for i in range(len(classes))])
    return step.select("row.*", F.struct(
        *[F.size(f"base{i}").cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.array_sort(base).alias("base"), F.array_sort(every).alias("spans"),
        _joined(base).alias("base_text"), _joined(every).alias("spans_text"),
    ).alias(into))


def redacted(docs: DataFrame, text: str = "text", label: str = "[secret]", classes=CLASSES, allow=ALLOW) -> DataFrame:
    """``docs`` with every span of the text replaced by ``label``."""
    scanned = scan(docs, text, classes, allow, "_found")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        gap = F.substring(t, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.concat(acc["out"], gap, F.when(fresh, F.lit(label)).otherwise(F.lit(""))).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate("_found.spans", start, step, lambda acc: F.concat(
        acc["out"], F.substring(t, acc["at"] + 1, F.char_length(t))))
    return scanned.withColumn(text, F.when(F.size("_found.spans") > 0, done).otherwise(F.col(f"`{text}`"))).drop("_found")
