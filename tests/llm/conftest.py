import random

import pytest

SCHEMA = "doc_id long, text string, source string, row string, t string, quality int, copies string"


def _words(rnd, n):
    return [rnd.choice("the of and to a in is that".split()) if rnd.random() < 0.3
            else "".join(rnd.choice("abcdeinorst") for _ in range(rnd.randrange(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, one very long text, ties, repeated rows, near copies, shared lines; seeded."""
    rnd = random.Random(3)
    rows = []
    for i in range(60):
        lines = [" ".join(_words(rnd, rnd.randrange(4, 30))) for _ in range(rnd.randrange(1, 8))]
        if i % 4 == 0:
            lines.insert(0, "  Shared Line of many\t")
        rows.append((i, "\n".join(lines), f"s{i % 5}"))
    near = _words(rnd, 120)
    for i in range(60, 72):
        changed = list(near)
        changed[rnd.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(changed), "hot"))
    long = _words(rnd, 30_000)
    rows += [(80, " ".join(long), "s1"), (81, " ".join(["same"] * 500), "s1"), (82, " ".join(long[:200] * 2), None),
             (83, None, "s2"), (84, "", None), (85, " \n\t ", "s0"), (86, "one", "s0"), (87, "One", "s0"),
             (88, "\n\n", "s0"), (None, "no id here at all", "s3"), (None, None, None),
             (90, "Été É x|y #1", "s4"), (91, "a" * 5000, "s4")]
    rows += [rows[0], rows[0], (5, "another text with the id of a known one", "s0"), rows[84 - 20]]
    return [(a, b, c, "r", "t", 1, "c") for a, b, c in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))


def split(text):
    """Runs of everything but ASCII white space."""
    return [w.decode() for w in (text or "").encode().split()]
