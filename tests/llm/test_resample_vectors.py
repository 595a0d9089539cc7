"""Importance resampling and near vectors against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from codequarry.llm import importance, nearvectors
from codequarry.llm.radix import Key, ranks
from codequarry.llm.tables import WorkTables

from .conftest import lower


def grams(text, runs):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text).encode())
    return words, [b" ".join(words[i:i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)]


def resampled(docs, target, percent, least, buckets, runs):
    own, other = [0] * buckets, [0] * buckets
    for counts, texts in ((own, [t for _, t in docs]), (other, target)):
        for text in texts:
            for g in grams(text, runs)[1]:
                counts[zlib.crc32(g) % buckets] += 1
    S, T = sum(own), sum(other)
    gain = [math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(own, other)]
    out = []
    for i, text in docs:
        words, found = grams(text, runs)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(found), len(words), weight, score))
    able = sorted((o for o in out if o[2] >= least), key=lambda o: (-o[4], o[0] is None, o[0]))
    drawn = able[:len(able) * percent // 100]
    return out, drawn


@pytest.mark.parametrize("runs,percent,share", [(1, 10, None), (2, 60, 7), (3, 100, 16)])
def test_resample(spark, odd, odd_rows, runs, percent, share):
    bench = spark.createDataFrame([(1, "the of and abc"), (2, None), (3, "x|y the OF")], "item_id long, text string")
    got = importance.resample(odd, bench, percent=percent, least_words=5, buckets=97, runs=runs, share_rows=share).collect()
    want, drawn = resampled([(a, b) for a, b, _ in [r[:3] for r in odd_rows]], ["the of and abc", None, "x|y the OF"], percent, 5, 97, runs)
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(d[0], d[4]) for d in drawn]


def test_resample_of_nothing(spark, none, odd):
    empty = spark.createDataFrame([], "text string")
    assert importance.resample(none, empty).count() == 0
    assert importance.resample(odd, empty).count() == odd.count()


@pytest.mark.parametrize("low,high", [(0, 5), (-(1 << 63), (1 << 63) - 1), (-9, -9), (1 << 40, (1 << 40) + 5000)])
def test_radix_ranks(spark, low, high):
    rnd = np.random.default_rng(5)
    rows = [(i, int(rnd.integers(low, high, endpoint=True)) if i % 50 else None, i % 3) for i in range(700)]
    df = spark.createDataFrame(rows, "row long, a long, b long").repartition(5)
    out = ranks(df, [Key("b", False), Key("a")], WorkTables(spark), "test-rank", 64).collect()
    order = sorted(out, key=lambda r: r["rank"])
    assert [r["rank"] for r in order] == list(range(1, 701))
    keys = [(-r.b, r.a is None, r.a or 0) for r in order]
    assert keys == sorted(keys)
    assert ranks(df.filter("false"), [Key("a")], WorkTables(spark), "test-rank").count() == 0


def linked(ids, vectors, threshold):
    n, degree, parent = len(vectors), [0] * len(vectors), list(range(len(vectors)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    real = [i for i, v in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for width in {len(vectors[i]) for i in real}:
        mine = [i for i in real if len(vectors[i]) == width]
        u = np.array([vectors[i] for i in mine], np.float64)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        near = u @ u.T >= threshold
        np.fill_diagonal(near, False)
        for x, i in enumerate(mine):
            degree[i] = int(near[x].sum())
            for y in np.flatnonzero(near[x]):
                parent[root(i)] = root(mine[y])
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return sorted(((ids[i], degree[i], least.get(root(i)), ids[i] == least.get(root(i))) for i in range(n)), key=str)


@pytest.mark.parametrize("width,noise,threshold,cell_rows", [(64, 0.06, 0.95, 8192), (64, 0.06, 0.95, 60), (33, 0.2, 0.9, 8192), (3, 0.3, 0.99, 100)])
def test_near_vectors(spark, width, noise, threshold, cell_rows):
    rnd = np.random.default_rng(width)
    base = rnd.standard_normal((150, width))
    copies = base[rnd.integers(0, 9, 250)] + noise * rnd.standard_normal((250, width)) * rnd.random((250, 1))
    vectors = [list(map(float, v)) for v in np.concatenate([base, copies]).astype(np.float32)]
    vectors += [vectors[0]] * 150 + [[2 * x for x in vectors[0]], [-x for x in vectors[0]]]
    vectors += [None, [], [0.0] * width, [math.nan] + [1.0] * (width - 1), [None] * width, [math.inf] * width, [1.0] * (width + 1)]
    ids = list(range(len(vectors)))
    ids[3], ids[-1], ids[8] = None, None, 9
    rows = list(zip(ids, vectors, ["x"] * len(ids), [0] * len(ids)))
    want = linked(ids, vectors, threshold)
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, key string, n_links int").repartition(4)
        got = sorted((tuple(r) for r in nearvectors.join(df, threshold, cell_rows=cell_rows).collect()), key=str)
        assert got == want
    assert sum(w[1] for w in want) > 150 * 149


def test_near_vectors_meet_in_waves(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    base = rnd.standard_normal((300, 64))
    vectors = [list(map(float, v)) for v in np.concatenate([base, base[:200] + 0.05 * rnd.standard_normal((200, 64))])]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(3)
    moved, pairs = [], nearvectors._pairs
    monkeypatch.setattr(nearvectors, "_pairs", lambda *a: moved.append(pairs(*a)) or moved[-1])
    bytes_of = lambda: [x.agg(F.sum(F.octet_length("payload"))).first()[0] or 0 for x in moved]
    want = linked(range(500), vectors, 0.95)
    assert sorted((tuple(r) for r in nearvectors.join(df, cell_rows=20).collect()), key=str) == want
    whole = sum(bytes_of())
    moved.clear()
    assert sorted((tuple(r) for r in nearvectors.join(df, cell_rows=20, wave_bytes=1).collect()), key=str) == want
    # Crowded cells move many copies of the vectors, but few of them at a time.
    each = bytes_of()
    assert len(each) > 5 and whole > 10 * 500 * 64 * 8 and max(each) < whole / 3


def test_pairs_meet_once_in_the_grid():
    rnd = np.random.default_rng(2)
    y = rnd.standard_normal((400, 3)) * 0.3
    reach = 0.11
    cell = np.floor(y / (2 * reach)).astype(np.int32)
    cells = {}
    for k, (rows, at) in enumerate(nearvectors._neighbours(y, cell, 2 * reach, reach)):
        for r, c in zip(rows.tolist(), at.tolist()):
            cells.setdefault(tuple(c), []).append((r, k == 0))
    met = {}
    for members in cells.values():
        for x, home in members:
            for z, other in members:
                if x < z and (home or other):
                    met[x, z] = met.get((x, z), 0) + 1
    close = {(a, b) for a in range(400) for b in range(a + 1, 400) if np.linalg.norm(y[a] - y[b]) <= reach}
    assert len(close) > 50 and close <= set(met) and set(met.values()) == {1}


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    out = nearvectors.join(none)
    assert out.count() == 0 and out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert out.filter(F.col("kept")).count() == 0
