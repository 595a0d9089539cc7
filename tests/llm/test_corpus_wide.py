"""Operators that look at the whole corpus, against plain versions of their contracts."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from codequarry.llm import katz, lines, mixing, nearjoin, passages, tokens
from codequarry.llm.queries import QUERIES

from .conftest import SCHEMA, lower, split


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def plain_katz(rows):
    words, pairs, contexts = Counter(), Counter(), Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            p = "\r"
            for w in split(lower(t)) + ["\n"]:
                words[w] += 1
                pairs[p, w] += 1
                contexts[p] += 1
                p = w
    n, v, counts = sum(words.values()), len(words), Counter(pairs.values())
    d = katz.discounts([counts[i] for i in range(1, katz.TOP + 2)])
    low = lambda w: (words[w] + 1) / (n + v + 1)
    seen = defaultdict(list)
    for (p, w), r in pairs.items():
        seen[p].append((w, (d[r - 1] * r if r <= katz.TOP else r - katz.LARGE_DISCOUNT) / contexts[p]))
    alpha = {p: (1 - sum(x for _, x in s)) / (1 - sum(low(w) for w, _ in s)) for p, s in seen.items()}
    for p, s in list(seen.items())[:50]:  # each context's probabilities sum to one, the unknown word included
        known = {w for w, _ in s}
        rest = sum(low(w) for w in words if w not in known) + low("never seen")
        assert abs(sum(x for _, x in s) + alpha[p] * rest - 1) < 1e-9
    known = {p: dict(s) for p, s in seen.items()}
    out = []
    for doc, t in rows:
        p, score, base, hits, ws = "\r", 0.0, 0.0, 0, split(lower(t)) + ["\n"]
        for w in ws:
            score += math.log10(known.get(p, {}).get(w) or alpha.get(p, 1) * low(w))
            base += math.log10(low(w))
            hits += words[w] > 0
            p = w
        out.append((doc, doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2, len(ws), hits, n, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_bytes", [1 << 30, 20_000])
def test_katz(spark, odd, odd_rows, none, part_bytes, monkeypatch):
    # Small parts split frequent words; small shares split a part's contexts.
    monkeypatch.setattr(katz, "SHARE", 1 << 30 if part_bytes > 1 << 20 else 700)
    got = sorted((tuple(r) for r in katz.score(odd, part_bytes=part_bytes).collect()), key=str)
    want = plain_katz([(d, t) for d, t, *_ in odd_rows])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) <= 1e-9 * abs(w[5]) and abs(g[6] - w[6]) <= 1e-9 * abs(w[6])
    assert katz.score(none).count() == 0


@pytest.mark.parametrize("part_bytes", [1 << 30, 20_000])
def test_katz_query_stores_its_counts(spark, odd, odd_rows, tmp_path, part_bytes, monkeypatch):
    monkeypatch.setattr(katz, "SHARE", 1 << 30 if part_bytes > 1 << 20 else 700)
    monkeypatch.setattr(katz.score, "__defaults__", (*katz.score.__defaults__[:-1], part_bytes))
    stored, write = [], katz.WorkTables.partitioned
    monkeypatch.setattr(katz.WorkTables, "partitioned", lambda *a: stored.append(write(*a)) or stored[-1])
    odd.drop("row", "t", "quality", "copies").write.parquet(f"{tmp_path}/documents.parquet")
    QUERIES["op1_katz_scores"][0](spark, str(tmp_path)).collect()
    words, pairs = Counter(), Counter()
    number = lambda w: np.array([xxhash.xxh3_64_intdigest(w)], np.uint64).view(np.int64)[0]
    for d, t, *_ in odd_rows:
        if d is None or zlib.crc32(str(d).encode()) % 7 != 2:
            run = [number(w) for w in ["\r", *split(lower(t)), "\n"]]
            words.update(run[1:])
            pairs.update(zip(run[1:], run))
    assert {r.word: r.n for r in katz.unigrams(stored[0]).collect()} == words
    found = [tuple(r) for r in katz.bigrams(stored[0]).collect()]
    assert sorted(found) == sorted((w, p, n) for (w, p), n in pairs.items())


def test_katz_without_training(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = katz.score(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.score == row.base_score == 0.0


def plain_lines(rows, least_documents, least):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    often = Counter()
    for _, t in rows:
        often.update({k for k in map(key, (t or "").split("\n")) if len(k) >= least})
    drop = {k for k, n in often.items() if n >= least_documents}
    out = []
    for d, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if key(x) not in drop]
        out.append((d, len(every), len(every) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [lines.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("least", [1, 30])
def test_lines(odd, odd_rows, none, small, least):
    got = lines.dedup_lines(odd, 10 if least == 1 else 2, least, broadcast_bytes=small)
    assert got.columns == odd.columns + ["n_lines", "n_dropped"]
    found = sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.text)) for r in got.collect()), key=str)
    assert found == plain_lines([(d, t) for d, t, *_ in odd_rows], 10 if least == 1 else 2, least)
    assert lines.dedup_lines(none, broadcast_bytes=small).count() == 0


def test_first_line_stays(spark):
    rows = [(3, "A\nb"), (1, "x\na\nA"), (2, "a"), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.dedup_lines(df, 2, keep_first=True).collect()}
    assert got == {3: "b", 1: "x\na", 2: "", None: ""}


def test_bloom_never_misses():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    bloom = lines._Bloom(lines._bits_of(len(hashes)))
    bloom.add(hashes)
    assert bloom.has(hashes).all()
    assert bloom.has(rng.integers(0, 1 << 63, 5000, dtype=np.uint64)).mean() < 0.05


def test_mix(odd, odd_rows, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    sizes = Counter()
    for _, t, s, *_ in odd_rows:
        sizes[s] += len(split(t))
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, total, target = set(order), sum(sizes.values()), {}
    while True:  # share by weight; who is above stops, the excess is shared again
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= over
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken == r["copies"] * r["size"] and r["copies"] <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in order:
        assert abs(taken[s] - target[s]) <= largest[s] * 2, (s, taken[s], target[s])
    again = sorted((str(tuple(r)) for r in mixing.mix(odd.repartition(5)).collect()))
    assert again == sorted(str(tuple(r)) for r in got)
    assert mixing.mix(none).count() == 0 and mixing.take(none).count() == 0
    kept = mixing.take(odd)
    assert {c for c in odd.columns if c != "copies"} <= set(kept.columns)
    assert kept.count() == sum(r["copies"] > 0 for r in got)


def test_budgets_are_nested(odd):
    small = {r.doc_id: r["copies"] for r in mixing.mix(odd, budget=0.3).collect()}
    large = {r.doc_id: r["copies"] for r in mixing.mix(odd, budget=0.9).collect()}
    assert all(small[d] <= large[d] for d in small) and small != large


def shingle_set(text):
    w = split(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


@pytest.mark.parametrize("block", [1024, 4])
def test_near_join(odd, odd_rows, none, block, monkeypatch):
    monkeypatch.setattr(nearjoin, "BLOCK", block)
    sets = [shingle_set(t) for _, t, *_ in odd_rows]
    kinds = sorted(set(sets) - {frozenset()}, key=lambda s: sorted(map(str, s))[:3])
    links, parent = Counter(), {k: k for k in kinds}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if 5 * len(a & b) >= 4 * len(a | b):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for (d, *_), s in zip(odd_rows, sets):
        if s and d is not None:
            least[root(s)] = min(d, least.get(root(s), d))
    want = sorted(((d, least.get(root(s)) if s else d, links[s] if s else 0, sets.count(s) if s else 1)
                   for (d, *_), s in zip(odd_rows, sets)), key=str)
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in nearjoin.join(odd).collect()), key=str)
    assert got == want
    assert nearjoin.join(none).count() == 0
    if block == 4:
        kept = nearjoin.keep_one(odd)
        assert kept.columns == odd.columns
        roots = Counter(root(shingle_set(r.text)) for r in kept.collect() if shingle_set(r.text))
        assert set(roots.values()) == {1} and len(roots) == len({root(k) for k in kinds})
        assert sum(not shingle_set(r.text) for r in kept.collect()) == sum(not s for s in sets)


def test_overlaps():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 300, rng.integers(1, 200), dtype=np.uint64)) for _ in range(40)]
    table = nearjoin.overlaps(rows, 25)
    for i in range(25):
        for j in range(40):
            shared = len(set(rows[i].tolist()) & set(rows[j].tolist()))
            assert table[i, j] == shared


def plain_passages(rows):
    seen, out = set(), []
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    done = {}
    for d, t in order:
        words, gone = split(t), set()
        for i in range(len(words) - 19):
            w = tuple(words[i:i + 20])
            if w in seen:
                gone.update(range(i, i + 20))
            seen.add(w)
        done[d, t] = (d, len(words), len(gone), " ".join(x for i, x in enumerate(words) if i not in gone))
    for r in rows:
        out.append(done[r])
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [passages.BROADCAST_BYTES, 0])
def test_passages(spark, none, small, monkeypatch):
    monkeypatch.setattr(passages, "AUTOMATON_WORDS", 60)
    monkeypatch.setattr(passages, "SHARD_BYTES", 4000)
    monkeypatch.setattr(passages, "SEEDS_PER_HOME", 30)
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 5)))
    shared = [[word() for _ in range(rnd.randrange(15, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            s = list(rnd.choice(shared))
            if rnd.random() < 0.4:
                s[rnd.randrange(len(s))] = word()
            parts += rnd.choice([s, s[rnd.randrange(10):], [word() for _ in range(20)]])
        rows.append((rnd.randrange(1000) * 100 + i, rnd.choice([" ", "\n", "  "]).join(parts)))
    rows += [rows[0], (None, rows[1][1]), (7, "a b c d e f g h i j " * 20), (8, "same " * 90), (9, None), (10, "")]
    df = spark.createDataFrame([(d, t, 1, "r") for d, t in rows], "doc_id long, text string, n_words int, row string")
    got = passages.dedup(df, broadcast_bytes=small)
    assert got.columns == ["doc_id", "text", "row", "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()), key=str) == plain_passages(rows)
    assert passages.dedup(none, broadcast_bytes=small).count() == 0


def test_token_edits(spark, odd, none, monkeypatch):
    monkeypatch.setattr(tokens, "FAN", 8)
    encode = tokens.encoding().encode_ordinary
    rnd = random.Random(9)
    bits = ["'s", " ", "  ", "\n", " a", "x1", "é", "...", "\t ", "\xa0", "\x1c", "", "'re", "　"]
    encoder = tokens.Encoder()
    for _ in range(400):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 80)))
        tree = tokens.Tree.over(encoder.leaves(text))
        for _ in range(3):
            a = rnd.randrange(len(text) + 1)
            b = min(len(text), a + rnd.choice([0, 1, 2, 20]))
            text, _ = tokens.edit(text, tree, a, b, "".join(rnd.choice(bits) for _ in range(rnd.randrange(4))), encoder)
            tree = tokens.Tree.unpack(tree.pack())
            assert tree.levels[0][:, 1:].tolist() == encoder.leaves(text).tolist()
            assert tree.tokens == len(encode(text))
            for low, high in zip(tree.levels, tree.levels[1:]):
                assert high.tolist() == tokens._grouped(low, high[:, 0]).tolist()
    edits = "array(named_struct('start', 3L, 'end', 9L, 'put', 'new words'), named_struct('start', 1L, 'end', 1L, 'put', null))"
    done = tokens.apply_edits(tokens.build(odd.selectExpr("*", f"{edits} AS edits")))
    for r in done.collect():
        text = r.text or ""
        want = text[:1] + text[1:3] + "new words" + text[9:] if len(text) >= 3 else r.edited.text
        assert r.edited.text == want and r.edited.n_tokens == len(encode(want)) and r.tokens.n_tokens == len(encode(text))
        assert r.edited.n_encoded <= 40
    assert tokens.build(none).count() == 0
    assert SCHEMA


@pytest.mark.parametrize("small,shard_bytes", [(passages.BROADCAST_BYTES, 24 << 20), (passages.BROADCAST_BYTES, 100), (100, 24 << 20), (0, 24 << 20)])
def test_one_hot_passage(spark, monkeypatch, small, shard_bytes):
    """A passage in all rows sends itself, not a piece for each row; a heavy shard is dealt by windows."""
    monkeypatch.setattr(passages, "SHARD_BYTES", shard_bytes)
    sent = {}
    write = passages.WorkTables.write

    def spied(self, df, name):
        out = write(self, df, name)
        sent[name] = out.collect() if name in ("passage-ranges", "passage-dealt") else None
        return out

    monkeypatch.setattr(passages.WorkTables, "write", spied)
    hot = [f"hot{i}" for i in range(40)]
    rows = [(i, " ".join([*(f"a{i}x{k}" for k in range(15)), *hot, *(f"z{i}x{k}" for k in range(15))])) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = passages.dedup(df, broadcast_bytes=small)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()), key=str) == plain_passages(rows)
    assert len(sent["passage-ranges"]) <= 60  # the filter may take some more
    assert ("passage-dealt" in sent) == (shard_bytes == 100)
