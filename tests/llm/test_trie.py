"""The conversation trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from codequarry.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, a string, depth int"


def plain(rows, family=5, heads=9):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    for turns in convs.values():
        turns.sort()
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        way = tuple(t[2:] for t in convs.get(base, [])[:h] + own[h:])
        for d in range(len(way) + 1):
            members.setdefault(way[:d], []).append(c)
        ends.setdefault(way, []).append(c)
    out = {}
    for key in sorted(members, key=len, reverse=True):
        found = members[key]
        entry = out.setdefault(key, [0, 0, 0])
        entry[1] += entry[0] == 0
        entry[2] += (len(found) - 1) * (len(key[-1][1]) if key else 0)
        if key:
            up = out.setdefault(key[:-1], [0, 0, 0])
            up[0] += 1
            up[1] += entry[1]
            up[2] += entry[2]
    return sorted(((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), *out[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k in members), key=str)


def talks(seed, n=120, longest=9, hot=40):
    rnd = random.Random(seed)
    rows = []
    for c in range(-7, n):
        if c % 11 == 3:
            continue
        for t in range(rnd.randrange(0, longest)):
            role = rnd.choice(["user", "assistant", None])
            rows.append((c, t if t else None, role, rnd.choice(["hi", "Hé", "", None, f"word {rnd.randrange(3)}"]), "x", 7))
    for c in range(1000, 1000 + hot):  # one common conversation
        rows += [(c, t, "user", f"common {t}", "x", 7) for t in range(6)]
    rows += [(2000, 5, "user", "again", None, None)] * 3 + [(2000, None, "b", "later"), (2000, None, "b", "Later"), (2000, None, None, "z" * 50_000)]
    rows += [(None, 1, "user", "lost", None, None), (None, None, None, None, None, None), (3000, 1, None, None)]
    rows += [(3005, t, "user", f"t{t % 2}") for t in range(300)]  # a long one
    rows = [(r + (None, None))[:6] for r in rows]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows,band,queue_rows", [(1 << 16, 4096, 1 << 18), (40, 4096, 16), (25, 3, 4), (1, 2, 8)])
def test_trie(spark, shard_rows, band, queue_rows):
    rows = talks(shard_rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = trie.build(df, shard_rows=shard_rows, band=band, queue_rows=queue_rows).drop("a", "b").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_trie_without_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.build(none).count() == 0
    assert trie.build(spark.createDataFrame([(None, 1, "user", "x", "", 1)], SCHEMA)).count() == 0


def test_turnless_conversations(spark):
    # Short conversations whose family has no first one lose all their turns where h reaches their length.
    rows = [(c, 1, "user", "only", None, None) for c in range(1, 200) if c % 5]
    got = trie.build(spark.createDataFrame(rows, SCHEMA)).drop("a", "b").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
    assert len(got) == 2


@pytest.mark.parametrize("rows", [2, 3, 7, 1000])
def test_queue_spills_and_keeps_order(rows):
    rnd = random.Random(rows)
    queue, left = trie.Queue(rows), []
    for turn in range(300):
        entry = ((turn // 10 + rnd.randrange(40), 0, 0), (turn,))
        queue.push(entry)
        left.append(entry)
        if turn % 10 == 9:
            due = sorted(e for e in left if e[0] <= (turn // 10, 9, 9))
            assert list(queue.pop_of((turn // 10, 9, 9))) == due
            left = [e for e in left if e not in due]
    assert list(queue.drain()) == sorted(left)
    assert rows > 100 or queue.runs == []
