import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codequarry.functions.vectors import cosine
from codequarry.operators import inverted, search
from codequarry.operators.inverted import WordIndex
from codequarry.operators.pivots import VectorIndex
from codequarry.sources import vector_bytes

SCHEMA = "id string, repository_id string, embedding array<float>"
QSCHEMA = "query_id int, repository_id string, embedding array<float>"


def model(chunks, queries, k, keyed):
    """Brute force with plain Python numbers."""
    out = []
    for qid, qkey, q in queries:
        scored = []
        for cid, ckey, v in chunks:
            if keyed and ckey != qkey:
                continue
            score = -1.0
            if v is not None and q is not None and len(v) == len(q):
                a, b = np.float32(q).astype(float), np.float32(v).astype(float)
                raw = float(a @ b) / (math.sqrt(a @ a) * math.sqrt(b @ b) + 1e-9)
                score = -1.0 if math.isnan(raw) else round(raw, 9)
            scored.append((-score, cid))
        out += [(qid, cid, round(-s, 6) + 0.0, i + 1) for i, (s, cid) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    same = rng.normal(size=8).tolist()
    chunks = [(f"c{i:04d}", f"r{i % 3}", rng.normal(size=8).tolist()) for i in range(300)]
    # A third of the rows are copies of one vector; some cannot be scored.
    chunks += [(f"d{i:04d}", "r0", same) for i in range(150)]
    chunks += [("e0", "r0", None), ("e1", "r1", [float("nan")] * 8), ("e2", "r2", [1.0] * 5), ("e3", "r1", [0.0] * 8)]
    queries = [(1, "r0", same), (2, "r1", rng.normal(size=8).tolist()), (3, "r2", [0.0] * 8),
               (4, "r0", [-x for x in same]), (5, "none", same)]
    return chunks, queries


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("form", ["broadcast", "blocks"])
def test_top_k_is_exact(spark, data, keyed, form, monkeypatch):
    chunks, queries = data
    monkeypatch.setattr(search, "CHUNK_BLOCK", 40)
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    left = spark.createDataFrame(chunks, SCHEMA).repartition(5)
    right = spark.createDataFrame(queries, QSCHEMA)
    got = search.top_k(left, right, 7, by="repository_id" if keyed else None,
                       broadcast_queries=0 if form == "blocks" else 100)
    found = sorted((r.query_id, r.id, round(r.score, 6), r["rank"]) for r in got.collect())
    assert found == model(chunks, queries, 7, keyed)


@pytest.mark.parametrize("form", ["broadcast", "blocks"])
def test_widths_belong_to_queries(spark, form, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_BLOCK", 3)
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    chunks = [(f"n{i}", "narrow", [1.0, float(i)]) for i in range(5)] + [(f"w{i}", "wide", [1.0, 2.0, float(i)]) for i in range(5)]
    chunks += [("m2", "mixed", [1.0, 1.0]), ("m3", "mixed", [1.0, 1.0, 1.0]), ("m0", "mixed", None)]
    queries = [(1, "narrow", [1.0, 3.0]), (2, "wide", [1.0, 2.0, 3.0]), (3, "mixed", [1.0, 1.0]),
               (4, "mixed", [1.0, 1.0, 1.0]), (5, "mixed", None)]
    got = search.top_k(spark.createDataFrame(chunks, SCHEMA), spark.createDataFrame(queries, QSCHEMA), 3,
                       broadcast_queries=0 if form == "blocks" else 100)
    found = sorted((r.query_id, r.id, round(r.score, 6), r["rank"]) for r in got.collect())
    assert found == model(chunks, queries, 3, True)


@pytest.mark.parametrize("form", ["broadcast", "blocks"])
def test_keywords_are_exact(spark, form, monkeypatch):
    monkeypatch.setattr(search, "CHUNK_BLOCK", 20)
    monkeypatch.setattr(search, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(9)
    word = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 30, n))
    chunks = [(i, f"r{i % 2}", "The, THE the! " + word(6)) for i in range(120)]
    queries = [(1, "r0", "the " + word(3)), (2, "r1", word(5)), (3, "r1", "absent"), (4, "r0", "w1 W1 w1")]
    want = []
    for q, key, text in queries:
        words = set(text.lower().split())
        scored = [(-len(words & set(c.lower().replace(",", "").replace("!", "").split())), i)
                  for i, other, c in chunks if other == key]
        want += [(q, i, float(-s), n + 1) for n, (s, i) in enumerate(sorted(x for x in scored if x[0])[:6])]
    got = search.keyword_top_k(
        spark.createDataFrame(chunks, "id int, repository_id string, content string").repartition(3),
        spark.createDataFrame(queries, "query_id int, repository_id string, question string"), 6,
        broadcast_queries=0 if form == "blocks" else 10)
    assert sorted((r.query_id, r.id, r.score, r["rank"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("k,rows", [(None, 8), (0, 8), (1, 1), (10_000, 454)])
def test_k(spark, data, k, rows):
    chunks, queries = data
    left = spark.createDataFrame(chunks, SCHEMA)
    right = spark.createDataFrame(queries[:1], QSCHEMA)
    assert search.top_k(left, right, k, by=None).count() == rows


def test_all_unscorable_stay_ranked(spark):
    left = spark.createDataFrame([("a", "r", None), ("b", "r", None)], SCHEMA)
    right = spark.createDataFrame([(1, "r", [1.0, 2.0])], QSCHEMA)
    assert [(r.id, r.score) for r in search.top_k(left, right, 5).orderBy("rank").collect()] == [("a", -1.0), ("b", -1.0)]
    right = spark.createDataFrame([(1, "r", None)], QSCHEMA)
    assert [r.score for r in search.top_k(left, right, 5).collect()] == [-1.0, -1.0]
    assert search.top_k(left, spark.createDataFrame([], QSCHEMA), 5).count() == 0


def test_cosine_column(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]),
            (None, [1.0]), ([1.0], [1.0, 2.0]), ([float("nan")], [1.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in df.select(cosine("a", "b")).collect()] == [1, -1, 0, 0, -1, -1, -1]


def test_hits_carry_cut_content(spark):
    chunks = spark.createDataFrame(
        [("a", "r", [1.0, 0.0], "n", "Class", "p.py", "x" * 2000, 1, 2)],
        SCHEMA + ", entity_name string, entity_type string, file_path string, content string, "
        "line_start int, line_end int",
    )
    queries = spark.createDataFrame([(1, "r", [1.0, 1.0])], QSCHEMA)
    hit = search.hit_rows(search.top_k(chunks, queries), chunks).collect()[0]
    assert len(hit.content) == 1500 and hit.entity_name == "n" and hit["rank"] == 1


def test_vector_bytes(spark):
    df = spark.createDataFrame(
        [("r", bytearray(np.float32([1, 2.5]).tobytes())), ("r", None), ("r", bytearray(b"abc")),
         ("s", bytearray(np.float32([1]).tobytes())), ("s", bytearray(np.float32([1, 2]).tobytes()))],
        "repository_id string, embedding binary",
    )
    back = vector_bytes.import_vectors(df)
    assert [r.embedding for r in back.collect()] == [[1.0, 2.5], None, None, [1.0], [1.0, 2.0]]
    assert [r.repository_id for r in vector_bytes.mixed_widths(back).collect()] == ["s"]
    again = vector_bytes.export_vectors(back.filter("embedding is not null"))
    assert {bytes(r.embedding) for r in again.collect()} == {
        bytes(r.embedding) for r in df.collect() if r.embedding and len(r.embedding) % 4 == 0}


def test_scan_plan_has_no_pairs(spark, data):
    chunks, queries = data
    got = search.top_k(spark.createDataFrame(chunks, SCHEMA), spark.createDataFrame(queries, QSCHEMA), 3)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "Join" not in text and "Cartesian" not in text


def test_one_hit_for_each_entity(spark):
    rnd = np.random.default_rng(4)
    rows = [(f"c{i:03}", f"e{i % 7}" if i < 60 else f"e{i}", "r", [float(x) for x in rnd.standard_normal(4)]) for i in range(90)]
    rows += [("c900", "e900", "r", None), ("c901", "e0", "r", [0.0, 0.0, 0.0, 0.0]), ("c902", "e901", "s", [1.0, 0.0, 0.0, 0.0])]
    rows += [("c903", "e1", "r", rows[5][3])]  # ties with another entity's chunk
    left = spark.createDataFrame(rows, "id string, entity_id string, repository_id string, embedding array<float>").repartition(5)
    asked = [(q, "r", [float(x) for x in rnd.standard_normal(4)]) for q in range(5)]
    right = spark.createDataFrame(asked, QSCHEMA)
    best = {}
    for q, _, exact in asked:
        v = np.float32(exact).astype(float)
        scored = []
        for i, e, r, x in rows:
            if r == "r":
                x32 = np.float32(x).astype(float) if x else None
                score = -1.0 if x is None else round(float(np.dot(v, x32) / (np.linalg.norm(v) * np.linalg.norm(x32) + 1e-9)), 9)
                scored.append((-score, i, e))
        seen, kept = set(), []
        for s, i, e in sorted(scored):
            if e not in seen:
                seen.add(e)
                kept.append((i, e))
        best[q] = kept[:6]
    for form in ({}, {"broadcast_queries": 0}):
        got = search.top_k(left, right, 6, one_of="entity_id", **form).collect()
        for q in best:
            assert [(r.id, r.entity_id) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == best[q]


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("pivots,block_rows", [(1, 8192), (12, 30), (64, 8192)])
def test_index_gives_the_same_hits(spark, data, tmp_path, keyed, pivots, block_rows):
    chunks, queries = data
    chunks = chunks + [("f0", "r1", [1e-12] * 8), ("f1", "r1", [-1e-12] * 8), ("f2", "r0", [])]
    queries = queries + [(6, "r1", None), (7, "r1", [-1.0] * 8), (8, "r2", [1.0] * 5), (9, "r1", [1e-9] * 8)]
    by = "repository_id" if keyed else None
    left = spark.createDataFrame(chunks, SCHEMA).repartition(5)
    right = spark.createDataFrame(queries, QSCHEMA)
    index = VectorIndex.build(left, str(tmp_path / "index"), by, pivots=pivots, block_rows=block_rows)
    again = VectorIndex(spark, str(tmp_path / "index"))
    assert sum(r.rows for r in again.cells().collect()) == len(chunks) == index.members().count()
    for k in (1, 7):
        got = again.top_k(right, k, by)
        found = sorted((r.query_id, r.id, round(r.score, 6), r["rank"]) for r in got.collect())
        plain = search.top_k(left, right, k, by)
        assert found == sorted((r.query_id, r.id, round(r.score, 6), r["rank"]) for r in plain.collect())


def test_index_skips_what_is_far(spark, tmp_path):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    chunks = [(f"c{i:05d}", "r", (centres[i % 30] + 0.1 * rng.normal(size=16)).tolist()) for i in range(6000)]
    queries = [(i, "r", (centres[i] + 0.1 * rng.normal(size=16)).tolist()) for i in range(10)]
    left, right = spark.createDataFrame(chunks, SCHEMA), spark.createDataFrame(queries, QSCHEMA)
    index = VectorIndex.build(left, str(tmp_path / "index"), pivots=100)
    seen = index.visited(right, 5).collect()
    assert len(seen) == 10 and {r.total for r in seen} == {6000}
    assert all(5 <= r.scored <= 600 and r.skipped >= 0.9 for r in seen)
    key = lambda r: (r.query_id, r["rank"])
    assert [r.id for r in sorted(index.top_k(right, 5).collect(), key=key)] == [
        r.id for r in sorted(search.top_k(left, right, 5).collect(), key=key)]


@pytest.mark.parametrize("keyed,k,block_rows", [(True, 6, 7), (False, 6, 2048), (False, 1, 10), (True, 500, 2048)])
def test_word_index_gives_the_same_hits(spark, tmp_path, keyed, k, block_rows):
    rng = np.random.default_rng(10)
    # Words of very different frequency; the first is in every text.
    word = lambda n: " ".join(f"w{int(30 * x ** 3)}" for x in rng.random(n))
    chunks = [(i, f"r{i % 2}", "The, THE the! " + word(8)) for i in range(300)] + [(900, "r0", None), (901, "r1", "")]
    queries = [(1, "r0", "the " + word(6)), (2, "r1", word(9)), (3, "r1", "absent"), (4, "r0", "w1 W1 w1"), (5, "none", "the"),
               (6, "r1", None), (7, "r0", "the w0 w1 w2 w3 w4 w29")]
    left = spark.createDataFrame(chunks, "id int, repository_id string, content string").repartition(3)
    right = spark.createDataFrame(queries, "query_id int, repository_id string, question string")
    by = "repository_id" if keyed else None
    WordIndex.build(left, str(tmp_path / "words"), by, block_rows=block_rows)
    index = WordIndex(spark, str(tmp_path / "words"))
    got = sorted((r.query_id, r.id, r.score, r["rank"]) for r in index.top_k(right, k, by).collect())
    plain = search.keyword_top_k(left, right, k, by)
    assert got == sorted((r.query_id, r.id, int(r.score), r["rank"]) for r in plain.collect()) and got


def test_word_index_reads_asked_words_only(spark, tmp_path):
    left = spark.createDataFrame([(i, f"w{i} w{i % 7} all") for i in range(500)], "id int, content string")
    index = WordIndex.build(left, str(tmp_path / "words"), None)
    asked = spark.createDataFrame([("w3",), ("w11",)], "word string").select("word", inverted._folder("word").alias("folder"))
    part = index._of(index.postings(), asked)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan and "PushedFilters: [In(word" in plan
    assert {r.word for r in part.collect()} == {"w3", "w11"}
    assert {len(r.ids) for r in index.postings().filter("word = 'all'").collect()} == {500}


def _shuffled_records(df):
    """Rows that the shuffles of a collected frame wrote."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        below = sum(walk(node.children().apply(i)) for i in range(node.children().size()))
        return below + (node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0)

    return walk(df._jdf.queryExecution().executedPlan())


def test_frequent_words_are_looked_up_by_block(spark, tmp_path):
    frequent = " ".join(f"common{j}" for j in range(10))
    rare = lambda i: " ".join(f"rare{i}x{j}" for j in range(14))
    chunks = [(i, f"{frequent} {rare(i % 10)}") for i in range(400)]
    queries = [(i, f"{frequent} {rare(i % 10)} absent") for i in range(40)]
    left = spark.createDataFrame(chunks, "id int, content string").repartition(4)
    right = spark.createDataFrame(queries, "query_id int, question string")
    hits = WordIndex.build(left, str(tmp_path / "words"), None, block_rows=50).top_k(right, 2, None)
    found = sorted((r.query_id, r["rank"], r.id, r.score) for r in hits.collect())
    assert found == [(q, rank, q % 10 + 10 * (rank - 1), 24) for q in range(40) for rank in (1, 2)]
    # No row for each open chunk and word of its query: both sides meet in their block.
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "array_contains" not in plan


def test_words_are_split_behind_the_shuffle_of_the_build(spark, tmp_path, monkeypatch):
    moved = []
    write = WordIndex._write
    monkeypatch.setattr(WordIndex, "_write", lambda self, rows, name, *more: (
        moved.append((name, len(rows.collect()), _shuffled_records(rows))), write(self, rows, name, *more))[1])
    left = spark.range(300).selectExpr("cast(id as int) id", "concat_ws(' ', transform(sequence(0, 49), x -> concat('w', x * 300 + id))) content")
    WordIndex.build(left.repartition(3), str(tmp_path / "words"), None)
    # A row a chunk, and few for the numbers of blocks; each chunk has 50 words of its own.
    assert moved[0][:2] == ("postings", 15000) and 300 <= moved[0][2] < 700


def test_word_index_of_repeated_and_missing_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inverted, "QUERY_SHARE", 2)
    rows = [("a", "r", "x y"), ("a", "r", "Y z z"), ("b", "r", "x"), (None, "r", "x only"), ("c", "s", None), ("d", "t", " "), ("e", None, "x")]
    left = spark.createDataFrame(rows, "id string, repository_id string, content string")
    index = WordIndex.build(left, str(tmp_path / "words"), block_rows=100)
    assert {(r.by, r.word, tuple(r.ids), r.n) for r in index.postings().collect()} == {
        ("r", "x", ("a", "b"), 2), ("r", "y", ("a",), 1), ("r", "z", ("a",), 1), ("r", "only", (), 0)}
    right = spark.createDataFrame([(i, "r", "x y z") for i in range(7)], "query_id int, repository_id string, question string")
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in index.top_k(right, 2).collect()) == [
        row for i in range(7) for row in ((i, 1, "a", 3), (i, 2, "b", 1))]


def test_a_block_of_repeated_ids_is_held_once(monkeypatch):
    monkeypatch.setattr(inverted, "HELD_PAIRS", 3)
    held = []
    distinct = inverted._distinct
    monkeypatch.setattr(inverted, "_distinct", lambda pairs: (held.append(pairs.num_rows), distinct(pairs))[1])
    batch = pa.RecordBatch.from_pydict({"words": ["p q", "q r", None, ""], "id": [7, 5, 6, 6]})
    out = list(inverted._lists((pa.scalar("r"), pa.scalar(3, pa.int32())), iter([batch] * 50)))
    assert max(held) <= 12 and len(out) == 1
    assert sorted(map(tuple, (r.values() for r in out[0].to_pylist()))) == [
        ("r", "p", 3, [7], 1), ("r", "q", 3, [5, 7], 2), ("r", "r", 3, [5], 1)]
    empty = pa.RecordBatch.from_pydict({"words": pa.array([None, ""], pa.string()), "id": [1, 2]})
    assert sum(b.num_rows for b in inverted._lists((pa.scalar("r"), pa.scalar(0, pa.int32())), iter([empty]))) == 0


def test_chunks_are_sent_once_to_eight_thousand_queries(spark):
    queries = spark.range(8192).select(F.lit(0).alias("by"), F.col("id").alias("query_id"))
    assert search._blocks(queries, search.QUERY_BLOCK, "n").first()["n"] == 1


def test_few_chunks_of_a_block_are_ranked(monkeypatch):
    """In a block, only what may be among a query's first k is scored exactly and compared; the hits are those of all pairs."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    n, asked, width, k = 9000, 300, 24, 5
    vectors = rng.poisson(1.0, size=(n, width)).astype(np.float32)
    vectors[7] = 0
    vectors[5000:5040] = vectors[4000]
    lists = [None if i == 8500 else v.tolist() for i, v in enumerate(vectors)]
    queries = rng.poisson(0.5, size=(asked, width)).astype(float)
    queries[3] = 0
    few = pa.table({"by": ["r"] * asked, "query_id": list(range(asked)), "v": pa.array(queries.tolist())})
    seen, merge = [], getattr(search._Best, "_merge", None)
    monkeypatch.setattr(search._Best, "_merge", lambda self, query, rounded, *more: (
        seen.append(len(rounded)), merge(self, query, rounded, *more)), raising=False)
    best = search._Best(k)
    ids, entities = pa.array(range(n)), pa.array([i // 2 for i in range(n)])
    handled, add = [], search._Best.add
    monkeypatch.setattr(search._Best, "add", lambda self, query, scores, *more: (
        handled.append(len(scores)), add(self, query, scores, *more)))
    search._Vectors(few).add(pa.array(["r"] * n), ids, pa.array(lists, pa.list_(pa.float32())), best, entities)
    assert sum(handled) + sum(seen) < n * asked / 10
    double = vectors.astype(float)
    norms = np.sqrt((double * double).sum(axis=1))
    for q in range(asked):
        scores = np.round(double @ queries[q] / (norms * np.sqrt(queries[q] @ queries[q]) + 1e-9), 9)
        scores[8500] = -1
        expected, used = [], set()
        for i in sorted(range(n), key=lambda i: (-scores[i], i)):
            if i // 2 not in used:
                used.add(i // 2)
                expected.append(i)
            if len(expected) == k:
                break
        assert [row[1] for row in best.rows[q]] == expected
