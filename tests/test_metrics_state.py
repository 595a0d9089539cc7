import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codequarry import schemas
from codequarry.operators import metrics, sketches, state
from codequarry.streaming.admission import Admissions


def sample_model(n):
    kept = []
    for i in range(n):
        kept.append(i)
        if len(kept) > 1000:
            kept = kept[-500:]
    return kept


def test_sample_sizes(spark):
    sizes = [0, 1, 999, 1000, 1001, 1002, 1500, 1501, 1502, 2001, 2002, 5000]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    assert [r[0] for r in df.select(metrics.sample_size(F.col("n"))).collect()] == [len(sample_model(n)) for n in sizes]


def test_bounded_sample_and_summary(spark):
    sizes = {"a": 1, "b": 1000, "c": 1001, "d": 1501, "e": 1502}
    df = spark.createDataFrame(
        [(m, i // 3, i, float(i)) for m, n in sizes.items() for i in range(n)],
        "metric string, ts bigint, id bigint, value double",
    ).repartition(5)
    got = defaultdict(list)
    for r in metrics.bounded_sample(df).collect():
        got[r.metric].append(r.id)
    assert {m: sorted(v) for m, v in got.items()} == {m: sample_model(n) for m, n in sizes.items()}
    done = {r.metric: tuple(r)[1:] for r in metrics.summary(metrics.bounded_sample(df)).collect()}
    assert done["c"] == (500, 750.5, 1000.0)


def admitted_model(rows, limit, seconds):
    kept, out = defaultdict(list), {}
    for client, t, i in sorted(rows):
        kept[client] = [x for x in kept[client] if x > t - seconds * 1_000_000]
        out[i] = len(kept[client]) < limit
        if out[i]:
            kept[client].append(t)
    return out


@pytest.mark.parametrize("limit,seconds,step", [(3, 60, 20), (1, 60, 60), (60, 60, 1), (5, 10, 2)])
def test_admission_is_exact(spark, limit, seconds, step):
    rng = random.Random(limit)
    rows, t = [], 0
    for i in range(1500):
        # Long quiet spells, bursts at one instant, and gaps of exactly the window.
        t += rng.choice([0, 1, step * 1_000_000, seconds * 1_000_000, rng.randrange(1, 4 * step * 1_000_000)])
        rows.append(("hot" if i % 3 else f"c{rng.randrange(20)}", t, i))
    df = spark.createDataFrame(rows, "client string, t bigint, id bigint").select(
        "client", "id", F.timestamp_micros("t").alias("ts")
    ).repartition(4)
    got = metrics.admission_flags(df, "id", limit=limit, seconds=seconds)
    assert {r.id: r.admitted for r in got.collect()} == admitted_model(rows, limit, seconds)
    recent = {(r.client, r.t): r.recent for r in metrics.recent_requests(df, seconds=seconds).collect()}
    for client, t, _ in rows[:200]:
        assert recent[(client, t)] == sum(1 for c, x, _ in rows if c == client and t - seconds * 1_000_000 < x <= t)


def test_rejected_requests_leave_no_trace(spark):
    s = 1_000_000
    rows = [("c", t * s, t) for t in (0, 1, 2, 30, 59, 60, 61, 62)]
    df = spark.createDataFrame(rows, "client string, t bigint, id bigint").select(
        "client", "id", F.timestamp_micros("t").alias("ts"))
    got = {r.id: r.admitted for r in metrics.admission_flags(df, "id", limit=2, seconds=60).collect()}
    assert got == {0: True, 1: True, 2: False, 30: False, 59: False, 60: True, 61: True, 62: False}


def test_rollup_has_percentile(spark):
    df = spark.createDataFrame(
        [("GET", "/a", 200, 1.005, None, "2024-01-01 00:10:00"), ("GET", "/a", 200, 3.0, "x", "2024-01-01 00:20:00")],
        "method string, path string, status int, duration_ms double, client string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    row = metrics.request_rollup(df).collect()[0]
    assert row.requests == 2 and row.max_ms == 3.0 and row.p95_ms == 3.0
    assert {r.client for r in metrics.request_rows(df).collect()} == {"unknown", "x"}


def repo(**values):
    base = dict(id="a", url="u", name="n", local_path="", default_branch="main", language="python", status="failed",
                error_message="boom", file_count=3, entity_count=4, structure_path=None, created_at=None,
                updated_at=None)
    return tuple({**base, **values}[f.name] for f in schemas.REPOSITORIES)


ARRIVING = "id string, url string, name string, local_path string, branch string, ts timestamp, seq bigint"


def test_upsert(spark):
    stored = spark.createDataFrame([repo(), repo(id="b", url="ub")], schemas.REPOSITORIES)
    news = spark.createDataFrame(
        [("a", "changed", "changed", "/a1", "dev", None, 1), ("a", "changed", "changed", "/a2", "dev", None, 2),
         ("c", "uc", "nc", "/c", None, None, 3), ("c", "uc2", "nc2", "/c2", "dev", None, 4)], ARRIVING)
    once = state.upsert_repositories(stored, news)
    got = {r.id: r for r in once.collect()}
    assert (got["a"].url, got["a"].status, got["a"].error_message, got["a"].local_path, got["a"].default_branch) == (
        "u", "cloning", None, "/a2", "main")
    assert (got["b"].status, got["b"].error_message) == ("failed", "boom")
    assert (got["c"].url, got["c"].name, got["c"].local_path, got["c"].default_branch) == ("uc", "nc", "/c2", "main")
    twice = state.upsert_repositories(once, news)
    assert sorted(map(tuple, twice.collect()), key=repr) == sorted(map(tuple, once.collect()), key=repr)
    none = state.upsert_repositories(stored, news.limit(0))
    assert sorted(map(tuple, none.collect()), key=repr) == sorted(map(tuple, stored.collect()), key=repr)
    assert once.schema.fieldNames() == schemas.REPOSITORIES.fieldNames()


def test_expiry_boundary(spark):
    df = spark.sql(
        "select 'at' id, timestamp'2024-01-01 00:00:00' updated_at union all "
        "select 'before', timestamp'2023-12-31 23:59:59.999999' union all select 'null', null"
    )
    gone = state.expired(df, "2024-01-31 00:00:00")
    assert [r.id for r in gone.collect()] == ["before"]
    tables = {n: spark.createDataFrame([("at", 1), ("before", 2), ("before", 3)], "repository_id string, x int")
              for n in ("nodes", "edges", "chunks", "runs")}
    kept = state.retained(tables, gone)
    assert {n: [r.x for r in t.collect()] for n, t in kept.items()} == dict.fromkeys(tables, [1])


def test_run_log(spark, tmp_path):
    log = spark.createDataFrame(
        [("j", "r", "cloning", 1), ("j", "r", "completed", 3), ("j", "r", "parsing", 2)],
        "id string, repository_id string, status string, seq bigint")
    state.append_runs(log, str(tmp_path / "runs"))
    assert [r.status for r in state.latest_runs(spark.read.parquet(str(tmp_path / "runs"))).collect()] == ["completed"]
    with pytest.raises(ValueError):
        state.append_runs(log.withColumn("status", F.lit("odd")), str(tmp_path / "runs"))


def test_page_checks(spark):
    df = spark.createDataFrame([repo(id=str(i)) for i in range(5)], schemas.REPOSITORIES)
    rows = state.repository_page(df, 2, 2).collect()
    assert [(r.id, r.total, r.has_more) for r in rows] == [("2", 5, True), ("3", 5, True)]
    assert state.repository_page(df, 9, 2).count() == 0
    for number, size in ((0, 5), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            state.repository_page(df, number, size)


def test_gate(spark):
    repos = spark.createDataFrame([repo(id="a", status="completed"), repo(id="b")], schemas.REPOSITORIES)
    asked = spark.createDataFrame([("a",), ("b",), ("x",)], "repository_id string")
    assert [r[0] for r in state.accepted(asked, repos).collect()] == ["a"]
    assert sorted(r[0] for r in state.rejected(asked, repos).collect()) == ["b", "x"]
    assert sorted(r[0] for r in state.accepted(asked, repos, False).collect()) == ["a", "b"]


def test_admission_of_a_busy_client(spark):
    """A client with most rows that never pauses: only what is over the limit is replayed, in many chains."""
    rng = random.Random(11)
    rows, t = [], 0
    for i in range(3000):
        t += rng.choice([5, 7, 9]) if i % 300 > 30 else 1  # a burst now and then
        rows.append(("busy", t, i))
    rows += [(f"c{i % 40}", 100 * i, 10_000 + i) for i in range(400)]
    df = spark.createDataFrame(rows, "client string, s bigint, id bigint").select("client", "id", F.timestamp_seconds("s").alias("ts"))
    span = 60_000_000
    chained = metrics._with_chain(metrics._with_recent(metrics._moments(df, "client", "ts"), span), 10, span)
    busy = chained.filter("client = 'busy'").groupBy("chain").count().collect()
    assert sum(r["count"] for r in busy if r.chain is None) > 1500 and len(busy) > 8
    assert chained.filter("client <> 'busy' AND chain IS NOT NULL").count() == 0
    got = metrics.admission_flags(df, "id", limit=10, seconds=60)
    assert {r.id: r.admitted for r in got.collect()} == admitted_model(
        [(c, s * 1_000_000, i) for c, s, i in rows], 10, 60)


@pytest.mark.parametrize("delay", [0, 600])
def test_admission_by_triggers(spark, tmp_path, delay):
    """Requests out of order over many triggers, one of them repeated: judged as in one go, or late."""
    rng = random.Random(delay)
    rows, t = [], 0
    for i in range(600):
        t += rng.choice([0, 1, 2, 20, 70])
        rows.append((f"c{rng.randrange(3)}", t, i))
    arrived = sorted(rows, key=lambda r: r[1] + rng.randrange(500))
    tables = Admissions(spark, str(tmp_path / "a"), T.StringType(), delay, limit=3, seconds=60)
    frame = lambda part: spark.createDataFrame([(c, s * 1_000_000) for c, s, _ in part], "client string, t bigint")
    for number in range(4):
        part = arrived[number * 150:(number + 1) * 150]
        tables.trigger(frame(part), number)
        if number == 2:
            tables.trigger(frame(part), number)
    assert tables.last() == 3
    tables.finish(4)
    judged, late = tables.admitted().collect(), tables.late().collect()
    assert sum(r.requests for r in judged) + sum(r.n for r in late) == 600
    assert (len(late) > 0) == (delay == 0)
    gone = {(r.client, r.t) for r in late}
    kept = [(c, s * 1_000_000, i) for c, s, i in rows if (c, s * 1_000_000) not in gone]
    if delay:
        want = {}
        for i, ok in admitted_model(kept, 3, 60).items():
            c, s, _ = rows[i]
            want[c, s * 1_000_000] = want.get((c, s * 1_000_000), 0) + ok
        assert {(r.client, r.t): r.admitted for r in judged} == want
    state = [len(os.listdir(tmp_path / "a" / name)) for name in ("waiting", "kept")]
    assert max(state) <= 2  # older state is deleted
    assert tables._state("kept", 4).count() == 0


def test_sketches_merge_and_late_samples_count(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"p{i % 2}", rng.gauss(100, 20), i * 7) for i in range(20_000)]
    df = spark.createDataFrame(rows, "path string, duration_ms double, s bigint").select("path", "duration_ms", F.timestamp_seconds("s").alias("ts"))
    store = sketches.SketchStore(spark, str(tmp_path / "s"))
    store.add(df.filter("duration_ms < 100"), 0)
    store.add(df.filter("duration_ms >= 100"), 1)  # the same hours once more
    store.add(df.filter("duration_ms >= 100"), 1)  # and again, repeated
    small = store.compact(str(tmp_path / "t"))
    assert small.rows().count() == store.windows().count() == sketches.sketched(df).count() < store.rows().count()
    for rows_ in (store.rows(), small.rows()):
        for r in sketches.quantiles(sketches.merged(rows_, ["path"])).collect():
            values = sorted(v for p, v, _ in rows if p == r.path)
            assert r.requests == len(values) and r.max_ms == values[-1] and abs(r.avg_ms - sum(values) / len(values)) < 1e-6
            for q, share in ((r.p50, 0.5), (r.p95, 0.95), (r.p99, 0.99)):
                rank = sum(v <= q for v in values) / len(values)
                assert abs(rank - share) <= sketches.rank_error()
    nothing = sketches.sketched(df.filter("false"))
    assert nothing.count() == 0 and sketches.quantiles(sketches.merged(nothing, ["path"])).count() == 0

