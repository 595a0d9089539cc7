import random
import re

from pyspark.sql import functions as F

from codequarry.operators import relational as R


def skewed(spark, n=3000):
    """A third of the rows share one key, some have none."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(2000)}", rng.randrange(100))
            for i in range(n)]
    return spark.createDataFrame(rows, "id int, k string, v int").repartition(6)


def keys(spark):
    return spark.createDataFrame([(f"k{i}", i) for i in range(0, 2000, 3)] + [("hot", -1)], "k string, w int")


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_matching_both_ways(spark):
    left, right = skewed(spark), keys(spark)
    for keep in (True, False):
        known = {r.k for r in right.collect()}
        got = {r.id for r in R.matching(left, right, ["k"], keep).collect()}
        assert got == {r.id for r in left.collect() if (r.k in known) == keep}
    rows = {r.id: r.w for r in R.attach(left, right, ["k"]).collect()}
    weights = {r.k: r.w for r in right.collect()}
    assert rows == {r.id: weights.get(r.k) for r in left.collect()}


def test_no_job_while_a_plan_is_built(spark):
    left, right = skewed(spark), keys(spark)
    spark.sparkContext.setJobGroup("plan-only", "")
    R.attach(R.matching(left, right, ["k"]), right, ["k"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_top_n_equals_one_window(spark):
    left = skewed(spark)
    got = R.top_n(left, ["k"], [F.desc("v"), F.col("id")], 5)
    expect = {}
    for r in sorted(left.collect(), key=lambda r: (-r.v, r.id)):
        expect.setdefault(r.k, []).append(r.id)
    want = sorted((k, i + 1, x) for k, ids in ((str(k), ids) for k, ids in expect.items())
                  for i, x in enumerate(ids[:5]))
    assert sorted((str(r.k), r["rank"], r.id) for r in got.collect()) == want
    paged = R.page_per_key(left, ["k"], [F.desc("v"), F.col("id")], 3, 2)
    assert {r.pos for r in paged.collect()} == {3, 4, 5}


def test_pages_and_picks(spark):
    left = skewed(spark)
    assert [r.id for r in R.page(left, [F.col("id")], 3, 2998).collect()] == [2998, 2999]
    assert R.page(left, [F.col("id")], 3, 5000).count() == 0
    first = R.first_wins(left.filter("k is not null"), ["k"], [F.col("id")])
    want = left.filter("k is not null").groupBy("k").agg(F.min("id").alias("id"))
    assert plain(first.select("k", "id")) == plain(want)
    newest = R.latest(left.filter("k is not null"), ["k"], "id")
    assert newest.columns == left.columns
    want = left.filter("k is not null").groupBy("k").agg(F.max("id").alias("id"))
    assert plain(newest.select("k", "id")) == plain(want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    left = skewed(spark)
    text = plan(R.first_wins(left, ["k"], [F.col("id")]))
    assert "WindowGroupLimit" in text and text.count("Exchange hashpartitioning") == 1
    text = plan(R.top_n(left, ["k"], [F.col("id")], 5))
    assert text.count("WindowGroupLimit") == 4
    assert "TakeOrderedAndProject" in plan(R.page(left, [F.col("id")], 5, 5))
    # Two inputs, each read once; broadcast or not is for the run to decide.
    semi = plan(R.matching(left, keys(spark), ["k"]))
    assert semi.count("Scan ExistingRDD") == 2 and "CartesianProduct" not in semi


def test_ranked_pages(spark, tmp_path):
    """Any page equals the sorted table's, and opens its own ranges only."""
    from codequarry.sources.ranked import RankedTable

    rows = [(i, (i * 37) % 50 if i % 11 else None, f"n{i % 5}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x int, name string").repartition(5)
    RankedTable.build(df, str(tmp_path / "r"), ["-x", "id"], range_rows=40)
    ranked = RankedTable(spark, str(tmp_path / "r"), ["-x", "id"])
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert ranked.total() == 400 and ranked.ranges().count() > 5
    for limit, offset in ((10, 0), (25, 200), (60, 333), (10, 395), (10, 400), (400, 0)):
        got = sorted(ranked.page(limit, offset).collect(), key=lambda r: r["rank"])
        assert [tuple(r)[:3] for r in got] == want[offset:offset + limit]
        assert [r["rank"] for r in got] == list(range(offset + 1, offset + 1 + len(got)))
    page = ranked.page(10, 230)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"_range#\d+ (= \d+|IN)", plan)
    held = ranked.ranges().filter("before < 240 AND before + n > 230").count()
    assert 0 < held <= 2 < ranked.ranges().count()
    empty = RankedTable.build(df.filter("false"), str(tmp_path / "none"), ["id"])
    assert empty.total() == 0


def test_ranks_of_many_small_ranges_need_few_files(spark, tmp_path):
    from codequarry.sources.ranked import RankedTable

    df = spark.range(3000).selectExpr("id", "id % 7 AS x").repartition(4)
    ranked = RankedTable.build(df, str(tmp_path / "many"), ["x", "-id"], range_rows=5)
    assert ranked.total() == 3000 and ranked.ranges().count() == 600
    assert len(ranked._rows().inputFiles()) == 1
    want = sorted(((i, i % 7) for i in range(3000)), key=lambda r: (r[1], -r[0]))
    assert [tuple(r)[:2] for r in ranked.page(12, 1501).orderBy("rank").collect()] == want[1501:1513]


def test_ranks_across_files(spark, tmp_path, monkeypatch):
    from codequarry.sources import ranked as module

    monkeypatch.setattr(module, "FILE_ROWS", 300)
    df = spark.range(2000).selectExpr("id", "id % 11 AS x").repartition(3)
    ranked = module.RankedTable.build(df, str(tmp_path / "files"), ["-x", "id"], range_rows=40)
    assert len(ranked._rows().inputFiles()) > 3
    want = sorted(((i, i % 11) for i in range(2000)), key=lambda r: (-r[1], r[0]))
    for limit, offset in ((50, 0), (700, 650), (10, 1995)):
        got = ranked.page(limit, offset).orderBy("rank").collect()
        assert [tuple(r)[:2] for r in got] == want[offset:offset + limit]
        assert [r["rank"] for r in got] == list(range(offset + 1, offset + 1 + len(got)))
