"""Registered queries against their SQL, and the pipeline against a plain version."""

import sys

import pytest
from check_oracle import compare, connect

import corpus_pipeline
from codequarry.llm import decontaminate, lines, mixing, nearjoin, rules
from codequarry.llm.queries import QUERIES

from .conftest import SCHEMA


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline"])
def test_query(spark, sf_dir, name):
    run, sql = QUERIES[name]
    assert compare(spark, connect(sf_dir), run, sql, sf_dir) is None


def test_pipeline_is_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names, step = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = step.count()
        step = stage(spark, step, sf_dir).cache()
        assert step.columns == names
        assert 0 < step.count() <= before, name
    assert {r.kept for r in rules.judge(step).select("quality.base_failed").withColumnRenamed("base_failed", "kept").collect()}
    assert decontaminate.find(step, bench).filter("size(leaks) > 0").count() == 0
    assert nearjoin.join(step).filter("n_links > 0 OR n_copies > 1").count() == 0
    want = sorted(str(tuple(r)) for r in mixing.take(step).collect())
    got = sorted(str(tuple(r)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == want and got
    kept = {r.doc_id for r in rules.keep(docs).collect()}
    assert {r.doc_id for r in step.collect()} <= kept
    assert lines.MIN_DOCUMENTS == 10


def test_pipeline_stages_on_odd_rows(spark, sf_dir, odd, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, sf_dir).count() <= odd.count(), name
        assert stage(spark, none, sf_dir).count() == 0, name
    assert SCHEMA and "codequarry.llm" in sys.modules
