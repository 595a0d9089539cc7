import pytest
from pyspark.sql import functions as F

from codequarry import schemas
from codequarry.operators import graph
from codequarry.plans import questions, reports
from codequarry.plans.ingest import extract_files


def node(i, name=None, kind="Class", path="m.py", key="r"):
    return (i, key, name or i, kind, path, 1, 2, None)


@pytest.fixture(scope="module")
def small(spark):
    nodes = spark.createDataFrame(
        [node("a"), node("b", "a"), node("c"), node("z", kind="Method"), node("x", key="s", kind="Import")], schemas.NODES)
    edges = spark.createDataFrame(
        [("r", "a", "a", "X"), ("r", "a", "z", "D"), ("r", "b", "gone", "I"), ("r", "c", "a", "D"), ("r", "a", "z", "D"),
         ("s", "q", "x", "D")], schemas.EDGES)
    return nodes, edges


def test_subgraph(small):
    nodes, edges = small
    found, out = graph.subgraph(nodes, edges, "r", 2)
    assert {(r.id, r.on_page) for r in found.collect()} == {("a", True), ("b", True), ("z", False)}
    assert sorted(r.target for r in out.collect()) == ["a", "gone", "z", "z"]
    found, out = graph.subgraph(nodes, edges, "r", 2, 10)
    assert found.count() == out.count() == 0
    found, out = graph.subgraph(nodes, edges, None, 2)
    assert {(r.repository_id, r.id) for r in found.collect()} == {("r", "a"), ("r", "b"), ("r", "z"), ("s", "x")}
    info = {r.repository_id: tuple(r)[1:] for r in graph.subgraph_summary(found, nodes, 2).collect()}
    assert info == {"r": (4, 3, True, True), "s": (1, 1, False, False)}
    assert graph.distinct_edges(edges).count() == 5
    assert {r.target_node_id for r in graph.dangling_edges(edges, nodes).collect()} == {"gone"}
    assert graph.with_endpoints(edges, nodes).count() == 4
    with pytest.raises(ValueError):
        graph.subgraph(nodes, edges, "r", 501)


def test_subgraph_plan(small):
    nodes, edges = small
    _, out = graph.subgraph(nodes, edges, "r", 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "TakeOrderedAndProject" in plan


def test_listing(small):
    nodes, _ = small
    assert [r.id for r in graph.list_entities(nodes, "r", None, 2, 1).collect()] == ["b", "c"]
    assert [r.id for r in graph.list_entities(nodes, "r", "Method").collect()] == ["z"]
    assert graph.list_entities(nodes, "r", "").count() == 4
    assert [tuple(r) for r in graph.module_stats(nodes).collect()] == [("r", "m.py", 3, 0, 1)]
    assert graph.module_stats(nodes, "other.py").count() == 0


def test_overview(spark, small):
    nodes, _ = small
    repos = spark.createDataFrame([("r",), ("s",), ("empty",)], "id string")
    got = {r.repository_id: r.content for r in reports.overview(nodes, repos).collect()}
    assert got["r"] == (
        "# Repository Overview\n\n## Modules\n\n- `m.py`: 3 classes, 0 functions\n\n## Key entities\n\n"
        "- **Class** `a` in `m.py`\n- **Class** `a` in `m.py`\n- **Class** `c` in `m.py`\n- **Method** `z` in `m.py`")
    assert got["s"] == "# Repository Overview\n\n## Modules\n\n\n## Key entities\n\n- **Import** `x` in `m.py`"
    assert got["empty"] == "# Repository Overview\n\n## Modules\n\n\n## Key entities\n"


def test_diagram(spark, small):
    nodes, edges = small
    got = {r.repository_id: r for r in reports.diagram(nodes).collect()}
    assert got["r"].mermaid == (
        'graph TD\n  a["a (Class)"]\n  a["a (Class)"]\n  c["c (Class)"]\n  z["z (Method)"]\n'
        "  a --> a\n  a --> c\n  c --> z")
    assert got["s"].mermaid == 'graph TD\n  x["x (Import)"]'
    assert got["r"].description == "Architecture diagram"
    real = {r.repository_id: r.mermaid for r in reports.diagram(nodes, "module", edges).collect()}
    assert real["r"].split("\n")[5:] == ["  a --> a", "  a --> z", "  c --> a"]
    with pytest.raises(ValueError):
        reports.diagram(nodes, "other")


SOURCE = '''def load_rows(path):
    """Read every row of a parquet table."""
    token = "abcdefghijk"
    return path

def unrelated():
    return "<b>"
'''


@pytest.fixture(scope="module")
def corpus(spark):
    files = spark.createDataFrame([("r", "t.py", len(SOURCE), bytearray(SOURCE.encode()))], schemas.FILES)
    return extract_files(files)


def test_answers(spark, corpus):
    asked = spark.createDataFrame(
        [(1, "r", "  read every row jailbreak of a parquet table "), (2, "nochunks", "what"), (3, "r", ""),
         (4, "unknown", "x" * 5)], "query_id int, repository_id string, question string")
    nodes = corpus.nodes.unionByName(
        spark.createDataFrame([node("n1", "N", "Class", "p.py", "nochunks")], schemas.NODES))
    got = {r.query_id: r for r in questions.answers(asked, corpus.chunks, nodes, 2).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[3].rejected == "empty" and got[3].answer is None and got[1].rejected is None
    assert got[1].question == "read every row  of a parquet table"
    assert [s.name for s in got[1].sources][0] == "load_rows" and len(got[1].sources) == 2
    assert got[1].answer.startswith("**Question:** read every row  of a parquet table\n\n**Retrieved context")
    assert "1. ### Function: `load_rows` — t.py (line 1)...\n\n2. python\n# Function: load_rows" in got[1].answer
    assert "abcdefghijk" not in got[1].answer and "<b>" not in got[1].answer
    assert got[2].sources is None and "1. - Class: `N` in `p.py`..." in got[2].answer
    assert got[4].answer.endswith("AI-generated answers):**\n")


def test_summary(spark, corpus):
    repos = spark.createDataFrame([("r",)], "id string")
    from codequarry.operators.chunks import hashed_vectors

    asked = hashed_vectors(reports.summary_queries(repos, "t.py"), "question")
    text, rows = reports.module_summary(corpus.nodes, corpus.chunks, asked, "t.py")
    assert text.collect()[0].summary.startswith("**Question:** Explain module t.py\n")
    assert [tuple(r) for r in rows.collect()] == [("r", "t.py", 0, 2, 0)]
    with pytest.raises(ValueError):
        reports.summary_queries(repos, "x" * 513)
    assert reports.summary_queries(repos).select(F.col("question")).collect()[0][0].startswith("Summarize")
