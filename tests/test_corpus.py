"""Real source code: packages of the standard library as repositories."""

import os

import pytest
from pyspark.sql import functions as F

from codequarry.operators import files as file_ops
from codequarry.operators import graph
from codequarry.plans import reports
from codequarry.plans.ingest import extract_files
from codequarry.session import materialise
from codequarry.sources.tree import read_trees

LIBRARY = "/opt/py313/lib/python3.13"
KEY = "repository_id"


@pytest.fixture(scope="module")
def files(spark):
    if not os.path.isdir(LIBRARY):
        pytest.skip("no standard library here")
    return materialise(read_trees(spark, LIBRARY).filter(F.col(KEY) == "asyncio").unionByName(
        read_trees(spark, LIBRARY).filter(F.col(KEY) == "email")), "library")


@pytest.fixture(scope="module")
def made(files):
    found = extract_files(files)
    return {name: materialise(getattr(found, name), name) for name in ("entities", "nodes", "edges", "chunks")}


def test_files(files):
    on_disk = sum(
        name.endswith(".py") for package in ("asyncio", "email")
        for folder, _, names in os.walk(f"{LIBRARY}/{package}") if "__pycache__" not in folder for name in names)
    assert files.count() == on_disk
    assert files.filter(F.col("rel_path") == "__init__.py").count() == 2
    assert {r.repository_id for r in file_ops.eligible_counts(files).collect()} == {"asyncio", "email"}


def test_invariants(made):
    nodes, edges, chunks = made["nodes"], made["edges"], made["chunks"]
    total = nodes.count()
    assert total == nodes.select(KEY, "id").distinct().count() > 1000
    owned = edges.filter(F.col("edge_type") != "INHERITS").groupBy(KEY, "target_node_id").count()
    assert owned.filter("count <> 1").count() == 0
    assert owned.count() == nodes.filter("node_type <> 'Module'").count()
    owners = nodes.select(KEY, nodes["id"].alias("entity_id"))
    assert chunks.join(owners, [KEY, "entity_id"], "left_anti").count() == 0
    assert chunks.filter("part = 1").count() == nodes.filter("node_type <> 'Import'").count() < chunks.count()
    assert graph.dangling_edges(edges.filter("edge_type <> 'INHERITS'"), nodes).count() == 0
    assert graph.distinct_edges(edges).count() == edges.count()
    first = graph.first_entities(made["entities"])
    assert first.count() == total


def test_reports(made):
    text = {r.repository_id: r.content for r in reports.overview(made["nodes"]).collect()}
    assert "- `base_events.py`: " in text["asyncio"] and text["email"].startswith("# Repository Overview\n")
    drawn = reports.diagram(made["nodes"]).collect()
    assert all(r.mermaid.startswith("graph TD\n  ") and r.mermaid.count(" --> ") == 14 for r in drawn)
