"""Node and edge tables: statistics, pages, subgraphs, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.relational import (
    first_wins,
    page,
    page_per_key,
)

KEY = "repository_id"


def _by_name():
    return [F.col("name"), F.col("id")]


def of_repository(df: DataFrame, repository_id: str, key: str = KEY) -> DataFrame:
    return df.filter(F.col(key) == repository_id)


def by_id(df: DataFrame, wanted: str) -> DataFrame:
    return df.filter(F.col("id") == wanted)


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.dropDuplicates([KEY, "source_node_id", "target_node_id", "edge_type"])


def module_stats(nodes: DataFrame, module_path: str | None = None) -> DataFrame:
    """Classes, functions and methods of each file that has any."""
    counted = nodes.filter(F.col("node_type").isin(*V.COUNTED_TYPES))
    if module_path:
        counted = counted.filter(F.col("file_path") == module_path)
    of_type = lambda t: F.count_if(F.col("node_type") == t)
    return counted.groupBy(KEY, F.col("file_path").alias("path")).agg(
        of_type("Class").alias("classes"),
        of_type("Function").alias("functions"),
        of_type("Method").alias("methods"),
    )


def type_counts(nodes: DataFrame) -> DataFrame:
    counted = nodes.filter(F.col("node_type").isin(*V.COUNTED_TYPES))
    return counted.groupBy(KEY, "file_path", "node_type").agg(F.count(F.lit(1)).alias("n"))


def _of_type(nodes: DataFrame, entity_type: str | None) -> DataFrame:
    return nodes.filter(F.col("node_type") == entity_type) if entity_type else nodes


def _listing(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.select(
        "id", KEY, "name", F.col("node_type").alias("type"), "file_path", *more
    )


def list_entities(
    nodes: DataFrame, repository_id: str, entity_type: str | None = None,
    limit: int = DEFAULT_LIMITS.entity_rows, offset: int = 0,
) -> DataFrame:
    """One page of a repository's entities by name."""
    wanted = _of_type(of_repository(nodes, repository_id), entity_type)
    return page(_listing(wanted), _by_name(), limit, offset)


def list_entities_per_repository(
    nodes: DataFrame, entity_type: str | None = None,
    limit: int = DEFAULT_LIMITS.entity_rows, offset: int = 0,
) -> DataFrame:
    """The same page of every repository, with ``pos`` counting from 1."""
    wanted = _listing(_of_type(nodes, entity_type))
    return page_per_key(wanted, [KEY], _by_name(), limit, offset)


def _shown(nodes: DataFrame, *more: str) -> DataFrame:
    return nodes.select(
        KEY, "id", F.col("name").alias("label"), F.col("node_type").alias("type"), "file_path",
        *more,
    )


def subgraph(
    nodes: DataFrame, edges: DataFrame, repository_id: str | None = None,
    limit: int = DEFAULT_LIMITS.graph_rows, offset: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Nodes of a page with the targets of their edges, and those edges.

    For one repository the page is at most ``graph_rows_max`` rows and is
    broadcast to the edges; without one, every repository gives its page.
    """
    if not 1 <= limit <= DEFAULT_LIMITS.graph_rows_max:
        raise ValueError(f"limit must be 1 to {DEFAULT_LIMITS.graph_rows_max}")
    if repository_id is not None:
        nodes = of_repository(nodes, repository_id)
        edges = of_repository(edges, repository_id)
        on_page = page(nodes, _by_name(), limit, offset)
        sources = F.broadcast(on_page.select(KEY, F.col("id").alias("source_node_id")))
        out = edges.join(sources, [KEY, "source_node_id"], "left_semi")
    else:
        on_page = page_per_key(nodes, [KEY], _by_name(), limit, offset).drop("pos")
        sources = on_page.select(KEY, F.col("id").alias("source_node_id"))
        out = edges.join(sources, [KEY, "source_node_id"], "left_semi")
    target_ids = out.select(KEY, F.col("target_node_id").alias("id")).distinct()
    targets = nodes.join(target_ids, [KEY, "id"], "left_semi")
    both = _shown(on_page).withColumn("on_page", F.lit(True)).unionByName(
        _shown(targets).withColumn("on_page", F.lit(False))
    )
    # A target that is on the page as well appears once, as a page node.
    found = both.groupBy(KEY, "id", "label", "type", "file_path").agg(
        F.max("on_page").alias("on_page")
    )
    shown_edges = out.select(
        KEY, F.col("source_node_id").alias("source"), F.col("target_node_id").alias("target"),
        F.col("edge_type").alias("type"),
    )
    return found, shown_edges


def subgraph_summary(found: DataFrame, nodes: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """Counts per repository and whether a further page exists.

    ``has_more_listed`` counts targets too, as the listing does; ``has_more``
    compares the page's end with the number of nodes.
    """
    totals = nodes.groupBy(KEY).agg(F.count(F.lit(1)).alias("total"))
    listed = found.groupBy(KEY).agg(F.count(F.lit(1)).alias("listed"))
    return totals.join(listed, KEY, "left").select(
        KEY,
        "total",
        F.coalesce("listed", F.lit(0)).alias("listed"),
        (F.coalesce("listed", F.lit(0)) >= limit).alias("has_more_listed"),
        (F.col("total") > offset + limit).alias("has_more"),
    )


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose target is no node; one target may own many of the edges."""
    known = nodes.select(KEY, F.col("id").alias("target_node_id"))
    return edges.join(known, [KEY, "target_node_id"], "left_anti")


def dangling_targets(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Missing targets with the number of edges to them, counted before the join."""
    wanted = edges.groupBy(KEY, "target_node_id").agg(F.count(F.lit(1)).alias("edges"))
    known = nodes.select(KEY, F.col("id").alias("target_node_id"))
    return wanted.join(known, [KEY, "target_node_id"], "left_anti")


def first_entities(df: DataFrame) -> DataFrame:
    """First occurrence of each id in walk order."""
    return first_wins(df, [KEY, "id"], [F.col("ordinal")])


def with_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the names and types of both ends (inner: dangling ones drop)."""
    named = lambda end: nodes.select(
        KEY, F.col("id").alias(f"{end}_node_id"), F.col("name").alias(f"{end}_name"),
        F.col("node_type").alias(f"{end}_type"),
    )
    joined = edges.join(named("source"), [KEY, "source_node_id"], "inner")
    return joined.join(named("target"), [KEY, "target_node_id"], "inner")
