"""Graph reads over nodes and edges made of the star schema, keyed by region."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry.operators import graph
from codequarry.operators.relational import first_wins
from registry.common import table

KEY = "repository_id"
LIMIT, OFFSET = 200, 200


def star_nodes(spark, d):
    """Regions, nations, customers and suppliers as nodes of their region."""
    nation = table(spark, d, "nation")
    # 25 rows at every scale
    place = F.broadcast(nation.select("n_nationkey", "n_name", "n_regionkey"))
    key = lambda c: F.concat(F.lit("R"), c.cast("string"))
    node = lambda df, k, i, name, kind, path: df.select(
        i.alias("id"), k.alias(KEY), name.alias("name"), kind.alias("node_type"), path.alias("file_path"),
        F.length(name).alias("start_line"), F.lit(None).cast("int").alias("end_line"),
        F.lit(None).cast("string").alias("content"),
    )
    tag = lambda kind, c: F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    region = table(spark, d, "region")
    customer = table(spark, d, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = table(spark, d, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    file = F.concat(F.lower("n_name"), F.lit(".py"))
    made = [
        node(region, key(F.col("r_regionkey")), tag("region", "r_regionkey"), F.col("r_name"),
             F.lit("Module"), F.lit("region.py")),
        node(nation, key(F.col("n_regionkey")), tag("nation", "n_nationkey"), F.col("n_name"),
             F.lit("Class"), file),
        node(customer, key(F.col("n_regionkey")), tag("customer", "c_custkey"), F.col("c_name"),
             F.when(F.col("c_acctbal") < 0, "Function").otherwise("Method"), file),
        node(supplier, key(F.col("n_regionkey")), tag("supplier", "s_suppkey"), F.col("s_name"),
             F.lit("Import"), file),
    ]
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def star_edges(spark, d):
    """Foreign keys as edges; market segments are targets without a node."""
    nation = table(spark, d, "nation")
    place = F.broadcast(nation.select("n_nationkey", "n_regionkey"))
    customer = table(spark, d, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = table(spark, d, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    tag = lambda kind, c: F.concat(F.lit(kind + ":"), F.col(c).cast("string"))
    edge = lambda df, source, target, kind: df.select(
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias(KEY),
        source.alias("source_node_id"), target.alias("target_node_id"), F.lit(kind).alias("edge_type"),
    )
    return (
        edge(nation, tag("region", "n_regionkey"), tag("nation", "n_nationkey"), "CONTAINS")
        .unionByName(edge(customer, tag("nation", "c_nationkey"), tag("customer", "c_custkey"), "DEFINES"))
        .unionByName(edge(supplier, tag("nation", "s_nationkey"), tag("supplier", "s_suppkey"), "IMPORTS"))
        .unionByName(edge(customer, tag("customer", "c_custkey"), tag("segment", "c_mktsegment"), "INHERITS"))
    )


GRAPH_CTE = """
nodes AS (
  SELECT 'region:' || r_regionkey AS id, 'R' || r_regionkey AS repository_id, r_name AS name,
    'Module' AS node_type, 'region.py' AS file_path FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'R' || n_regionkey, n_name, 'Class', lower(n_name) || '.py'
    FROM nation
  UNION ALL SELECT 'customer:' || c_custkey, 'R' || n_regionkey, c_name,
    CASE WHEN c_acctbal < 0 THEN 'Function' ELSE 'Method' END, lower(n_name) || '.py'
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'supplier:' || s_suppkey, 'R' || n_regionkey, s_name, 'Import', lower(n_name) || '.py'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
edges AS (
  SELECT 'R' || n_regionkey AS repository_id, 'region:' || n_regionkey AS source, 'nation:' || n_nationkey
    AS target, 'CONTAINS' AS type FROM nation
  UNION ALL SELECT 'R' || n_regionkey, 'nation:' || c_nationkey, 'customer:' || c_custkey, 'DEFINES'
    FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'R' || n_regionkey, 'nation:' || s_nationkey, 'supplier:' || s_suppkey, 'IMPORTS'
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'R' || n_regionkey, 'customer:' || c_custkey, 'segment:' || c_mktsegment, 'INHERITS'
    FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


def _page_cte(where: str, limit: int, offset: int) -> str:
    return f"""
page AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY name, id) AS pos
  FROM nodes) WHERE pos > {offset} AND pos <= {offset + limit} {where}),
out_edges AS (SELECT e.* FROM edges e SEMI JOIN page p ON p.repository_id = e.repository_id AND p.id = e.source),
found AS (SELECT repository_id, id, name AS label, node_type AS type, file_path, TRUE AS on_page FROM page
  UNION ALL SELECT n.repository_id, n.id, n.name, n.node_type, n.file_path, FALSE FROM nodes n
    SEMI JOIN out_edges e ON e.repository_id = n.repository_id AND e.target = n.id
    ANTI JOIN page p ON p.repository_id = n.repository_id AND p.id = n.id)
"""


def _all(spark, d):
    return graph.subgraph(star_nodes(spark, d), star_edges(spark, d), None, LIMIT, OFFSET)


def _one(spark, d):
    return graph.subgraph(star_nodes(spark, d), star_edges(spark, d), "R1", 500)


_ALL_CTE = _page_cte("", LIMIT, OFFSET)
_ONE_CTE = _page_cte("AND repository_id = 'R1'", 500, 0)


def subgraph_page_info(spark, d):
    nodes = star_nodes(spark, d)
    found, _ = _all(spark, d)
    return graph.subgraph_summary(found, nodes, LIMIT, OFFSET)


def module_stats(spark, d):
    docs = table(spark, d, "documents")
    kinds = F.when(F.col("lang") == "en", "Class").when(F.col("lang") == "fr", "Function").when(
        F.col("lang") == "de", "Method").otherwise("Import")
    nodes = docs.select(
        F.lit("docs").alias(KEY), F.col("source").alias("file_path"), kinds.alias("node_type")
    )
    return graph.module_stats(nodes)


MODULE_STATS_SQL = """
SELECT 'docs' AS repository_id, source AS path, count(*) FILTER (WHERE lang = 'en') AS classes,
  count(*) FILTER (WHERE lang = 'fr') AS functions, count(*) FILTER (WHERE lang = 'de') AS methods
FROM documents WHERE lang IN ('en', 'fr', 'de') GROUP BY source
"""


def type_counts(spark, d):
    return graph.type_counts(star_nodes(spark, d))


def _parts_as_nodes(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias(KEY), F.col("p_name").alias("name"),
        F.col("p_type").alias("node_type"), F.col("p_brand").alias("file_path"),
    )


def entity_page(spark, d):
    """Third page of a brand's parts of one type."""
    return graph.list_entities(_parts_as_nodes(spark, d), "Brand#11", None, 20, 40)


def entity_page_per_repository(spark, d):
    return graph.list_entities_per_repository(_parts_as_nodes(spark, d), "SMALL", 5, 5)


def first_occurrence(spark, d):
    docs = table(spark, d, "documents").withColumn("content_id", F.sha2("text", 256))
    picked = first_wins(docs.select("content_id", "doc_id", "source"), ["content_id"], [F.col("doc_id")])
    return picked


def edge_distinct(spark, d):
    return graph.distinct_edges(table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias(KEY), F.col("l_suppkey").alias("source_node_id"),
        F.col("l_partkey").alias("target_node_id"), F.col("l_linestatus").alias("edge_type"),
    ))


def dangling_edges(spark, d):
    return graph.dangling_edges(star_edges(spark, d), star_nodes(spark, d))


def dangling_targets(spark, d):
    return graph.dangling_targets(star_edges(spark, d), star_nodes(spark, d))


def edge_endpoints(spark, d):
    return graph.with_endpoints(star_edges(spark, d), star_nodes(spark, d))


QUERIES = {
    "subgraph_nodes": (
        lambda s, d: _one(s, d)[0], f"WITH {GRAPH_CTE}, {_ONE_CTE} SELECT * FROM found",
    ),
    "subgraph_edges": (
        lambda s, d: _one(s, d)[1], f"WITH {GRAPH_CTE}, {_ONE_CTE} SELECT * FROM out_edges",
    ),
    "subgraph_nodes_per_repository": (
        lambda s, d: _all(s, d)[0], f"WITH {GRAPH_CTE}, {_ALL_CTE} SELECT * FROM found",
    ),
    "subgraph_edges_per_repository": (
        lambda s, d: _all(s, d)[1], f"WITH {GRAPH_CTE}, {_ALL_CTE} SELECT * FROM out_edges",
    ),
    "subgraph_page_info": (
        subgraph_page_info,
        f"""WITH {GRAPH_CTE}, {_ALL_CTE},
        t AS (SELECT repository_id, count(*) AS total FROM nodes GROUP BY 1),
        l AS (SELECT repository_id, count(*) AS n FROM found GROUP BY 1)
        SELECT repository_id, total, coalesce(n, 0) AS listed, coalesce(n, 0) >= {LIMIT} AS has_more_listed,
          total > {LIMIT + OFFSET} AS has_more FROM t LEFT JOIN l USING (repository_id)""",
    ),
    "module_stats": (module_stats, MODULE_STATS_SQL),
    "type_counts": (
        type_counts,
        f"""WITH {GRAPH_CTE} SELECT repository_id, file_path, node_type, count(*) AS n FROM nodes
        WHERE node_type IN ('Class', 'Function', 'Method') GROUP BY 1, 2, 3""",
    ),
    "entity_page": (
        entity_page,
        """SELECT p_partkey AS id, p_brand AS repository_id, p_name AS name, p_type AS type,
          p_brand AS file_path FROM part WHERE p_brand = 'Brand#11'
        ORDER BY p_name, p_partkey LIMIT 20 OFFSET 40""",
    ),
    "entity_page_per_repository": (
        entity_page_per_repository,
        """SELECT * FROM (SELECT p_partkey AS id, p_brand AS repository_id, p_name AS name,
          p_type AS type, p_brand AS file_path,
          (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey))::INTEGER AS pos
        FROM part WHERE p_type = 'SMALL') WHERE pos BETWEEN 6 AND 10""",
    ),
    "first_occurrence": (
        first_occurrence,
        """SELECT sha256(text) AS content_id, doc_id, source FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    ),
    "edge_distinct": (
        edge_distinct,
        """SELECT DISTINCT l_returnflag AS repository_id, l_suppkey AS source_node_id,
          l_partkey AS target_node_id, l_linestatus AS edge_type FROM lineitem""",
    ),
    "dangling_edges": (
        dangling_edges,
        f"""WITH {GRAPH_CTE} SELECT repository_id, source AS source_node_id, target AS target_node_id,
          type AS edge_type FROM edges ANTI JOIN nodes ON nodes.id = target
          AND nodes.repository_id = edges.repository_id""",
    ),
    "dangling_targets": (
        dangling_targets,
        f"""WITH {GRAPH_CTE} SELECT repository_id, target AS target_node_id, count(*) AS edges FROM edges
        ANTI JOIN nodes ON nodes.id = target AND nodes.repository_id = edges.repository_id GROUP BY 1, 2""",
    ),
    "edge_endpoints": (
        edge_endpoints,
        f"""WITH {GRAPH_CTE} SELECT e.repository_id, source AS source_node_id, target AS target_node_id,
          type AS edge_type, a.name AS source_name, a.node_type AS source_type, b.name AS target_name,
          b.node_type AS target_type FROM edges e
        JOIN nodes a ON a.id = source AND a.repository_id = e.repository_id
        JOIN nodes b ON b.id = target AND b.repository_id = e.repository_id""",
    ),
}
