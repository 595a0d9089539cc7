"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
    "vector": T.ArrayType(T.FloatType()),
    "bases": T.ArrayType(
        T.StructType().add("name", T.StringType()).add("repeated", T.BooleanType())
    ),
}


def _schema(spec: str) -> T.StructType:
    """``name type`` pairs; usable before a session exists."""
    fields = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


FILES = _schema("repository_id string, rel_path string, length bigint, content binary")

REPOSITORIES = _schema(
    "id string, url string, name string, local_path string, default_branch string, "
    "language string, status string, error_message string, file_count int, "
    "entity_count int, structure_path string, created_at timestamp, updated_at timestamp"
)

INGEST_RUNS = _schema(
    "id string, repository_id string, status string, stage string, progress int, "
    "retry_count int, cancelled boolean, error_message string, created_at timestamp, "
    "completed_at timestamp, seq bigint"
)

CHUNKS = _schema(
    "id string, entity_id string, part int, repository_id string, file_path string, "
    "entity_name string, entity_type string, content string, line_start int, line_end int, "
    "embedding vector"
)

NODES = _schema(
    "id string, repository_id string, name string, node_type string, file_path string, "
    "start_line int, end_line int, content string"
)

EDGES = _schema(
    "repository_id string, source_node_id string, target_node_id string, edge_type string"
)

SNAPSHOTS = _schema(
    "repository_id string, table string, current string, removed boolean, seq bigint"
)

TREE = _schema(
    "repository_id string, path string, parent_path string, name string, type string, depth int"
)

# What the per-file visitor reports; everything else is derived from it in Spark.
FACTS = _schema(
    "repository_id string, rel_path string, ordinal int, kind string, name string, "
    "owner string, line_start int, line_end int, signature string, docstring string, "
    "content string, bases bases, repeated boolean, "
    "parse_error string"
)
