"""File operators over documents: a document is a file of its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions import paths
from codequarry.limits import SERVICE_LIMITS, Limits
from codequarry.operators import files as file_ops
from registry.common import sql_list, table

# Folders and endings that the path rules tell apart, taken by the document's number.
_PREFIXES = ("", "build/", "a/migrations/versions/", "migrations/versions/", "venv/lib/",
             "pkg/..x/", ".hidden/", "src/")
_ENDINGS = (".py", "_generated.py", ".py", ".lock", ".PY", "/__init__.py", ".min.py")
LIMITS = Limits(file_bytes=4000, repository_files=50, repository_bytes=120_000)


def document_files(spark, d):
    docs = table(spark, d, "documents")
    pick = lambda values, by: F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % by + 1).cast("int")
    )
    path = F.concat(
        pick(_PREFIXES, len(_PREFIXES)),
        F.expr("repeat('lv/', cast(doc_id % 9 as int))"),
        "lang", F.lit("/doc_"), F.col("doc_id").cast("string"), pick(_ENDINGS, len(_ENDINGS)),
    )
    return docs.select(
        F.col("source").alias("repository_id"),
        path.alias("rel_path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("text").cast("binary").alias("content"),
        "doc_id",
    )


FILES_CTE = f"""
files AS (SELECT source AS repository_id, doc_id,
  [{sql_list(_PREFIXES)}][(doc_id % {len(_PREFIXES)} + 1)::INTEGER] || repeat('lv/', doc_id % 9) || lang
    || '/doc_' || doc_id || [{sql_list(_ENDINGS)}][(doc_id % {len(_ENDINGS)} + 1)::INTEGER] AS rel_path,
  strlen(text)::BIGINT AS length, text FROM documents),
named AS (SELECT *, string_split(rel_path, '/') AS parts, string_split(rel_path, '/')[-1] AS name
  FROM files)
"""
_GENERATED = " OR ".join(f"contains(lower(rel_path), '{p}')" for p in V.GENERATED_PATH_PARTS)
_REASON = f"""CASE WHEN contains(rel_path, '..') OR starts_with(rel_path, '/') THEN 'unsafe path'
  WHEN {_GENERATED} OR name IN ({sql_list(V.LOCK_FILE_NAMES)}) OR ends_with(name, '.lock')
    THEN 'generated'
  WHEN length > {LIMITS.file_bytes} THEN 'too large' WHEN length = 0 THEN 'empty' END"""
_CANDIDATE = (
    f"regexp_matches(name, '.\\.py$') AND NOT list_has_any(parts, [{sql_list(V.IGNORED_DIRECTORIES)}])"
)


def file_skip_reason(spark, d):
    files = document_files(spark, d)
    return file_ops.with_skip_reason(files, LIMITS).select(
        "doc_id", "rel_path", "skip_reason",
        paths.in_ignored_directory("rel_path").alias("ignored"),
        paths.ignored_suffix("rel_path").alias("ignored_suffix"),
    )


SKIP_SQL = f"""
WITH {FILES_CTE}
SELECT doc_id, rel_path, {_REASON} AS skip_reason,
  list_has_any(parts, [{sql_list(V.IGNORED_DIRECTORIES)}]) AS ignored,
  regexp_extract(name, '.(\\.[^.]+)$', 1) IN ({sql_list(V.IGNORED_SUFFIXES)}) AS ignored_suffix
FROM named
"""


def file_skip_counts(spark, d):
    return file_ops.skip_counts(document_files(spark, d), LIMITS)


SKIP_COUNTS_SQL = f"""
WITH {FILES_CTE}
SELECT repository_id, {_REASON} AS skip_reason, count(*) AS files, sum(length)::BIGINT AS bytes
FROM named WHERE {_CANDIDATE} GROUP BY 1, 2
"""


def eligible_files(spark, d):
    return file_ops.eligible(document_files(spark, d), LIMITS).select(
        "repository_id", "rel_path", "length"
    )


ELIGIBLE_SQL = f"""
WITH {FILES_CTE}
SELECT repository_id, rel_path, length FROM named WHERE {_CANDIDATE} AND ({_REASON}) IS NULL
"""


def eligible_counts(spark, d):
    return file_ops.eligible_counts(document_files(spark, d), LIMITS)


ELIGIBLE_COUNTS_SQL = f"""
WITH {FILES_CTE}
SELECT repository_id, count(*) AS files FROM named WHERE {_CANDIDATE} AND ({_REASON}) IS NULL GROUP BY 1
"""


def binary_files(spark, d):
    """The binary test on documents and on altered copies of them."""
    docs = document_files(spark, d)
    utf16 = F.encode(F.col("content").cast("string"), "UTF-16LE")
    few_nuls = F.concat(F.lit("\0").cast("binary"), F.repeat(F.lit("x"), 200).cast("binary"))
    return docs.select(
        "doc_id",
        paths.is_binary("content").alias("as_is"),
        paths.is_binary(utf16).alias("utf16"),
        paths.is_binary(F.concat(few_nuls, "content")).alias("few_nuls"),
        paths.is_binary("content", V.BINARY_HEADER_BYTES).alias("by_header"),
        paths.is_binary(F.concat(few_nuls, "content"), V.BINARY_HEADER_BYTES).alias("few_nuls_by_header"),
        paths.is_binary("content", V.BINARY_HEADER_BYTES, strict_header=False).alias("forgiving"),
    )


# A header is not UTF-8 only where it ends inside a character.
_CUT = "coalesce(substr(hex(encode(text)), 2 * {at} + 1, 2) BETWEEN '80' AND 'BF', FALSE)"
BINARY_SQL = f"""
SELECT doc_id, FALSE AS as_is, TRUE AS utf16, FALSE AS few_nuls, {_CUT.format(at=8192)} AS by_header,
  {_CUT.format(at=8192 - 201)} AS few_nuls_by_header, FALSE AS forgiving FROM documents
"""


def repository_limits(spark, d):
    return file_ops.repository_sizes(document_files(spark, d), LIMITS)


_SIZES = f"""
sizes AS (SELECT repository_id, count(*) AS files, sum(length)::BIGINT AS bytes,
  CASE WHEN count(*) > {LIMITS.repository_files} THEN 'too many files'
       WHEN sum(length) > {LIMITS.repository_bytes} THEN 'too many bytes' END AS reject_reason
  FROM files GROUP BY 1)
"""
LIMITS_SQL = f"WITH {FILES_CTE}, {_SIZES} SELECT * FROM sizes"


def files_within_limits(spark, d):
    files = document_files(spark, d)
    kept = file_ops.within_limits(files, file_ops.repository_sizes(files, LIMITS))
    return kept.select("repository_id", "rel_path")


WITHIN_SQL = f"""
WITH {FILES_CTE}, {_SIZES}
SELECT repository_id, rel_path FROM files WHERE repository_id NOT IN
  (SELECT repository_id FROM sizes WHERE reject_reason IS NOT NULL)
"""


def capped_files(spark, d):
    files = document_files(spark, d).select("repository_id", "rel_path")
    return file_ops.cap_files(files, 30)


CAP_SQL = f"""
WITH {FILES_CTE}
SELECT repository_id, rel_path FROM files
QUALIFY row_number() OVER (PARTITION BY repository_id ORDER BY rel_path) <= 30
"""


def path_tree(spark, d):
    return file_ops.tree_rows(document_files(spark, d), SERVICE_LIMITS)


_TREE = f"""
WITH {FILES_CTE},
steps AS (SELECT repository_id, parts, unnest(range(1, len(parts))) AS i FROM named),
dirs AS (SELECT DISTINCT repository_id, array_to_string(parts[1:i], '/') AS path, parts[i] AS name,
    'directory' AS type, i - 1 AS depth FROM steps
  WHERE i <= 7 AND len(list_filter(parts[1:i],
    lambda p: starts_with(p, '.') OR list_contains([{sql_list(V.IGNORED_DIRECTORIES)}], p))) = 0),
leaves AS (SELECT DISTINCT repository_id, rel_path AS path, name, 'file' AS type, len(parts) - 1 AS depth
  FROM named WHERE len(parts) <= 7 AND regexp_matches(name, '.\\.py$') AND len(list_filter(parts[1:-2],
    lambda p: starts_with(p, '.') OR list_contains([{sql_list(V.IGNORED_DIRECTORIES)}], p))) = 0),
tree AS (SELECT * FROM dirs UNION ALL SELECT * FROM leaves)
"""
TREE_SQL = _TREE + """
SELECT repository_id, path,
  CASE WHEN contains(path, '/') THEN left(path, length(path) - length(name) - 1) ELSE '.' END
    AS parent_path, name, type, depth::INTEGER AS depth FROM tree
"""


def path_tree_counts(spark, d):
    return file_ops.tree_totals(path_tree(spark, d))


TREE_COUNTS_SQL = _TREE + """
SELECT repository_id, count(*) FILTER (WHERE type = 'file') AS total_files,
  count(*) FILTER (WHERE type = 'directory') + 1 AS total_directories FROM tree GROUP BY 1
"""


def identical_files(spark, d):
    return file_ops.identical_files(document_files(spark, d))


IDENTICAL_SQL = """
SELECT sha256(text) AS sha256, count(*) AS files, count(DISTINCT source) AS repositories
FROM documents GROUP BY 1 HAVING count(*) > 1
"""

QUERIES = {
    "file_skip_reason": (file_skip_reason, SKIP_SQL),
    "file_skip_counts": (file_skip_counts, SKIP_COUNTS_SQL),
    "eligible_files": (eligible_files, ELIGIBLE_SQL),
    "eligible_counts": (eligible_counts, ELIGIBLE_COUNTS_SQL),
    "binary_files": (binary_files, BINARY_SQL),
    "repository_limits": (repository_limits, LIMITS_SQL),
    "files_within_limits": (files_within_limits, WITHIN_SQL),
    "capped_files": (capped_files, CAP_SQL),
    "path_tree": (path_tree, TREE_SQL),
    "path_tree_counts": (path_tree_counts, TREE_COUNTS_SQL),
    "identical_files": (identical_files, IDENTICAL_SQL),
}
