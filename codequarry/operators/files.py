"""File tables: eligibility, repository limits, directory trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions import identity, paths
from codequarry.limits import DEFAULT_LIMITS, Limits
from codequarry.operators.extract import language_of
from codequarry.operators.relational import attach, matching, top_n

KEY = "repository_id"


def source_candidates(files: DataFrame) -> DataFrame:
    """Files of a known language, outside ignored directories and endings."""
    return files.filter(
        language_of("rel_path").isNotNull()
        & ~paths.in_ignored_directory("rel_path")
        & ~paths.ignored_suffix("rel_path")
    )


def with_skip_reason(
    files: DataFrame, limits: Limits = DEFAULT_LIMITS, strict_header: bool = True
) -> DataFrame:
    content = "content" if "content" in files.columns else None
    return files.withColumn(
        "skip_reason", paths.skip_reason("rel_path", "length", content, limits, strict_header)
    )


def eligible(
    files: DataFrame, limits: Limits = DEFAULT_LIMITS, strict_header: bool = True
) -> DataFrame:
    """Files to extract. Path and size rules reach the scan; content comes last."""
    candidates = source_candidates(files).filter(F.col("length") > 0)
    if limits.file_bytes is not None:
        candidates = candidates.filter(F.col("length") <= limits.file_bytes)
    kept = with_skip_reason(candidates, limits, strict_header)
    return kept.filter(F.col("skip_reason").isNull()).drop("skip_reason")


def skip_counts(files: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    marked = with_skip_reason(source_candidates(files), limits)
    return marked.groupBy(KEY, "skip_reason").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def eligible_counts(files: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return eligible(files, limits).groupBy(KEY).agg(F.count(F.lit(1)).alias("files"))


def repository_sizes(all_files: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Files and bytes of each repository, with the limit it breaks, if any."""
    counted = all_files.filter(~F.array_contains(paths.parts("rel_path"), ".git"))
    sizes = counted.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    reason = F.lit(None).cast("string")
    if limits.repository_bytes is not None:
        reason = F.when(F.col("bytes") > limits.repository_bytes, "too many bytes")
    if limits.repository_files is not None:
        reason = F.when(F.col("files") > limits.repository_files, "too many files").otherwise(reason)
    return sizes.withColumn("reject_reason", reason)


def within_limits(files: DataFrame, sizes: DataFrame) -> DataFrame:
    """Drop every file of a repository that ``repository_sizes`` rejects."""
    rejected = sizes.filter(F.col("reject_reason").isNotNull())
    return matching(files, rejected, [KEY], keep=False)


def cap_files(files: DataFrame, cap: int) -> DataFrame:
    """First ``cap`` files of a repository in path order.

    Only the paths of repositories over the limit are ranked, and each gives
    one last path; the files themselves, contents included, are only filtered.
    """
    sizes = files.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    over = sizes.filter(F.col("_n") > cap).select(KEY)
    names = matching(files.select(KEY, "rel_path"), over, [KEY])
    last = top_n(names, [KEY], [F.col("rel_path")], cap).filter(F.col("rank") == cap)
    last = last.select(KEY, F.col("rel_path").alias("_last"))
    bounded = attach(files, last, [KEY])
    inside = F.col("_last").isNull() | (F.col("rel_path") <= F.col("_last"))
    return bounded.filter(inside).drop("_last")


def tree_rows(all_files: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Directory tree as adjacency rows, from paths alone.

    Hidden and ignored directories are pruned with all below them; directories
    go down to the depth limit, if there is one, and source files no deeper.
    """
    depth_cap = limits.tree_depth
    all_parts = paths.parts("rel_path")
    base = all_files.select(KEY, "rel_path", all_parts.alias("parts"))
    hidden = lambda d: d.startswith(".") | d.isin(*V.IGNORED_DIRECTORIES)
    base = base.withColumn("dirs", F.expr("slice(parts, 1, size(parts) - 1)"))
    # Directories before the first hidden one; all of them where none is hidden.
    flags = F.transform("dirs", hidden)
    first_hidden = F.array_position(flags, F.lit(True)).cast("int")
    open_dirs = F.when(first_hidden > 0, first_hidden - 1).otherwise(F.size("dirs"))
    base = base.withColumn("_open", open_dirs)
    steps = F.col("_open") if depth_cap is None else F.least(F.col("_open"), F.lit(depth_cap + 1))
    dir_rows = F.when(
        steps > 0,
        F.transform(
            F.sequence(F.lit(1), steps),
            lambda i: F.struct(
                F.array_join(F.slice("parts", F.lit(1), i), "/").alias("path"),
                F.lit("directory").alias("type"),
            ),
        ),
    ).otherwise(F.expr("cast(array() as array<struct<path:string,type:string>>)"))
    visible_file = (
        (F.col("_open") == F.size("dirs"))
        & (F.lit(True) if depth_cap is None else F.size("dirs") <= depth_cap)
        & (paths.suffix("rel_path") == ".py")
    )
    file_row = F.when(
        visible_file,
        F.array(F.struct(F.col("rel_path").alias("path"), F.lit("file").alias("type"))),
    ).otherwise(F.expr("cast(array() as array<struct<path:string,type:string>>)"))
    exploded = base.select(KEY, F.explode(F.concat(dir_rows, file_row)).alias("r"))
    rows = exploded.select(KEY, "r.path", "r.type").distinct()
    return rows.select(
        KEY,
        "path",
        F.when(F.col("path").contains("/"), paths.parent_path("path")).otherwise(".").alias(
            "parent_path"
        ),
        paths.file_name("path").alias("name"),
        "type",
        (F.size(paths.parts("path")) - 1).alias("depth"),
    )


def tree_totals(tree: DataFrame) -> DataFrame:
    """Files and directories per repository; its root counts as one directory."""
    return tree.groupBy(KEY).agg(
        F.count_if(F.col("type") == "file").alias("total_files"),
        (F.count_if(F.col("type") == "directory") + 1).alias("total_directories"),
    )


def tree_order():
    """Sort columns that list a tree as a walk does: part by part."""
    return [F.col(KEY), F.split("path", "/")]


def file_hashes(files: DataFrame) -> DataFrame:
    return files.select(KEY, "rel_path", identity.content_hash("content").alias("sha256"))


def identical_files(files: DataFrame) -> DataFrame:
    """Contents held by more than one file: how many files and repositories."""
    hashed = file_hashes(files).groupBy("sha256", KEY).agg(F.count(F.lit(1)).alias("n"))
    return (
        hashed.groupBy("sha256")
        .agg(F.sum("n").alias("files"), F.count(F.lit(1)).alias("repositories"))
        .filter(F.col("files") > 1)
    )
