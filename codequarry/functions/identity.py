"""Stable ids, all hashed in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions.text import col, strip


def repository_id(url: Column | str) -> Column:
    return F.substring(F.sha2(col(url).cast("binary"), 256), 1, 12)


def valid_repository_id(c: Column | str) -> Column:
    # ``$`` would accept a final newline as well; the pattern it stands for does too.
    return F.coalesce(col(c).rlike(V.REPOSITORY_ID_PATTERN), F.lit(False))


def clean_branch(c: Column | str) -> Column:
    return strip(c)


def valid_branch(c: Column | str) -> Column:
    """A missing branch is fine: the default one is meant."""
    return col(c).isNull() | clean_branch(c).rlike(V.BRANCH_PATTERN)


def entity_id(repo: Column, path: Column, kind: Column, name: Column, parent: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", repo, path, kind, name, parent), 256), 1, 16)


def module_id(repo: Column, path: Column) -> Column:
    return entity_id(repo, path, F.lit("Module"), path, F.lit(""))


def class_id(repo: Column, path: Column, name: Column) -> Column:
    return entity_id(repo, path, F.lit("Class"), name, module_id(repo, path))


def content_hash(c: Column | str) -> Column:
    """Whole-file hash; equal values are identical files, across repositories too."""
    return F.sha2(col(c).cast("binary"), 256)
