"""``source_tree``: folders of source trees as a DataFrame.

Spark's file sources skip names that start with ``_`` or ``.``, ``__init__.py``
among them, so trees are walked here. Below the given root every first-level
folder is a repository, unless the option ``repository_id`` names one.

Options: ``repository_id``, ``content`` (``false`` leaves contents unread),
``pattern`` (file ending, ``.py`` by default, empty for all files),
``max_bytes`` (contents of larger files are not read), ``prune`` (leave out
ignored directories; on where contents are read), ``tasks`` (how finely folders
are split, 64), ``shares`` (parts per folder, 1).
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    InputPartition,
)

from codequarry.fixed_values import IGNORED_DIRECTORIES

_ROWS = 256
_BYTES = 16 * 1024 * 1024


@dataclass
class TreePart(InputPartition):
    repository_id: str
    root: str
    folder: str
    deep: bool
    share: int
    shares: int


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = os.path.abspath(options["path"])
        self.repository = options.get("repository_id")
        self.content = options.get("content", "true").lower() != "false"
        self.pattern = options.get("pattern", ".py")
        self.max_bytes = int(options["max_bytes"]) if "max_bytes" in options else None
        prune = options.get("prune", "true" if self.content else "false").lower() == "true"
        self.closed = frozenset(IGNORED_DIRECTORIES if prune else ())
        self.tasks = int(options.get("tasks", 64))
        self.shares = int(options.get("shares", 1))
        self.only: set[str] | None = None

    def _repositories(self) -> list[tuple[str, str]]:
        if self.repository:
            found = [(self.repository, self.root)]
        else:
            with os.scandir(self.root) as entries:
                found = sorted((e.name, e.path) for e in entries if e.is_dir())
        return [r for r in found if self.only is None or r[0] in self.only]

    def partitions(self) -> list[TreePart]:
        """Split top folders only until there are enough parts; tasks walk the rest."""
        waiting = deque((name, root, "") for name, root in self._repositories())
        parts: list[TreePart] = []
        while waiting and len(waiting) + len(parts) < self.tasks:
            name, root, folder = waiting.popleft()
            with os.scandir(os.path.join(root, folder)) as entries:
                inner = sorted(
                    e.name for e in entries
                    if e.is_dir(follow_symlinks=False) and e.name not in self.closed
                )
            parts += self._share(name, root, folder, deep=False)
            waiting.extend((name, root, os.path.join(folder, d)) for d in inner)
        for name, root, folder in waiting:
            parts += self._share(name, root, folder, deep=True)
        return parts

    def _share(self, name: str, root: str, folder: str, deep: bool) -> list[TreePart]:
        return [TreePart(name, root, folder, deep, i, self.shares) for i in range(self.shares)]

    def _paths(self, part: TreePart):
        top = os.path.join(part.root, part.folder)
        for folder, inner, names in os.walk(top):
            inner[:] = sorted(d for d in inner if d not in self.closed) if part.deep else []
            for name in sorted(names):
                full = os.path.join(folder, name)
                rel = os.path.relpath(full, part.root).replace(os.sep, "/")
                mine = zlib.crc32(rel.encode("utf-8", "replace")) % part.shares == part.share
                if mine and name.endswith(self.pattern) and os.path.isfile(full):
                    yield rel, full

    def read(self, part: TreePart):
        import pyarrow as pa

        rows: list[tuple] = []
        held = 0
        for rel, full in self._paths(part):
            length, data = os.stat(full).st_size, None
            if self.content and (self.max_bytes is None or length <= self.max_bytes):
                with open(full, "rb") as handle:
                    data = handle.read()
            rows.append((part.repository_id, rel, length, data))
            held += len(data or b"")
            if len(rows) >= _ROWS or held >= _BYTES:
                yield _batch(pa, rows)
                rows, held = [], 0
        if rows:
            yield _batch(pa, rows)


class PruningTreeReader(TreeReader):
    """The same, where the session lets Python sources take filters."""

    def pushFilters(self, filters):
        """Take equality on the repository: other repositories are never listed."""
        for condition in filters:
            if isinstance(condition, EqualTo) and condition.attribute == ("repository_id",):
                wanted = {condition.value}
                self.only = wanted if self.only is None else self.only & wanted
            else:
                yield condition


def _batch(pa, rows):
    columns = list(zip(*rows))
    types = [pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["repository_id", "rel_path", "length", "content"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=names
    )


class SourceTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return "repository_id string, rel_path string, length bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        pruning = self.options.get("pushdown", "false").lower() == "true"
        return (PruningTreeReader if pruning else TreeReader)(self.options)


def read_trees(spark: SparkSession, root: str, **options) -> DataFrame:
    spark.dataSource.register(SourceTree)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("source_tree").option("pushdown", pushdown)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load(root)


def stage_files(files: DataFrame, path: str) -> DataFrame:
    """Copy a walked tree into a Parquet table, the input of large jobs."""
    files.write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)
