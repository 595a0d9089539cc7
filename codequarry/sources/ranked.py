"""Pages of a sorted table at any offset, each read from the range that holds it.

A table is written once in ranges of its order, with the rank at which each range starts.
Ranges that follow one another lie in one sorted file, in a folder of its own, so files, tasks
and what they tell the driver grow with the rows and not with the ranges. A page at any offset
then opens the files of the ranges that it overlaps, mostly one, reads those ranges and sorts
no more than them. An offset on the plain table sorts all rows up to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RANGE_ROWS = 100_000
# Rows that are sorted in one task and lie in one file; at least a range.
FILE_ROWS = 250_000


def _order(names: Sequence[str]) -> list[Column]:
    """``name`` ascending, ``-name`` descending; nulls last either way."""
    return [F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc_nulls_last() for n in names]


class RankedTable:
    """A table in the order of ``by`` (which should tell its rows apart), below ``path``; written by ``build``."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str]):
        self.spark, self.path, self.by = spark, path.rstrip("/"), list(by)

    @classmethod
    def build(cls, rows: DataFrame, path: str, by: Sequence[str], range_rows: int = RANGE_ROWS) -> RankedTable:
        made = cls(rows.sparkSession, path, by)
        rows.limit(0).coalesce(1).write.mode("errorifexists").parquet(f"{made.path}/columns")
        file_rows = max(range_rows, FILE_ROWS)
        ranged = rows.repartitionByRange(max(1, -(-rows.count() // file_rows)), *_order(by)).sortWithinPartitions(*_order(by))
        # Number of the task, and the row's place in it.
        placed = ranged.withColumn("_at", F.monotonically_increasing_id())
        file = F.shiftright("_at", 33)
        within = F.floor((F.col("_at") - F.shiftleft(file, 33)) / range_rows)
        placed = placed.withColumns({"_file": file.cast("int"), "_range": within.cast("int")}).drop("_at")
        placed.sortWithinPartitions("_file", "_range").write.partitionBy("_file").mode("errorifexists").parquet(f"{made.path}/rows")
        sizes = made._rows().groupBy("_file", "_range").agg(F.count(F.lit(1)).alias("n"))
        # As many rows as there are ranges.
        before = Window.orderBy("_file", "_range").rowsBetween(Window.unboundedPreceding, -1)
        sizes.select("_file", "_range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).coalesce(1).write.parquet(
            f"{made.path}/ranges")
        return made

    def _rows(self) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.path}/columns").schema.add("_range", T.IntegerType()).add("_file", T.IntegerType())
        return self.spark.read.schema(columns).parquet(f"{self.path}/rows")

    def ranges(self) -> DataFrame:
        """``_file, _range, n, before``: rows of each range of a file and in front of it."""
        return self.spark.read.parquet(f"{self.path}/ranges")

    def total(self) -> int:
        return self.ranges().agg(F.sum("n")).first()[0] or 0

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """Rows ``offset`` + 1 to ``offset`` + ``limit`` with their ``rank`` from 1."""
        held = self.ranges().filter((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset))
        held = held.collect()
        ranges_of: dict[int, list[int]] = {}
        for r in held:
            ranges_of.setdefault(r["_file"], []).append(r["_range"])
        mine = [(F.col("_file") == file) & F.col("_range").isin(ranges) for file, ranges in sorted(ranges_of.items())]
        rows = self._rows().filter(reduce(or_, mine, F.lit(False))).drop("_range", "_file")
        first = min((r["before"] for r in held), default=0)
        ordered = rows.orderBy(*_order(self.by)).offset(offset - first) if offset > first else rows.orderBy(*_order(self.by))
        page = ordered.limit(limit)
        return page.withColumn("rank", F.row_number().over(Window.orderBy(*_order(self.by))) + F.lit(offset))
