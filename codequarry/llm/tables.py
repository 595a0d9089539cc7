"""Work tables in the shared folder and checks of size before a broadcast."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codequarry.session import work_path

BROADCAST_BYTES = 32 << 20


class WorkTables:
    """Tables written for one run; ``drop`` removes those whose readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, df: DataFrame, name: str) -> DataFrame:
        """The table of all that was appended to it under this name."""
        path = self.paths.setdefault(name, work_path(self.spark, name))
        df.write.mode("append").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def partitioned(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """A table with one folder for each value of ``column``; packed well, as much of the work lies here at once."""
        path = work_path(self.spark, name)
        df.write.mode("overwrite").partitionBy(column).option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more.

    It does so when the driver collects its garbage, which small drivers of long
    runs may do too late for the disks of the executors. What the first collection
    sets free may hold more, so there is a second one.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def others(docs: DataFrame, text: str, *replaced: str) -> Column:
    """All columns but the text, and but those that results replace, as one struct.

    The text travels by itself, so Python tasks get it once. The first field keeps
    the struct from being empty.
    """
    return F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text and c not in replaced])


def restored(docs: DataFrame, text: str, value: Column, struct: str, *replaced: str) -> list[Column]:
    """The columns of ``docs`` in their order, out of ``others`` and the text's new value."""
    return [value.alias(c) if c == text else F.col(f"`{struct}`.`{c}`") for c in docs.columns if c not in replaced]
