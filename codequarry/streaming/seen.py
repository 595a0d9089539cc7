"""First arrivals of keys in a stream, with the keys in a table and not in the stream's state.

A trigger's distinct keys are joined against those that earlier triggers wrote, only in
the buckets that they fall in, and what is new is written under the trigger's number. The
stream itself keeps nothing, so its memory and checkpoints stay as they are however many
keys there have been; a repeated trigger looks at earlier ones only and writes the same again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BUCKETS = 64


class SeenKeys:
    """Keys of one stream, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), list(keys), buckets
        self._schema = T.StructType(
            [schema[k] for k in keys] + [T.StructField("trigger", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(self._schema).option("basePath", f"{self.root}/seen").parquet(f"{self.root}/seen")

    def read(self) -> DataFrame:
        """The keys seen, each with the trigger that brought it first."""
        return self._stored().select(*self.keys, "trigger")

    def start(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        flow = rows.select(*self.keys).writeStream.foreachBatch(self.trigger)
        return flow.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def trigger(self, batch: DataFrame, number: int) -> None:
        arrived = batch.select(*self.keys, self._bucket()).distinct().persist()
        fresh = arrived
        if number > 0:
            here = [r["bucket"] for r in arrived.select("bucket").distinct().collect()]  # at most ``buckets``
            before = self._stored().filter((F.col("trigger") < number) & F.col("bucket").isin(here)).alias("b")
            same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in self.keys])
            fresh = arrived.alias("a").join(before, (F.col("a.bucket") == F.col("b.bucket")) & same, "left_anti")
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/seen/trigger={number}")
        arrived.unpersist()
