"""Admission of requests that arrive out of order, with nothing lost on the way.

Requests wait in a table until the watermark (the latest time seen, less the allowed
delay) has passed them, and are then admitted in order of time by the batch form, which
spreads a busy client over its chains. What a client's admitted requests of the last
window leave for the future is the only other state: at most ``limit`` times a client,
and none for clients that were silent for a window. A request that comes behind the
watermark is written to a table of its own, whatever the reason.

Every trigger reads the state that the one before it wrote, and writes its own under its
number: a repeated trigger writes the same again, and results appear once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from codequarry.limits import DEFAULT_LIMITS
from codequarry.operators.metrics import admitted_requests
from codequarry.session import delete

_FINAL = 1 << 62


class Admissions:
    """The tables of one stream of requests, below ``root``."""

    def __init__(
        self, spark: SparkSession, root: str, client: T.DataType, delay_seconds: int = 600,
        limit: int = DEFAULT_LIMITS.requests_per_window, seconds: int = DEFAULT_LIMITS.window_seconds,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.limit, self.seconds = limit, seconds
        self.span, self.delay = seconds * 1_000_000, delay_seconds * 1_000_000
        moment = T.StructType([T.StructField("client", client), T.StructField("t", T.LongType()), T.StructField("n", T.LongType())])
        self._schemas = {
            "waiting": moment, "kept": moment, "late": moment,
            "admitted": T.StructType([*moment.fields[:2], T.StructField("requests", T.LongType()), T.StructField("admitted", T.LongType())]),
            "watermark": T.StructType([T.StructField("at", T.LongType())]),
        }

    def _path(self, table: str, number: int) -> str:
        return f"{self.root}/{table}/trigger={number}"

    def _write(self, rows: DataFrame, table: str, number: int) -> DataFrame:
        names = self._schemas[table].fieldNames()
        rows.select(*[F.col(n) for n in names]).write.mode("overwrite").parquet(self._path(table, number))
        return self._state(table, number)

    def _state(self, table: str, number: int) -> DataFrame:
        """What a trigger left; nothing before the first."""
        if number < 0:
            return self.spark.createDataFrame([], self._schemas[table])
        return self.spark.read.schema(self._schemas[table]).parquet(self._path(table, number))

    def _all(self, table: str) -> DataFrame:
        return self.spark.read.schema(self._schemas[table]).parquet(f"{self.root}/{table}/trigger=*")

    def admitted(self) -> DataFrame:
        """``client, t, requests, admitted`` of all that the watermark has passed."""
        return self._all("admitted")

    def late(self) -> DataFrame:
        """``client, t, n``: requests that came too late to be judged."""
        return self._all("late").groupBy("client", "t").agg(F.sum("n").alias("n"))

    def start(self, requests: DataFrame, checkpoint: str, client: str = "client", ts: str = "ts") -> StreamingQuery:
        """Take all that is available; ``finish`` judges what still waits then."""
        moments = requests.select(F.col(client).alias("client"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"))
        writer = moments.writeStream.foreachBatch(self.trigger).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()

    def trigger(self, batch: DataFrame, number: int) -> None:
        """One trigger's requests (``client, t``)."""
        arrived = batch.groupBy("client", "t").agg(F.count(F.lit(1)).alias("n")).persist()
        before = self._state("watermark", number - 1).agg(F.max("at")).first()[0]
        before = -_FINAL if before is None else before
        latest = arrived.agg(F.max("t")).first()[0]
        now = before if latest is None else max(before, latest - self.delay)
        self._write(self.spark.createDataFrame([(now,)], self._schemas["watermark"]), "watermark", number)
        self._write(arrived.filter(F.col("t") <= before), "late", number)
        waiting = self._state("waiting", number - 1).unionByName(arrived.filter(F.col("t") > before))
        self._judge(waiting.groupBy("client", "t").agg(F.sum("n").alias("n")), now, number)
        arrived.unpersist()

    def finish(self, number: int) -> None:
        """Judge all that waits after trigger ``number`` - 1; nothing may come after."""
        self._write(self.spark.createDataFrame([(_FINAL,)], self._schemas["watermark"]), "watermark", number)
        self._write(self.spark.createDataFrame([], self._schemas["late"]), "late", number)
        self._judge(self._state("waiting", number - 1), _FINAL, number)

    def last(self) -> int:
        """The number of the last trigger; -1 before the first."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/admitted")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return -1
        return max((int(s.getPath().getName().split("=")[1]) for s in files.listStatus(folder)), default=-1)

    def _judge(self, waiting: DataFrame, now: int, number: int) -> None:
        """Admit what lies up to ``now``; the rest goes on waiting."""
        ready, kept = waiting.filter(F.col("t") <= now), self._state("kept", number - 1)
        # Kept requests were admitted, so as requests they are admitted again and fill the window as they did.
        both = ready.select("client", "t", "n", F.lit(True).alias("new")).unionByName(
            kept.select("client", "t", "n", F.lit(False).alias("new")))
        judged = self._write(self._judged(both), "admitted", number)
        inside = F.col("t") > now - self.span
        still = judged.filter(inside & (F.col("admitted") > 0)).select("client", "t", F.col("admitted").alias("n"))
        self._write(still.unionByName(kept.filter(inside)), "kept", number)
        self._write(waiting.filter(F.col("t") > now), "waiting", number)
        # Two triggers back nothing is read any more.
        for table in ("waiting", "kept"):
            if number >= 2:
                delete(self.spark, self._path(table, number - 2))

    def _judged(self, both: DataFrame) -> DataFrame:
        old = both.filter(~F.col("new")).select("client", "t").withColumn("_old", F.lit(True))
        times = both.withColumn("ts", F.timestamp_micros("t"))
        found = admitted_requests(times, limit=self.limit, seconds=self.seconds, count="n")
        # No instant is both: what is kept lies before the watermark, what is ready behind it.
        return found.join(old, ["client", "t"], "left_anti")
