"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs here want from a session; a cluster sets the rest.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files are up to 512 KiB each: bound Arrow batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # Lets the tree source list only the repositories a query asks for.
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Tables in buckets of a slot are joined on (slot, id) where they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def builder(app_name: str = "codequarry") -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED.items():
        made = made.config(key, value)
    return made


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only where the session names none and all of it runs on this machine (a local
    test) is a local one made, and then the session is told about it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    made = tempfile.mkdtemp(prefix="codequarry-")
    spark.sparkContext.setCheckpointDir(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), "codequarry", f"{purpose}-{uuid.uuid4().hex}")


def materialise(df, purpose: str, file_rows: int | None = None):
    """Write ``df`` to the shared folder and read it back: computed once, no lineage.

    With ``file_rows`` no file has more rows. A task reads 128 MB, to which a file adds 4
    (Spark's defaults): no more than 32 files, however well their rows are packed, so
    what a task sorts does not grow with the table.
    """
    path = work_path(df.sparkSession, purpose)
    write = df.write if file_rows is None else df.write.option("maxRecordsPerFile", file_rows)
    write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a work file that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread_scan(df):
    """Use all cores for costly per-row work on a scan of fewer pieces than cores.

    A scan of many pieces, as any large table is, is left as it is. For plain
    scans only: a plan with shuffles would be run to count its pieces.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
