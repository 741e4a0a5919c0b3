"""Session settings and shared folders.

Joins in this package never force a broadcast of data that can grow: the planner (and AQE, from
measured shuffle sizes) broadcasts a lookup side only when it is below
``spark.sql.autoBroadcastJoinThreshold``.  Beyond that size the same plan runs as a shuffled join and
AQE splits hot keys, also when that costs one more exchange (``forceOptimizeSkewedJoin``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # times with statistics, which the default type lacks: readers skip files and row groups by time
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows can be long texts: a Python task holds one batch at a time
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the package relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "telescry", memory: str = "16g") -> SparkSession:
    """A single-JVM session for tests and benchmarks; a cluster brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only where that setting is absent and all tasks run on this machine (tests, a laptop) a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="telescry-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later passes read to the shared folder, and read it from there: plans on top of it stay small."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write an intermediate result that several later passes read to the checkpoint folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()
