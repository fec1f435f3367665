"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the operators are written for. A cluster sets its own memory and
# parallelism; AQE coalesces small shuffles and splits hot join partitions.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "32MB",
}


def local_session(app: str = "firstprint", cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SCAN_PIECES = "firstprint.scan.pieces"


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt into as many tasks as the session's `firstprint.scan.pieces` says; as they are if it is not set.

    For costly parsing of files that Spark cannot split, such as one row group. Nothing is measured: whoever knows their
    files sets it.
    """
    pieces = df.sparkSession.conf.get(SCAN_PIECES, None)
    return df.repartition(int(pieces)) if pieces else df


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Every executor must see it, so the root is what `spark.checkpoint.dir` (or an already set checkpoint folder) names.
    Where neither is set, a session in one process gets a folder of its own; any other is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="firstprint-")
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """Cut lineage by writing to the shared folder and reading back.

    Metrics are counted while the rows are written, so they cost no extra job.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    seen = Observation() if metrics else None
    (df.observe(seen, *metrics) if metrics else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), (seen.get if metrics else {})
