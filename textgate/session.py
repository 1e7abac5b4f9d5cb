"""Session and scratch-space helpers.

Scratch tables (round trips, saved models, stream sinks) live under the shared folder named
by ``spark.checkpoint.dir``. A cluster must set it. Only a ``local[...]`` master, where the
driver is the only executor, falls back to a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "textgate", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Partition sizing: ~128 MB input splits (about 50k documents of 2.5 kB); AQE coalesces
        # small shuffle outputs toward its advisory size and splits skewed ones.
        "spark.sql.files.maxPartitionBytes": "128m",
    }
    defaults.update(conf)
    for k, v in defaults.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Unset on a cluster is an error: executors that each wrote to a disk of their own would read
    back incomplete tables. A ``local[...]`` session gets a temporary folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master is {sc.master})")
        root = tempfile.mkdtemp(prefix="textgate-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder (never reused between runs)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/textgate/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back: cuts the lineage,
    and a lost executor costs a re-read, not a re-run."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
