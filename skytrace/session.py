"""Session helpers: a configured local session for tests/bench, checkpoint dir."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, tz: str | None = None,
                  app: str = "skytrace") -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small local inputs: keep at least ~one partition per core after a
        # shuffle (JSON parsing is CPU-bound per byte).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("SKYTRACE_MIN_PARTITION", "64k"))
        .config("spark.driver.memory", os.environ.get("SKYTRACE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if tz:
        b = b.config("spark.sql.session.timeZone", tz)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's checkpoint folder (``spark.checkpoint.dir``).

    On a cluster that setting names a shared folder and is used as is. Where
    it is unset, a local master gets a fresh scratch folder; any other master
    is refused, as its executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not fallback and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = fallback or tempfile.mkdtemp(prefix="skytrace-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
