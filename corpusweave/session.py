"""Session helpers: defaults, reliable checkpoints and scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "corpusweave", cores: int | str | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster pass your own session."""
    cores = cores or os.environ.get("BENCH_CPUS") or "8"
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the cluster names; make one only for a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="corpusweave-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_partitions(spark: SparkSession) -> int:
    """Partitions for iterative work: enough for every core and for the configured shuffles."""
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, shuffles)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer tasks than cores.

    A table of a few files would otherwise run text work on one core; a large table already
    has more splits than cores and is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors can reach."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute a frame once, into a compressed scratch table that later plans read column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
