"""Session helpers: a local session for tests and bench, checkpoint dir lookup."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rewardframe") -> SparkSession:
    """Session for tests and local benchmarks (the cluster brings its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; where it is unset a local session gets a
    scratch folder, and a cluster's raises."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not current:
        if not re.match(r"local(\[[^,\]]*(,\s*\d+)?\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
        current = tempfile.mkdtemp(prefix="rf-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: the planner
    then knows its true size, and the table survives a lost executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")
        spark.sparkContext.setCheckpointDir(current)
    return df.checkpoint(eager=True)
