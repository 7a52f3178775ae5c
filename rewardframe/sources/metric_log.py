"""Metric log (S10): one record per (run, update), written so that a repeat changes nothing.

The log is a Parquet table partitioned by its key.  A write replaces the partitions it has
rows for (dynamic partition overwrite) and leaves the others, so writing the same records
again, re-running a failed job or replaying a micro-batch gives the same log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..streaming.ops import path_exists

KEYS = ("run_id", "update")


def write_records(records: DataFrame, path: str, keys: tuple[str, ...] = KEYS) -> None:
    """Insert or replace the records of ``records`` by key.  One record per key is the
    contract of a metric log; rows of one key in one call stay together."""
    spread = records.repartition(*keys)  # one file for each record's partition, whatever the plan above
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The log, columns and types as in ``schema`` (partition values are text in the paths);
    a log nobody has written to is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def log_sink(path: str, keys: tuple[str, ...] = KEYS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: a micro-batch's records replace those of the same keys, so an
    update-mode stream keeps one row per key, and a replayed micro-batch changes nothing."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        write_records(batch, path, keys)

    return handle
