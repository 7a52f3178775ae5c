"""Tables bucketed and sorted by their join key (J01): written once, joined without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` files (default: the shuffle partitions), each with the keys
    of one hash bucket in order, in the shared folder.  Tables of the same key type and bucket
    number join on the key bucket by bucket, without an Exchange."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/buckets/{table}"
    # dealt by the same hash first: a bucket is written by one task as one file
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)
