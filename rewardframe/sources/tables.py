"""Driver parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; column pruning and filters reach the scan, and the
    plan is the same at every size."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def head_n(df: DataFrame, key: str | list[str], n: int = 1000) -> DataFrame:
    """First ``n`` rows by an explicit key (``train[:n]``).  Spark has
    no storage order, so the key is required; plans as TakeOrderedAndProject."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def eval_head(filtered: DataFrame, key: str, k: int = 10) -> DataFrame:
    """First ``min(k, n)`` rows of the already filtered train set."""
    return filtered.orderBy(key).limit(k)


def assign_split(df: DataFrame, key: str, test_share_hex: str = "1", seed: str = "split") -> DataFrame:
    """Deterministic train/test label from ``md5(seed|key)``; rows whose
    hash starts with a char <= ``test_share_hex`` go to test (1/8 for '1')."""
    h = F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), 1, 1)
    return df.withColumn("split", F.when(h <= F.lit(test_share_hex), F.lit("test")).otherwise(F.lit("train")))


def load_splits(df: DataFrame, key: str, eval_on: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Train split always, test split only when evaluation is on."""
    labelled = assign_split(df, key)
    train = labelled.filter(F.col("split") == "train")
    test = labelled.filter(F.col("split") == "test") if eval_on else None
    return train, test


def union_chunks(chunks: list[DataFrame]) -> DataFrame:
    """Concatenate chunk outputs by column name."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """S05/S10 sink: append rollouts or metric records partitioned for pruning."""
    df.write.mode(mode).partitionBy(*by).parquet(path)
