"""Batching as a data job (B01-B07): plan, per-epoch shuffle, mini/micro
assignment, drop_last, epoch repetition, generation fan-out, cadence."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import hex_bucket, md5_key


WHITEN_ROWS = 8  # fixed value: least rows of a rank's mini-batch for whitening


@dataclass(frozen=True)
class BatchPlan:
    """B01 sizes: local = per_device * accumulation; batch = local * world;
    mini = batch / num_mini_batches (exact)."""

    per_device_train_batch_size: int = 4
    gradient_accumulation_steps: int = 4
    world_size: int = 1
    num_mini_batches: int = 2
    num_train_epochs: float = 1.0

    @property
    def local_batch_size(self) -> int:
        return self.per_device_train_batch_size * self.gradient_accumulation_steps

    @property
    def batch_size(self) -> int:
        return self.local_batch_size * self.world_size

    @property
    def mini_batch_size(self) -> int:
        if self.batch_size % self.num_mini_batches:
            raise ValueError(f"{self.batch_size} is not divisible by {self.num_mini_batches}")
        return self.batch_size // self.num_mini_batches

    @property
    def micro_batch_size(self) -> int:
        """Rows of one forward pass over all ranks."""
        return self.per_device_train_batch_size * self.world_size

    @property
    def local_mini_batch_size(self) -> int:
        if self.local_batch_size % self.num_mini_batches:
            raise ValueError(f"{self.local_batch_size} is not divisible by {self.num_mini_batches}")
        return self.local_batch_size // self.num_mini_batches

    @property
    def can_whiten(self) -> bool:
        """A rank's mini-batch is large enough for its own whitening statistics."""
        return self.local_mini_batch_size >= WHITEN_ROWS

    def check_whitening(self) -> None:
        if not self.can_whiten:
            raise ValueError(f"a mini-batch of {self.local_mini_batch_size} rows per rank is too small for whitening ({WHITEN_ROWS})")

    def total_batches(self, n_rows: int) -> int:
        return math.ceil(int(self.num_train_epochs * n_rows) / self.batch_size)


def batch_plan_columns(n_rows: Column, plan: BatchPlan) -> list[Column]:
    """B01 as columns over a row count (works inside one aggregate)."""
    episodes = F.floor(F.lit(float(plan.num_train_epochs)) * n_rows).cast("long")
    return [
        n_rows.cast("long").alias("n_rows"),
        F.lit(plan.local_batch_size).cast("long").alias("local_batch_size"),
        F.lit(plan.batch_size).cast("long").alias("batch_size"),
        F.lit(plan.mini_batch_size).cast("long").alias("mini_batch_size"),
        F.lit(plan.micro_batch_size).cast("long").alias("micro_batch_size"),
        F.lit(plan.local_mini_batch_size).cast("long").alias("local_mini_batch_size"),
        F.lit(plan.can_whiten).alias("can_whiten"),
        episodes.alias("total_episodes"),
        F.ceil(episodes / F.lit(plan.batch_size)).cast("long").alias("num_total_batches"),
        (n_rows % F.lit(plan.batch_size)).cast("long").alias("dropped_per_epoch"),
    ]


def repeat_epochs(df: DataFrame, epochs: int, col: str = "epoch") -> DataFrame:
    """The endless loader as ``epochs`` copies (explode, no join)."""
    return df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def generation_groups(df: DataFrame, k: int, col: str = "generation") -> DataFrame:
    """Fan-out to ``k`` generations per prompt."""
    return df.withColumn(col, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def epoch_shuffle(df: DataFrame, key: str, batch_size: int, seed: int = 42, epoch: str = "epoch") -> DataFrame:
    """Per-epoch permutation by ``md5(seed|epoch|key)`` cut into
    contiguous batches of ``batch_size``."""
    return epoch_rank(df, key, seed, epoch).withColumn(
        "batch_no", F.floor(F.col("rank") / F.lit(batch_size)).cast("long")
    )


def epoch_rank(df: DataFrame, key: str, seed: int = 42, epoch: str = "epoch") -> DataFrame:
    """0-based position of each row in its epoch's permutation; the rank is
    global per epoch, built in two levels over 4096 md5 buckets."""
    from .ranking import bucketed_row_number

    keyed = df.withColumn("_h", md5_key(F.lit(seed), F.col(epoch), F.col(key)))
    return bucketed_row_number(keyed, [epoch], ["_h"], hex_bucket("_h"), "rank").drop("_h")


def assign_batches(ranked: DataFrame, batch_size: int, mini_batch_size: int, micro_batch_size: int) -> DataFrame:
    """Batch, mini-batch and micro-batch index from the permutation rank."""
    pos = F.col("rank") % F.lit(batch_size)
    return (
        ranked.withColumn("batch_no", F.floor(F.col("rank") / F.lit(batch_size)).cast("long"))
        .withColumn("mini", F.floor(pos / F.lit(mini_batch_size)).cast("long"))
        .withColumn("micro", F.floor((pos % F.lit(mini_batch_size)) / F.lit(micro_batch_size)).cast("long"))
    )


def drop_last(batched: DataFrame, n_rows: Column, batch_size: int) -> DataFrame:
    """Discard the ragged last batch (``batch_no < floor(n / size)``)."""
    return batched.where(F.col("batch_no") < F.floor(n_rows / F.lit(batch_size)))


def sample_cadence(updates: DataFrame, update: str, total: Column, num_samples: int) -> DataFrame:
    """Keep updates where ``(update - 1) % max(1, total // n) == 0``."""
    freq = F.greatest(F.floor(total / F.lit(num_samples)), F.lit(1))
    return updates.where((F.col(update) - 1) % freq == 0)
