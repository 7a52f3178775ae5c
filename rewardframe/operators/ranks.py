"""Ranks (G12): rollouts dealt to the processes of a data-parallel run, statistics and
whitening inside a rank, and the gathered value of an update, the mean of its rank means.

Rank means weigh every rank alike, so with ranks of unequal size the gathered value is not
the mean over all rollouts; both are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .advantages import whiten_expr
from .ranking import bucketed_row_number, hex_bucket, md5_key

RANK_SEED_STEP = 100003  # fixed value: the prime between the seeds of neighbouring ranks


def rank_seed(seed: int, rank: Column) -> Column:
    """The seed of a rank's own permutations."""
    return F.lit(seed).cast("long") + rank * F.lit(RANK_SEED_STEP)


def deal_ranks(df: DataFrame, update: str, key: str, world_size: int, seed: int = 42) -> DataFrame:
    """``rank`` of each row: the rows of an update, in md5 order, are cut into ``world_size``
    runs of ``ceil(n / world_size)`` neighbouring positions, so the last rank gets what is
    left.  Positions are built in two levels; the sizes are a table of one row an update."""
    keyed = df.withColumn("_h", md5_key(F.lit(seed), F.col(update), F.col(key)))
    pos = bucketed_row_number(keyed, [update], ["_h", key], hex_bucket("_h"), "_pos").drop("_h")
    sizes = stored(df.groupBy(F.struct(update).alias("_u")).agg(F.ceil(F.count(F.lit(1)) / F.lit(world_size)).alias("_each")), "rank-sizes")
    out = pos.withColumn("_u", F.struct(update)).join(sizes, "_u")
    return out.withColumn("rank", F.floor(F.col("_pos") / F.col("_each")).cast("long")).drop("_u", "_pos", "_each")


def gathered(df: DataFrame, update: str, values: list[str], rank: str = "rank") -> DataFrame:
    """Per update: ranks, the smallest and largest rank, and of each value the mean of the rank
    means (``<v>_gathered``) next to the mean of all rows (``<v>_mean``).  Rank statistics are
    one partial aggregate; the second one is over ranks."""
    per = df.groupBy(update, rank).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(v).alias(f"_m_{v}") for v in values],
        *[F.sum(v).alias(f"_s_{v}") for v in values], *[F.count(v).alias(f"_c_{v}") for v in values])
    return per.groupBy(update).agg(
        F.count(F.lit(1)).alias("n_ranks"), F.min("_n").alias("min_rank_rows"), F.max("_n").alias("max_rank_rows"),
        *[F.avg(f"_m_{v}").alias(f"{v}_gathered") for v in values],
        *[F.try_divide(F.sum(f"_s_{v}"), F.sum(f"_c_{v}")).alias(f"{v}_mean") for v in values])


def whiten_in_ranks(df: DataFrame, arr: str, n_valid: Column, keys: list[str], out: str, fill: float = 0.0) -> DataFrame:
    """Whiten the first ``n_valid`` elements of ``arr`` with the statistics of the row's rank
    (``keys``: update and rank); the rest become ``fill``.  ``df`` is read twice, once for the
    statistics: pass a stored table, so that what is above it runs once."""
    valid = df.select(*keys, F.posexplode_outer(arr).alias("_pos", "_v"), n_valid.alias("_nv")).where(F.col("_pos") < F.col("_nv"))
    stats = valid.groupBy(F.struct(*keys).alias("_k")).agg(F.avg("_v").alias("_mu"), F.var_samp("_v").alias("_var"))
    joined = df.withColumns({"_k": F.struct(*keys), "_nv": n_valid}).join(stored(stats, "rank-stats"), "_k", "left")
    body = lambda v, i: F.when(i < F.col("_nv"), whiten_expr(v, F.col("_mu"), F.col("_var"))).otherwise(F.lit(float(fill)))
    return joined.withColumn(out, F.transform(arr, body)).drop("_k", "_nv", "_mu", "_var")


# ---------------------------------------------------------------- B02: permutations without a sort
def feistel(index: Column, seed: Column, bits: int, rounds: int = 4) -> Column:
    """A keyed bijection of ``0 .. 2**(2 * bits) - 1``: Feistel rounds on two halves of ``bits``
    bits, the round function taken from md5(seed|round|half)."""
    low = F.lit((1 << bits) - 1).cast("long")
    state = F.struct(F.shiftright(index, bits).alias("l"), index.bitwiseAND(low).alias("r"))

    def step(s, i):
        word = F.md5(F.concat_ws("|", seed.cast("string"), i.cast("string"), s["r"].cast("string")))
        mixed = F.conv(F.substring(word, 1, 15), 16, 10).cast("long").bitwiseAND(low)
        return F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(mixed).alias("r"))

    turns = F.array(*[F.lit(i) for i in range(rounds)])
    return F.aggregate(turns, state, step, lambda s: F.shiftleft(s["l"], bits).bitwiseOR(s["r"]))


def permuted(index: Column, seed: Column, size: int, steps: int = 64) -> Column:
    """Position of ``index`` in the permutation of ``0 .. size - 1`` that ``seed`` names: the
    bijection on the next power of four is walked until it falls below ``size``.  Every index
    is mapped on its own: no sort, no shuffle.  At least a quarter of the bijection's range is
    valid, so ``steps`` further walks fail with a chance of 0.75**steps, which raises."""
    bits = max(1, -(-(max(size, 2) - 1).bit_length() // 2))
    n = F.lit(size).cast("long")
    first = feistel(index, seed, bits)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, lambda x, _: F.when(x < n, x).otherwise(feistel(x, seed, bits)))
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("permutation: the walk left its range")).cast("long"))
