"""Discounted sums over sequences of any length (G05, W01): an associative scan by blocks.

``y_t = x_t + g * y_{t+1}`` composes as pairs (decay, value), so a sequence is cut into blocks
of ``block`` positions: each block's own sum is a partial aggregate, the blocks' sums are the
same problem with decay ``g**block`` (solved by the same function, block of blocks, until one
block is left), and what a block receives from its right neighbour is added to its positions
with the decay to the block's end.  A sequence of L positions costs O(L); its rows are
shuffled once, by (key, block), so one sequence spreads over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ranking import group_key

BLOCK = 256


def block_width(g: float, block: int = BLOCK) -> int:
    """Positions of a block: at most ``block``, and so few that ``g**width`` does not vanish."""
    if g == 1.0:
        return block
    return max(2, min(block, int(460 / -math.log(g)))) if 0 < g < 1 else block


def discounted_suffix_sums(df: DataFrame, keys: list[str], t: str, values: list[str], g: float, block: int = BLOCK, suffix: str = "_sum") -> DataFrame:
    """``df`` with ``<v>_sum`` for each value: ``sum(g**(k - t) * v_k)`` over the later positions
    ``k >= t`` of the same key, 0 <= g <= 1.  Positions are 0, 1, ... without gaps or repeats; a
    NULL value counts as 0.  ``df`` is read once for each level: pass a stored table."""
    if not 0 <= g <= 1:
        raise ValueError("the decay must lie between 0 and 1")
    if g == 0:
        return df.withColumns({v + suffix: F.coalesce(F.col(v), F.lit(0.0)) for v in values})
    key = F.struct(group_key(keys).alias("k"), F.floor(F.col(t) / F.lit(block_width(g, block))).alias("b"))
    width = block_width(g, block)
    place = (F.col(t) % F.lit(width)).cast("double")
    scaled = {f"_x_{v}": F.coalesce(F.col(v), F.lit(0.0)) * F.pow(F.lit(g), place) for v in values}
    rows = df.withColumns({"_blk": key, "_g": F.pow(F.lit(g), place), **scaled})
    own = Window.partitionBy("_blk").orderBy(F.desc(t)).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_l_{v}": F.sum(f"_x_{v}").over(own) / F.col("_g") for v in values})
    carry = _carries(rows, values, g**width, block, width)
    out = local.join(carry, "_blk", "left")
    to_end = F.pow(F.lit(g), F.lit(float(width)) - place)
    total = {v + suffix: F.col(f"_l_{v}") + to_end * F.coalesce(F.col(f"_c_{v}"), F.lit(0.0)) for v in values}
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in total.items()])


def _carries(rows: DataFrame, values: list[str], g: float, block: int, width: int) -> DataFrame:
    """(_blk, _c_<v>): what each block receives from the blocks to its right."""
    sums = rows.groupBy("_blk").agg(*[F.sum(f"_x_{v}").alias(v) for v in values])
    sums = stored(sums.select(F.col("_blk.k").alias("k"), F.col("_blk.b").alias("b"), *values), "scan-blocks")
    if (sums.agg(F.max("b")).first()[0] or 0) == 0:  # one number: every sequence fits one block
        full = sums.withColumns({f"{v}_sum": F.col(v) for v in values})
    elif g < 1e-300:  # what comes from two blocks away has vanished
        full = sums.withColumns({f"{v}_sum": F.col(v) for v in values})
    else:
        full = discounted_suffix_sums(sums, ["k"], "b", values, g, block)
    # the left neighbour receives a block's sum
    moved = full.select(F.struct(F.col("k"), (F.col("b") - 1).alias("b")).alias("_blk"), *[F.col(f"{v}_sum").alias(f"_c_{v}") for v in values])
    return stored(moved, "scan-carries")


def gae_scan(df: DataFrame, keys: list[str], t: str, reward: str, value: str, gamma: float = 1.0, lam: float = 0.95,
             block: int = BLOCK, out: str = "advantage") -> DataFrame:
    """G05 on rows (key, t, reward, value) of any length.  With ``g = gamma * lam`` the sum of
    the later deltas is R - V + (V - v) / lam, R and V being the discounted sums of rewards and
    values: the shifted values need no neighbour row.  ``df`` is read several times: pass a
    stored table."""
    g = gamma * lam
    if g == 0:
        shifted = df.select(*keys, (F.col(t) - 1).alias(t), F.col(value).alias("_next"))
        nxt = df.join(shifted, [*keys, t], "left") if gamma else df.withColumn("_next", F.lit(0.0))
        return nxt.withColumn(out, F.col(reward) + F.lit(gamma) * F.coalesce("_next", F.lit(0.0)) - F.col(value)).drop("_next")
    s = discounted_suffix_sums(df, keys, t, [reward, value], g, block)
    r, v = F.col(f"{reward}_sum"), F.col(f"{value}_sum")
    return s.withColumn(out, r - v + (v - F.col(value)) / F.lit(lam)).drop(f"{reward}_sum", f"{value}_sum")
