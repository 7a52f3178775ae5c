"""Masked statistics, whitening, GAE, returns and group-relative advantages.

Token data comes in two physical forms:

* wide: one row per rollout with ``ARRAY<DOUBLE>`` columns holding positions
  ``0..seq_len+1`` (the score slot); positions beyond are padding whose
  values are known constants, so they are not stored;
* long: one row per ``(rollout_id, t)``.

Batch statistics are aggregates (partial + final, no group in one task), written
to the shared folder before they are joined back: the planner knows the size of
that table, broadcasts it under Spark's threshold, and the token arrays are not
shuffled by batch.  Per-rollout recursions run inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_
from ..session import stored

def empty_doubles():
    return F.array().cast("array<double>")


# ---------------------------------------------------------------- G01-G03
def masked_mean(value: Column | str, mask: Column | str) -> Column:
    """G01 aggregate: mean over rows where ``mask``; NULL when none (torch: NaN)."""
    return F.avg(F.when(col_(mask), col_(value)))


def masked_var(value: Column | str, mask: Column | str, unbiased: bool = True) -> Column:
    """G02 aggregate: Bessel-corrected by default; n = 1 -> NULL (torch divides by zero).
    n = 0 raises like the reference."""
    v = F.when(col_(mask), col_(value))
    var = F.var_samp(v) if unbiased else F.var_pop(v)
    n = F.count(v)
    return F.when(n == 0, F.raise_error(F.lit("masked_var: the sum of the mask is zero"))).otherwise(var)


def whiten_expr(v: Column, mean: Column, var: Column, shift_mean: bool = True) -> Column:
    """G03 element formula ``(v - mean) * rsqrt(var + 1e-8)`` (+ mean back)."""
    w = (v - mean) / F.sqrt(var + F.lit(1e-8))
    return w + mean if not shift_mean else w


def whiten_long(
    df: DataFrame, value: str, mask: Column, keys: list[str], out: str, shift_mean: bool = True, fill: float | None = None
) -> DataFrame:
    """G03/G04/G07 on long form: statistics per ``keys`` (batch) over masked
    rows, joined back.  Masked-out rows are whitened too unless ``fill`` is
    given (A07 zero fill)."""
    stats = (
        df.where(mask)
        .groupBy(*keys)
        .agg(F.avg(value).alias("_mu"), F.var_samp(value).alias("_var"))
    )
    joined = df.join(stored(stats, "batch-stats"), keys, "left")
    w = whiten_expr(F.col(value), F.col("_mu"), F.col("_var"), shift_mean)
    if fill is not None:
        w = F.when(mask, w).otherwise(F.lit(float(fill)))
    return joined.withColumn(out, w).drop("_mu", "_var")


def array_stats(df: DataFrame, arr: str, n_valid: Column, keys: list[str]) -> DataFrame:
    """Mean and sample variance per ``keys`` of the first ``n_valid`` elements of
    ``arr`` (explode + partial aggregate)."""
    return (
        df.select(*keys, F.posexplode_outer(arr).alias("_pos", "_v"), n_valid.alias("_nv"))
        .where(F.col("_pos") < F.col("_nv"))
        .groupBy(*keys)
        .agg(F.avg("_v").alias("_mu"), F.var_samp("_v").alias("_var"), F.count("_v").alias("_n"))
    )


def whiten_array(
    df: DataFrame, arr: str, n_valid: Column, keys: list[str], out: str, shift_mean: bool = True, fill: float | None = 0.0
) -> DataFrame:
    """G03/G04/G07 on wide form: whiten the first ``n_valid`` elements with batch
    statistics; the rest become ``fill`` (None keeps the whitened value)."""
    stats = stored(array_stats(df, arr, n_valid, keys), "batch-stats")
    joined = df.join(stats, keys, "left").withColumn("_nv", n_valid)
    body = lambda v, i: (
        F.when(i < F.col("_nv"), whiten_expr(v, F.col("_mu"), F.col("_var"), shift_mean)).otherwise(
            F.lit(float(fill)) if fill is not None else whiten_expr(v, F.col("_mu"), F.col("_var"), shift_mean)
        )
    )
    return joined.withColumn(out, F.transform(F.col(arr), body)).drop("_mu", "_var", "_n", "_nv")


# ---------------------------------------------------------------- G05/G06
def deltas(rewards: Column, values: Column, gamma: float) -> Column:
    """``δ_t = r_t + γ v_{t+1} - v_t``, value past the end 0."""
    g = F.lit(float(gamma))
    return F.transform(rewards, lambda r, i: r + g * F.coalesce(F.get(values, i + 1), F.lit(0.0)) - F.get(values, i))


def gae(rewards: Column, values: Column, gamma: float = 1.0, lam: float = 0.95) -> Column:
    """G05 in-row backward recursion ``A_t = δ_t + γλ A_{t+1}``.  Each step
    prepends to the accumulator, so cost is O(L^2) in the stored width
    (generation length, 33 here); use :func:`gae_grouped` for long rollouts."""
    gl = F.lit(float(gamma) * float(lam))
    start = F.struct(F.lit(0.0).alias("last"), empty_doubles().alias("out"))

    def step(acc, d):
        a = d + gl * acc["last"]
        return F.struct(a.alias("last"), F.concat(F.array(a), acc["out"]).alias("out"))

    return F.aggregate(F.reverse(deltas(rewards, values, gamma)), start, step, lambda acc: acc["out"])


def returns(advantages: Column, values: Column) -> Column:
    """``returns = advantages + values`` (before whitening)."""
    return F.zip_with(advantages, values, lambda a, v: a + v)


def gae_grouped(
    long_df: DataFrame, key: str, t: str, reward: str, value: str, gamma: float = 1.0, lam: float = 0.95
) -> DataFrame:
    """G05 for long rollouts: one Arrow batch per rollout, linear backward scan
    in numpy.  Output: ``key, t, advantage``."""
    import numpy as np
    import pandas as pd

    g, gl = float(gamma), float(gamma) * float(lam)

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(t)
        r = pdf[reward].to_numpy(dtype="float64")
        v = pdf[value].to_numpy(dtype="float64")
        nxt = np.append(v[1:], 0.0)
        d = r + g * nxt - v
        a = np.empty_like(d)
        last = 0.0
        for i in range(len(d) - 1, -1, -1):
            last = d[i] + gl * last
            a[i] = last
        return pd.DataFrame({key: pdf[key].to_numpy(), t: pdf[t].to_numpy(), "advantage": a})

    schema = f"{key} long, {t} int, advantage double"
    return long_df.select(key, t, reward, value).groupBy(key).applyInPandas(scan, schema)


# ---------------------------------------------------------------- G08/G09
def group_advantage(df: DataFrame, reward: str, group: str, out: str = "advantage", eps: float = 0.0) -> DataFrame:
    """``(r - mean_g) / (std_g + eps)`` inside each generation group
    (bounded: k rows).  Zero or NULL std gives 0."""
    w = Window.partitionBy(group)
    mu, sd = F.avg(reward).over(w), F.stddev_samp(reward).over(w)
    denom = sd + F.lit(float(eps))
    adv = F.when(sd.isNull() | (denom == 0), F.lit(0.0)).otherwise((F.col(reward) - mu) / denom)
    return df.withColumn(out, adv)


def batch_scaled_advantage(
    df: DataFrame, reward: str, group: str, batch: str, out: str = "advantage", eps: float = 0.0
) -> DataFrame:
    """G09 (interpretation): centre by the group mean, scale by the sample std
    of the whole batch.  Batch std is an aggregate joined back, not a window,
    because a batch is not bounded."""
    w = Window.partitionBy(group)
    centred = df.withColumn("_c", F.col(reward) - F.avg(reward).over(w))
    bstd = stored(df.groupBy(batch).agg(F.stddev_samp(reward).alias("_bsd")), "batch-stats")
    denom = F.col("_bsd") + F.lit(float(eps))
    adv = F.when(F.col("_bsd").isNull() | (denom == 0), F.lit(0.0)).otherwise(F.col("_c") / denom)
    return centred.join(bstd, batch, "left").withColumn(out, adv).drop("_c", "_bsd")
