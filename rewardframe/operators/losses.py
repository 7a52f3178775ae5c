"""Policy/value diagnostics (O01-O08): values of the PPO losses, no gradients.

Per-token terms are summed per rollout in-row (``aggregate`` over zipped
arrays), then summed per micro-batch; means are ratios of sums so every
masked mean is exact however the rollouts are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import PPO, PPOConfig


def ratio(new_lp: Column, lp: Column) -> Column:
    """``exp(new_lp - lp)``; padded positions give 1."""
    return F.exp(new_lp - lp)


def pg_terms(adv: Column, r: Column, clip: float) -> tuple[Column, Column]:
    """``-A*ratio`` and ``-A*clamp(ratio, 1-c, 1+c)``."""
    l1 = -adv * r
    l2 = -adv * F.least(F.greatest(r, F.lit(1.0 - clip)), F.lit(1.0 + clip))
    return l1, l2


def vf_terms(vpred: Column, old: Column, ret: Column, clip: float) -> tuple[Column, Column]:
    """Squared errors of the raw and the clipped value prediction."""
    clipped = F.least(F.greatest(vpred, old - clip), old + clip)
    return (vpred - ret) * (vpred - ret), (clipped - ret) * (clipped - ret)


def _masked_sum(z: Column, limit: Column, term) -> Column:
    kept = F.filter(z, lambda s, i: i <= limit)
    return F.aggregate(kept, F.lit(0.0), lambda acc, s: acc + term(s))


def rollout_loss_sums(wide: DataFrame, cfg: PPOConfig = PPO, extra: list[Column] | None = None) -> DataFrame:
    """Per-rollout sums of every loss term over its mask (``t <= seq_len`` for
    the policy, ``t <= seq_len + 1`` for the value)."""
    # one zip per group of terms: a query that needs only some terms (e.g.
    # approxkl) lets Catalyst prune the other arrays and the GAE/whitening
    # work behind them
    zp = F.arrays_zip("logprob", "new_logprob", "advantages")
    zv = F.arrays_zip("value", "new_value", "returns")
    zl = F.arrays_zip("logprob", "new_logprob")
    sl = F.col("seq_len")

    def pg(s):
        l1, l2 = pg_terms(s["advantages"], ratio(s["new_logprob"], s["logprob"]), cfg.cliprange)
        return F.greatest(l1, l2)

    def pgc(s):
        l1, l2 = pg_terms(s["advantages"], ratio(s["new_logprob"], s["logprob"]), cfg.cliprange)
        return F.when(l2 > l1, F.lit(1.0)).otherwise(F.lit(0.0))

    def vf(s):
        a, b = vf_terms(s["new_value"], s["value"], s["returns"], cfg.cliprange_value)
        return F.greatest(a, b)

    def vfc(s):
        a, b = vf_terms(s["new_value"], s["value"], s["returns"], cfg.cliprange_value)
        return F.when(b > a, F.lit(1.0)).otherwise(F.lit(0.0))

    d = lambda s: s["new_logprob"] - s["logprob"]
    return wide.select(
        "rollout_id",
        "run_id",
        "batch_id",
        "seq_len",
        (sl + 1).alias("n_pg"),
        F.least(sl + 2, F.size("logprob")).alias("n_vf"),
        _masked_sum(zp, sl, pg).alias("pg_sum"),
        _masked_sum(zp, sl, pgc).alias("pgc_sum"),
        _masked_sum(zv, sl + 1, vf).alias("vf_sum"),
        _masked_sum(zv, sl + 1, vfc).alias("vfc_sum"),
        _masked_sum(zl, sl, lambda s: d(s) * d(s)).alias("dlp2_sum"),
        _masked_sum(zl, sl, lambda s: ratio(s["new_logprob"], s["logprob"])).alias("ratio_sum"),
        _masked_sum(zl, sl, lambda s: -s["new_logprob"]).alias("ent_sum"),
        *(extra or []),
    )


def stats_from_sums(
    sums: DataFrame, keys: list[str], cfg: PPOConfig = PPO, extra: dict[str, Column] | None = None
) -> DataFrame:
    """O02-O07 for any grouping of rollouts (a micro-batch, a batch):
    masked means, unmasked approxkl / ratio over ``n_rollouts * L``, and
    the total loss.  Entropy is the masked mean of ``-new_logprob`` (the
    padded positions need logits we do not have)."""
    L = float(cfg.gen_len)
    g = sums.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rollouts"),
        F.sum("n_pg").alias("_npg"),
        F.sum("n_vf").alias("_nvf"),
        F.sum("pg_sum").alias("_pg"),
        F.sum("pgc_sum").alias("_pgc"),
        F.sum("vf_sum").alias("_vf"),
        F.sum("vfc_sum").alias("_vfc"),
        F.sum("dlp2_sum").alias("_d2"),
        F.sum("ratio_sum").alias("_r"),
        F.sum("ent_sum").alias("_e"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )
    slots = F.col("n_rollouts") * F.lit(L)
    pg_loss = F.try_divide(F.col("_pg"), F.col("_npg"))
    vf_loss = 0.5 * F.try_divide(F.col("_vf"), F.col("_nvf"))
    return g.select(
        *keys,
        "n_rollouts",
        (0.5 * F.col("_d2") / slots).alias("approxkl"),
        F.try_divide(F.col("_pgc"), F.col("_npg")).alias("pg_clipfrac"),
        pg_loss.alias("pg_loss"),
        vf_loss.alias("vf_loss"),
        F.try_divide(F.col("_vfc"), F.col("_nvf")).alias("vf_clipfrac"),
        F.try_divide(F.col("_e"), F.col("_npg")).alias("entropy"),
        ((F.col("_r") + (slots - F.col("_npg"))) / slots).alias("ratio"),
        (pg_loss + F.lit(cfg.vf_coef) * vf_loss).alias("loss"),
        *list(extra or {}),
    )
