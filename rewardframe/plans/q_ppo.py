"""Numeric token rollouts (binding 4, lineitem JOIN orders): KL, reward
placement, whitening, GAE, returns, PPO diagnostics, the stats table and
per-update metrics (R09-R12, R15, R18, G01-G07, G10-G12, O01-O08,
M01-M04, J01, J07, W01, A09, B07, L06, S10)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import PPO
from ..functions import rewards as R
from ..operators import advantages as G
from ..operators import losses as O
from ..operators.ranking import bucketed_row_number, global_row_number, hex_bucket, md5_key, span_bucket
from ..session import stored
from ..sources import tables as TB
from ..sources.bucketed import write_bucketed
from .bindings import LINE_ORDER, ppo_advantages, ppo_raw_advantages, ppo_rewards, token_long, token_rollouts
from .registry import query

L = PPO.gen_len
SEED = PPO.seed
TOK_CTE = f"""li AS (
  SELECT l_orderkey AS rollout_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS BIGINT) AS t,
         -(l_discount * 10 + 0.01) AS logprob, -(l_tax * 10 + 0.01) AS ref_logprob, l_quantity / 50 AS value,
         -(l_discount * 10 + 0.01) + (l_tax - l_discount) AS new_logprob, l_quantity / 50 + (l_discount * 10 - 0.5) AS new_value
  FROM lineitem),
ro AS (
  SELECT o.o_orderkey AS rollout_id, CASE WHEN o.o_orderkey % 2 = 0 THEN 'baseline' ELSE 'shaped' END AS run_id,
         o.o_orderkey % 8 AS batch_id, CAST(coalesce(c.n, 0) - 1 AS BIGINT) AS seq_len, o.o_totalprice / 1e5 AS score_raw
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey),
ros AS (SELECT *, CASE WHEN run_id = 'shaped' THEN score_raw - 0.01 * seq_len ELSE score_raw END AS score FROM ro),
tk AS (SELECT li.* FROM li JOIN ro ON li.rollout_id = ro.rollout_id
       UNION ALL SELECT rollout_id, seq_len + 1, 1.0, 1.0, 0.25, 1.0, 0.25 FROM ro WHERE seq_len + 1 < {L}),
tok AS (SELECT tk.*, ros.run_id, ros.batch_id, ros.seq_len, ros.score, ros.score_raw
        FROM tk JOIN ros ON tk.rollout_id = ros.rollout_id)"""


def _kl_sql(est: str) -> str:
    if est == "k1":
        return "-(ref_logprob - logprob)"
    return "exp(ref_logprob - logprob) - 1 - (ref_logprob - logprob)"


def rewards_cte(est: str = "k1", coef: float = 0.1, placement: str = "slot") -> str:
    place = f"CASE WHEN seq_len + 1 < {L} THEN seq_len + 1 ELSE seq_len END" if placement == "slot" else "seq_len"
    return f"""{TOK_CTE},
kl AS (SELECT *, {_kl_sql(est)} AS kl FROM tok),
rw AS (SELECT *, -{coef} * kl AS nsr, -{coef} * kl + CASE WHEN t = {place} THEN score ELSE 0.0 END AS reward FROM kl)"""


GAE_CTE = f"""RECURSIVE {rewards_cte()},
dl AS (SELECT *, reward + {PPO.gamma} * coalesce(lead(value) OVER (PARTITION BY rollout_id ORDER BY t), 0.0) - value AS delta FROM rw),
mx AS (SELECT rollout_id, max(t) AS tmax FROM dl GROUP BY rollout_id),
ga(rollout_id, t, adv) AS (
  SELECT dl.rollout_id, dl.t, dl.delta FROM dl JOIN mx ON dl.rollout_id = mx.rollout_id AND dl.t = mx.tmax
  UNION ALL
  SELECT dl.rollout_id, dl.t, dl.delta + {PPO.gamma * PPO.lam} * ga.adv FROM dl JOIN ga ON dl.rollout_id = ga.rollout_id AND dl.t = ga.t - 1),
av AS (SELECT dl.*, ga.adv, ga.adv + dl.value AS ret FROM dl JOIN ga ON dl.rollout_id = ga.rollout_id AND dl.t = ga.t),
st AS (SELECT batch_id, avg(adv) AS mu, var_samp(adv) AS var FROM av WHERE t <= seq_len GROUP BY batch_id),
aw AS (SELECT av.*, CASE WHEN t <= seq_len THEN (adv - mu) / sqrt(var + 1e-8) ELSE 0.0 END AS adv_w
       FROM av LEFT JOIN st ON av.batch_id = st.batch_id)"""

C, CV = PPO.cliprange, PPO.cliprange_value
LOSS_CTE = f"""{GAE_CTE},
lt AS (SELECT *, exp(new_logprob - logprob) AS ratio,
              least(greatest(new_value, value - {CV}), value + {CV}) AS vclip FROM aw),
terms AS (SELECT *, -adv_w * ratio AS l1, -adv_w * least(greatest(ratio, {1.0 - C}), {1.0 + C}) AS l2,
                 (new_value - ret) * (new_value - ret) AS v1, (vclip - ret) * (vclip - ret) AS v2 FROM lt),
rs AS (SELECT rollout_id, any_value(run_id) AS run_id, any_value(batch_id) AS batch_id, any_value(seq_len) AS seq_len,
              sum(CASE WHEN t <= seq_len THEN 1 ELSE 0 END) AS n_pg, count(*) AS n_vf,
              sum(CASE WHEN t <= seq_len THEN greatest(l1, l2) ELSE 0.0 END) AS pg_sum,
              sum(CASE WHEN t <= seq_len AND l2 > l1 THEN 1.0 ELSE 0.0 END) AS pgc_sum,
              sum(greatest(v1, v2)) AS vf_sum, sum(CASE WHEN v2 > v1 THEN 1.0 ELSE 0.0 END) AS vfc_sum,
              sum(CASE WHEN t <= seq_len THEN (new_logprob - logprob) * (new_logprob - logprob) ELSE 0.0 END) AS dlp2_sum,
              sum(CASE WHEN t <= seq_len THEN ratio ELSE 0.0 END) AS ratio_sum,
              sum(CASE WHEN t <= seq_len THEN -new_logprob ELSE 0.0 END) AS ent_sum
       FROM terms GROUP BY rollout_id
       UNION ALL SELECT rollout_id, run_id, batch_id, seq_len, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0 FROM ros
       WHERE seq_len + 1 >= {L} AND seq_len < 0)"""


def stats_select(keys: str, src: str = "rs") -> str:
    return f"""SELECT {keys}, count(*) AS n_rollouts,
       0.5 * sum(dlp2_sum) / (count(*) * {float(L)}) AS approxkl,
       sum(pgc_sum) / nullif(sum(n_pg), 0) AS pg_clipfrac,
       sum(pg_sum) / nullif(sum(n_pg), 0) AS pg_loss,
       0.5 * (sum(vf_sum) / nullif(sum(n_vf), 0)) AS vf_loss,
       sum(vfc_sum) / nullif(sum(n_vf), 0) AS vf_clipfrac,
       sum(ent_sum) / nullif(sum(n_pg), 0) AS entropy,
       (sum(ratio_sum) + (count(*) * {float(L)} - sum(n_pg))) / (count(*) * {float(L)}) AS ratio,
       sum(pg_sum) / nullif(sum(n_pg), 0) + {PPO.vf_coef} * (0.5 * (sum(vf_sum) / nullif(sum(n_vf), 0))) AS loss
FROM {src} GROUP BY {keys}"""


STATS_COLS = ["approxkl", "pg_clipfrac", "pg_loss", "vf_loss", "vf_clipfrac", "entropy", "ratio", "loss"]
ASSIGN_CTE = f"""{LOSS_CTE},
ep AS (SELECT rollout_id, batch_id, e.epoch AS ppo_epoch FROM ros CROSS JOIN range({PPO.num_ppo_epochs}) AS e(epoch)),
rk AS (SELECT rollout_id, ppo_epoch, row_number() OVER (PARTITION BY batch_id, ppo_epoch
            ORDER BY md5('{SEED}|' || CAST(ppo_epoch AS VARCHAR) || '|' || CAST(rollout_id AS VARCHAR))) - 1 AS rank FROM ep),
mb AS (SELECT rs.*, rk.ppo_epoch, rk.rank // {PPO.mini_batch_size} AS mini,
              (rk.rank % {PPO.mini_batch_size}) // {PPO.micro_batch_size} AS micro
       FROM rs JOIN rk ON rs.rollout_id = rk.rollout_id),
ps AS ({stats_select('run_id, batch_id, ppo_epoch, mini, micro', 'mb')})"""


LOSS_COLS = ["run_id", "logprob", "new_logprob", "value", "new_value", "returns"]


def wide(spark, sf, cfg=PPO, keep=None):
    return ppo_advantages(token_rollouts(spark, sf, cfg), cfg, keep)


def raw(spark, sf, cfg=PPO):
    """Rollouts with GAE and returns, for queries that need no whitening."""
    return ppo_raw_advantages(token_rollouts(spark, sf, cfg), cfg)


def long_of(spark, sf, cols, cfg=PPO):
    return token_long(ppo_rewards(token_rollouts(spark, sf, cfg), cfg), cols)


@query("kl_k1", f"WITH {rewards_cte('k1')} SELECT rollout_id, t, kl FROM rw", ["kl"], "R09 L06")
def kl_k1(spark, sf):
    """Per-token k1 KL ``ref - lp`` negated; padded slot gives 0."""
    return long_of(spark, sf, ["kl"]).select("rollout_id", "t", "kl")


@query("kl_k3", f"WITH {rewards_cte('k3')} SELECT rollout_id, t, kl FROM rw", ["kl"], "R09")
def kl_k3(spark, sf):
    """Per-token k3 KL ``expm1(logr) - logr`` (non-negative)."""
    return long_of(spark, sf, ["kl"], replace(PPO, kl_estimator="k3")).select("rollout_id", "t", "kl")


@query("non_score_reward", f"WITH {rewards_cte()} SELECT rollout_id, t, nsr AS non_score_reward FROM rw", ["non_score_reward"], "R10")
def non_score_reward(spark, sf):
    """``-kl_coef * kl`` per token."""
    return long_of(spark, sf, ["non_score_reward"]).select("rollout_id", "t", "non_score_reward")


@query("token_rewards", f"WITH {rewards_cte()} SELECT rollout_id, t, reward FROM rw", ["reward"], "R11 A06 A07")
def token_rewards(spark, sf):
    """KL reward plus the score at ``seq_len + 1`` (or ``seq_len`` when the
    response fills the width)."""
    return long_of(spark, sf, ["rewards"]).select("rollout_id", "t", F.col("rewards").alias("reward"))


@query(
    "token_rewards_last",
    f"WITH {rewards_cte('k1', 0.2, 'last')} SELECT rollout_id, t, reward FROM rw",
    ["reward"],
    "R12",
)
def token_rewards_last(spark, sf):
    """Older placement from the notes: score on the last token, KL coef 0.2."""
    ro = token_rollouts(spark, sf)
    kl = F.zip_with("logprob", "ref_logprob", lambda lp, ref: R.kl_per_token(lp, ref, "k1"))
    out = ro.withColumn(
        "reward",
        F.transform(kl, lambda k, i: -0.2 * k + F.when(i == F.col("seq_len"), F.col("score")).otherwise(F.lit(0.0))),
    )
    return token_long(out, ["reward"]).select("rollout_id", "t", "reward")


@query(
    "dense_reward",
    f"""WITH {rewards_cte()}, n AS (SELECT *, CAST(ceil((seq_len + 1) / 4.0) AS BIGINT) AS n_chunks FROM rw)
        SELECT rollout_id, t, nsr + CASE WHEN t <= seq_len AND (t + 1) % 4 = 0 OR (t = seq_len AND (t + 1) % 4 <> 0)
                                   THEN score / n_chunks ELSE 0.0 END AS reward FROM n""",
    ["reward"],
    "R15",
)
def dense_reward(spark, sf):
    """Dense variant: the score is spread over every 4th generated token (and
    the last one), so the sequence total still equals the score."""
    ro = ppo_rewards(token_rollouts(spark, sf))
    n_chunks = F.ceil((F.col("seq_len") + 1) / 4.0)
    at = lambda i: ((i <= F.col("seq_len")) & ((i + 1) % 4 == 0)) | ((i == F.col("seq_len")) & ((i + 1) % 4 != 0))
    out = ro.withColumn(
        "reward",
        F.transform("non_score_reward", lambda x, i: x + F.when(at(i), F.col("score") / n_chunks).otherwise(F.lit(0.0))),
    )
    return token_long(out, ["reward"]).select("rollout_id", "t", "reward")


@query(
    "join_ref",
    f"WITH {rewards_cte()} SELECT rollout_id, t, logprob, ref_logprob, value, kl FROM rw",
    ["logprob", "ref_logprob", "value", "kl"],
    "J01 L06",
)
def join_ref(spark, sf):
    """Policy logprobs JOIN reference logprobs JOIN values on (rollout_id, t).  The three
    tables are bucketed and sorted by rollout_id, so they join bucket by bucket without an
    Exchange; their arrays are zipped and exploded once."""
    ro = stored(token_rollouts(spark, sf).select("rollout_id", "logprob", "ref_logprob", "value"), "model-outputs")
    policy, ref, critic = (write_bucketed(ro.select("rollout_id", c), c, "rollout_id") for c in ("logprob", "ref_logprob", "value"))
    # already in order and in place: a merge join, whatever the sizes
    j = policy.hint("merge").join(ref.hint("merge"), "rollout_id").join(critic.hint("merge"), "rollout_id")
    j = token_long(j, ["logprob", "ref_logprob", "value"], ["rollout_id"])
    return j.withColumn("kl", R.kl_per_token("logprob", "ref_logprob", "k1"))


@query(
    "masked_mean",
    f"""WITH {rewards_cte()} SELECT batch_id, avg(CASE WHEN t <= seq_len THEN kl END) AS mean_kl,
               avg(value) AS mean_value_p1, avg(CASE WHEN t <= seq_len THEN value END) AS mean_value FROM rw GROUP BY batch_id""",
    ["mean_kl", "mean_value_p1", "mean_value"],
    "G01",
)
def masked_mean(spark, sf):
    """Masked means per batch (``~padding_mask`` and ``~padding_mask_p1``)."""
    lt = long_of(spark, sf, ["kl", "value"])
    m = F.col("t") <= F.col("seq_len")
    return lt.groupBy("batch_id").agg(
        G.masked_mean("kl", m).alias("mean_kl"),
        G.masked_mean("value", F.lit(True)).alias("mean_value_p1"),
        G.masked_mean("value", m).alias("mean_value"),
    )


@query(
    "masked_var",
    f"""WITH {rewards_cte()} SELECT batch_id, var_samp(CASE WHEN t <= seq_len THEN value END) AS var_value,
               var_pop(CASE WHEN t <= seq_len THEN value END) AS var_value_pop FROM rw GROUP BY batch_id""",
    ["var_value", "var_value_pop"],
    "G02",
)
def masked_var(spark, sf):
    """Masked variance per batch, unbiased and biased."""
    lt = long_of(spark, sf, ["value"])
    m = F.col("t") <= F.col("seq_len")
    return lt.groupBy("batch_id").agg(
        G.masked_var("value", m).alias("var_value"), G.masked_var("value", m, unbiased=False).alias("var_value_pop")
    )


@query(
    "whiten",
    f"""WITH {rewards_cte()}, s AS (SELECT batch_id, avg(value) AS mu, var_samp(value) AS var FROM rw WHERE t <= seq_len GROUP BY batch_id)
        SELECT rollout_id, t, (value - mu) / sqrt(var + 1e-8) AS value_w FROM rw LEFT JOIN s ON rw.batch_id = s.batch_id""",
    ["value_w"],
    "G03 F03",
)
def whiten(spark, sf):
    """Values whitened with batch statistics over ``t <= seq_len``; masked-out
    rows are transformed too (no fill), as in the reference."""
    lt = long_of(spark, sf, ["value"])
    w = G.whiten_long(lt, "value", F.col("t") <= F.col("seq_len"), ["batch_id"], "value_w")
    return w.select("rollout_id", "t", "value_w")


@query(
    "whiten_rewards",
    f"""WITH {rewards_cte()}, s AS (SELECT batch_id, avg(reward) AS mu, var_samp(reward) AS var FROM rw GROUP BY batch_id)
        SELECT rollout_id, t, (reward - mu) / sqrt(var + 1e-8) + mu AS reward_w FROM rw LEFT JOIN s ON rw.batch_id = s.batch_id""",
    ["reward_w"],
    "G04",
)
def whiten_rewards(spark, sf):
    """Reward whitening over ``~padding_mask_p1`` with the mean kept, then zero fill."""
    ro = ppo_rewards(token_rollouts(spark, sf), replace(PPO, whiten_rewards=True))
    return token_long(ro, ["rewards"]).select("rollout_id", "t", F.col("rewards").alias("reward_w"))


@query("gae", f"WITH {GAE_CTE} SELECT rollout_id, t, adv AS advantage FROM aw", ["advantage"], "G05 W01")
def gae(spark, sf):
    """Generalised advantage estimation, backward recursion per rollout (γ=1, λ=0.95)."""
    return token_long(raw(spark, sf), ["adv_raw"]).select("rollout_id", "t", F.col("adv_raw").alias("advantage"))


@query("returns", f"WITH {GAE_CTE} SELECT rollout_id, t, ret AS returns FROM aw", ["returns"], "G06")
def returns_(spark, sf):
    """Returns = advantages + values, before whitening."""
    return token_long(raw(spark, sf), ["returns"]).select("rollout_id", "t", "returns")


@query("adv_whiten", f"WITH {GAE_CTE} SELECT rollout_id, t, adv_w AS advantage FROM aw", ["advantage"], "G07 A07 T7")
def adv_whiten(spark, sf):
    """Advantages whitened per batch over ``t <= seq_len`` then zero filled
    (the score slot is excluded)."""
    w = token_long(wide(spark, sf, keep=[]), ["advantages"], ["rollout_id"])
    return w.select("rollout_id", "t", F.col("advantages").alias("advantage"))


@query(
    "ppo_ratio",
    f"WITH {TOK_CTE} SELECT rollout_id, t, exp(new_logprob - logprob) AS ratio FROM tok",
    ["ratio"],
    "O01",
)
def ppo_ratio(spark, sf):
    """``exp(new_lp - lp)`` per token; the slot gives 1."""
    lt = token_long(token_rollouts(spark, sf), ["logprob", "new_logprob"])
    return lt.select("rollout_id", "t", O.ratio(F.col("new_logprob"), F.col("logprob")).alias("ratio"))


def batch_stats(spark, sf):
    return O.stats_from_sums(O.rollout_loss_sums(wide(spark, sf, keep=LOSS_COLS)), ["batch_id"])


def value_stats(spark, sf):
    """Batch statistics without the policy terms, which alone need whitening."""
    sums = O.rollout_loss_sums(raw(spark, sf).withColumn("advantages", F.col("adv_raw")))
    return O.stats_from_sums(sums, ["batch_id"])


@query("policy_loss", f"WITH {LOSS_CTE} SELECT batch_id, pg_loss, pg_clipfrac FROM ({stats_select('batch_id')})", ["pg_loss", "pg_clipfrac"], "O02")
def policy_loss(spark, sf):
    """Clipped policy loss per batch (masked mean over ``t <= seq_len``)."""
    return batch_stats(spark, sf).select("batch_id", "pg_loss", "pg_clipfrac")


@query("value_loss", f"WITH {LOSS_CTE} SELECT batch_id, vf_loss, vf_clipfrac FROM ({stats_select('batch_id')})", ["vf_loss", "vf_clipfrac"], "O03")
def value_loss(spark, sf):
    """Clipped value loss per batch (masked mean over ``t <= seq_len + 1``)."""
    return value_stats(spark, sf).select("batch_id", "vf_loss", "vf_clipfrac")


@query("clipfrac", f"WITH {LOSS_CTE} SELECT batch_id, pg_clipfrac, vf_clipfrac FROM ({stats_select('batch_id')})", ["pg_clipfrac", "vf_clipfrac"], "O04")
def clipfrac(spark, sf):
    """Share of positions where the clipped term is strictly greater."""
    return batch_stats(spark, sf).select("batch_id", "pg_clipfrac", "vf_clipfrac")


@query("approx_kl", f"WITH {LOSS_CTE} SELECT batch_id, approxkl FROM ({stats_select('batch_id')})", ["approxkl"], "O05 T5")
def approx_kl(spark, sf):
    """``0.5 * mean(Δlp²)`` over all B·L positions (pads count as 0)."""
    return value_stats(spark, sf).select("batch_id", "approxkl")


@query("total_loss", f"WITH {LOSS_CTE} SELECT batch_id, pg_loss, vf_loss, loss FROM ({stats_select('batch_id')})", ["pg_loss", "vf_loss", "loss"], "O06")
def total_loss(spark, sf):
    """``pg_loss + vf_coef * vf_loss`` per batch."""
    return batch_stats(spark, sf).select("batch_id", "pg_loss", "vf_loss", "loss")


def micro_assignment(spark, sf):
    """Rank of each rollout inside (batch, ppo_epoch) by md5 order,
    two-level so a large batch is not one task."""
    ro = TB.table(spark, sf, "orders").select(F.col("o_orderkey").alias("rollout_id"))
    ep = ro.withColumn("batch_id", F.col("rollout_id") % 8).withColumn(
        "ppo_epoch", F.explode(F.sequence(F.lit(0), F.lit(PPO.num_ppo_epochs - 1)))
    )
    ep = ep.withColumn("_h", md5_key(F.lit(SEED), F.col("ppo_epoch"), F.col("rollout_id")))
    rk = bucketed_row_number(ep, ["batch_id", "ppo_epoch"], ["_h"], hex_bucket("_h"), "rank").drop("_h")
    return rk.select(
        "rollout_id",
        F.col("ppo_epoch").cast("long").alias("ppo_epoch"),
        F.floor(F.col("rank") / PPO.mini_batch_size).cast("long").alias("mini"),
        F.floor((F.col("rank") % PPO.mini_batch_size) / PPO.micro_batch_size).cast("long").alias("micro"),
    )


def stats_table(spark, sf):
    sums = O.rollout_loss_sums(wide(spark, sf, keep=LOSS_COLS))
    mb = sums.join(micro_assignment(spark, sf), "rollout_id")
    return O.stats_from_sums(mb, ["run_id", "batch_id", "ppo_epoch", "mini", "micro"])


@query(
    "ppo_stats",
    f"WITH {ASSIGN_CTE} SELECT * EXCLUDE (run_id) FROM ps",
    STATS_COLS,
    "O07 B03 J07 G12",
)
def ppo_stats(spark, sf):
    """Statistics per (update, ppo_epoch, mini-batch, micro-batch)."""
    return stats_table(spark, sf).drop("run_id")


@query(
    "ratio_stats",
    f"WITH {ASSIGN_CTE} SELECT batch_id, count(*) AS n_stats, avg(ratio) AS ratio_mean, var_samp(ratio) AS ratio_var FROM ps GROUP BY batch_id",
    ["ratio_mean", "ratio_var"],
    "O08 G11",
)
def ratio_stats(spark, sf):
    """Mean and sample variance of the micro-batch ratio means per update."""
    st = stats_table(spark, sf)
    return st.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_stats"), F.avg("ratio").alias("ratio_mean"), F.var_samp("ratio").alias("ratio_var")
    )


UPDATE_SQL = f"""WITH {ASSIGN_CTE},
rl AS (SELECT rollout_id, any_value(run_id) AS run_id, any_value(batch_id) AS batch_id, any_value(score) AS score,
              any_value(score_raw) AS score_raw, sum(kl) AS kl_sum, sum(nsr) AS nsr_sum,
              sum(CASE WHEN t <= seq_len THEN -logprob ELSE 0.0 END) AS ent_valid,
              sum(CASE WHEN t <= seq_len THEN -logprob ELSE 0.0 END) - ({L} - any_value(seq_len) - 1) AS ent_ref
       FROM rw GROUP BY rollout_id
       UNION ALL SELECT rollout_id, run_id, batch_id, score, score_raw, 0.0, 0.0, 0.0, -{float(L)} FROM ros
       WHERE seq_len + 1 >= {L} AND seq_len < 0),
ob AS (SELECT run_id, batch_id, count(*) AS n_rollouts, avg(kl_sum) AS objective_kl, avg(ent_ref) AS objective_entropy,
              avg(ent_valid) AS objective_entropy_valid, avg(nsr_sum) AS objective_non_score_reward,
              avg(nsr_sum) + avg(score) AS objective_rlhf_reward, avg(score) AS objective_scores,
              avg(score_raw) AS objective_scores_raw
       FROM rl GROUP BY run_id, batch_id),
sb AS (SELECT run_id, batch_id, avg(approxkl) AS policy_approxkl_avg, avg(pg_clipfrac) AS policy_clipfrac_avg,
              avg(pg_loss) AS loss_policy_avg, avg(vf_loss) AS loss_value_avg, avg(vf_clipfrac) AS val_clipfrac_avg,
              avg(entropy) AS policy_entropy_avg, avg(ratio) AS val_ratio, var_samp(ratio) AS val_ratio_var
       FROM ps GROUP BY run_id, batch_id),
m AS (SELECT ob.*, sb.* EXCLUDE (run_id, batch_id),
             CAST(sum(n_rollouts) OVER (PARTITION BY ob.run_id ORDER BY ob.batch_id) AS BIGINT) AS episode,
             CAST(sum(n_rollouts) OVER (PARTITION BY ob.run_id ORDER BY ob.batch_id) AS DOUBLE)
               / sum(n_rollouts) OVER (PARTITION BY ob.run_id) AS epoch,
             {PPO.learning_rate} * (1 - CAST(row_number() OVER (PARTITION BY ob.run_id ORDER BY ob.batch_id) - 1 AS DOUBLE) / count(*) OVER (PARTITION BY ob.run_id)) * 1e6 AS lr_micro
      FROM ob JOIN sb ON ob.run_id = sb.run_id AND ob.batch_id = sb.batch_id)"""
UPDATE_DOUBLES = [
    "objective_kl", "objective_entropy", "objective_entropy_valid", "objective_non_score_reward",
    "objective_rlhf_reward", "objective_scores", "objective_scores_raw", "policy_approxkl_avg",
    "policy_clipfrac_avg", "loss_policy_avg", "loss_value_avg", "val_clipfrac_avg", "policy_entropy_avg",
    "val_ratio", "val_ratio_var", "epoch", "lr_micro",
]


def update_metrics_df(spark, sf):
    """One record per (run, update) in a single pass over the wide
    rollouts: per-rollout loss and objective sums in one projection, one
    join with the micro-batch assignment, one stats aggregate; the update
    record is derived from the stats rows (objective sums from epoch 0)."""
    w = wide(spark, sf, keep=[*LOSS_COLS, "kl", "non_score_reward", "score", "score_raw"])
    sl = F.col("seq_len")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    ent_valid = F.aggregate(F.filter("logprob", lambda v, i: i <= sl), F.lit(0.0), lambda a, v: a - v)
    sums = O.rollout_loss_sums(
        w,
        extra=[
            total(F.col("kl")).alias("kl_sum"),
            total(F.col("non_score_reward")).alias("nsr_sum"),
            ent_valid.alias("ent_valid"),
            (ent_valid - (F.lit(L) - sl - 1)).alias("ent_ref"),
            F.col("score"),
            F.col("score_raw"),
        ],
    )
    first = F.col("ppo_epoch") == 0
    e0 = lambda c: F.sum(F.when(first, F.col(c)))
    st = O.stats_from_sums(
        sums.join(micro_assignment(spark, sf), "rollout_id"),
        ["run_id", "batch_id", "ppo_epoch", "mini", "micro"],
        extra={
            "_n0": F.sum(F.when(first, F.lit(1))),
            **{f"_{c}": e0(c) for c in ("kl_sum", "nsr_sum", "ent_valid", "ent_ref", "score", "score_raw")},
        },
    )
    n = F.sum("_n0")
    mean = lambda c: F.sum(f"_{c}") / n
    m = st.groupBy("run_id", "batch_id").agg(
        n.cast("long").alias("n_rollouts"),
        mean("kl_sum").alias("objective_kl"),
        mean("ent_ref").alias("objective_entropy"),
        mean("ent_valid").alias("objective_entropy_valid"),
        mean("nsr_sum").alias("objective_non_score_reward"),
        (mean("nsr_sum") + mean("score")).alias("objective_rlhf_reward"),
        mean("score").alias("objective_scores"),
        mean("score_raw").alias("objective_scores_raw"),
        F.avg("approxkl").alias("policy_approxkl_avg"),
        F.avg("pg_clipfrac").alias("policy_clipfrac_avg"),
        F.avg("pg_loss").alias("loss_policy_avg"),
        F.avg("vf_loss").alias("loss_value_avg"),
        F.avg("vf_clipfrac").alias("val_clipfrac_avg"),
        F.avg("entropy").alias("policy_entropy_avg"),
        F.avg("ratio").alias("val_ratio"),
        F.var_samp("ratio").alias("val_ratio_var"),
    )
    # Running episode per run over its updates; one row per update here
    run_w = Window.partitionBy("run_id")
    upto = run_w.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    # learning rate before the update's scheduler step, linear decay, in millionths (it would
    # vanish in results rounded to 9 digits)
    lr = F.lit(PPO.learning_rate) * (1 - (F.row_number().over(run_w.orderBy("batch_id")) - 1).cast("double") / F.count(F.lit(1)).over(run_w))
    return m.withColumn("episode", F.sum("n_rollouts").over(upto).cast("long")).withColumn(
        "epoch", F.col("episode").cast("double") / F.sum("n_rollouts").over(run_w)
    ).withColumn("lr_micro", lr * 1e6)


@query("update_metrics", f"{UPDATE_SQL} SELECT * FROM m", UPDATE_DOUBLES, "M01 M02 M03 M04 G10 S10")
def update_metrics(spark, sf):
    """Per-update metric record: objective/*, policy/*, loss/*, val/*, episode, epoch."""
    return update_metrics_df(spark, sf)


@query(
    "entropy_forms",
    f"{UPDATE_SQL} SELECT run_id, batch_id, objective_entropy AS entropy_ref, objective_entropy_valid AS entropy_valid FROM m",
    ["entropy_ref", "entropy_valid"],
    "M02 T4",
)
def entropy_forms(spark, sf):
    """Reference entropy (each pad slot adds -1) next to the valid-token form: sums of the log
    probabilities alone, no GAE and no whitening."""
    ro = token_rollouts(spark, sf)
    valid = F.aggregate(F.filter("logprob", lambda v, i: i <= F.col("seq_len")), F.lit(0.0), lambda a, v: a - v)
    e = ro.select("run_id", "batch_id", "seq_len", valid.alias("v"))
    return e.groupBy("run_id", "batch_id").agg(
        F.avg(F.col("v") - (F.lit(L) - F.col("seq_len") - 1)).alias("entropy_ref"), F.avg("v").alias("entropy_valid")
    )


@query(
    "score_means",
    f"WITH {TOK_CTE} SELECT run_id, count(*) AS n_rollouts, avg(score_raw) AS score_raw_mean, avg(score) AS score_mean FROM ros GROUP BY run_id",
    ["score_raw_mean", "score_mean"],
    "M03 T6",
)
def score_means(spark, sf):
    """Raw and shaped score means per run (shaped runs overwrite scores before logging)."""
    ro = token_rollouts(spark, sf)
    return ro.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_rollouts"), F.avg("score_raw").alias("score_raw_mean"), F.avg("score").alias("score_mean")
    )


@query(
    "last_token_score",
    f"WITH {TOK_CTE} SELECT ros.rollout_id, tok.value AS last_value FROM ros LEFT JOIN tok ON ros.rollout_id = tok.rollout_id AND tok.t = ros.seq_len",
    ["last_value"],
    "A09",
)
def last_token_score(spark, sf):
    """Value at the last valid token of each rollout (``max_by`` on line order,
    a partial aggregate: no window); NULL for an empty response."""
    li = TB.table(spark, sf, "lineitem")
    last = li.groupBy(F.col("l_orderkey").alias("rollout_id")).agg(
        F.max_by(F.col("l_quantity") / 50, F.struct(*LINE_ORDER)).alias("last_value")
    )
    o = TB.table(spark, sf, "orders").select(F.col("o_orderkey").alias("rollout_id"))
    return o.join(last, "rollout_id", "left")


@query(
    "dpo_loss",
    f"""WITH {TOK_CTE},
      s AS (SELECT rollout_id, sum(CASE WHEN t <= seq_len THEN logprob ELSE 0.0 END) AS pol,
                   sum(CASE WHEN t <= seq_len THEN ref_logprob ELSE 0.0 END) AS ref, any_value(score) AS score
            FROM tok GROUP BY rollout_id),
      r AS (SELECT *, rollout_id // 2 AS pair_id,
                   row_number() OVER (PARTITION BY rollout_id // 2 ORDER BY score DESC, rollout_id) AS k,
                   count(*) OVER (PARTITION BY rollout_id // 2) AS n FROM s),
      g AS (SELECT pair_id, count(*) AS pair_size FROM r GROUP BY pair_id),
      c AS (SELECT * FROM r WHERE n = 2 AND k = 1), x AS (SELECT * FROM r WHERE n = 2 AND k = 2)
    SELECT g.pair_id, g.pair_size, c.rollout_id AS chosen_id, x.rollout_id AS rejected_id,
           0.1 * ((c.pol - c.ref) - (x.pol - x.ref)) AS margin,
           greatest(-(0.1 * ((c.pol - c.ref) - (x.pol - x.ref))), 0) + ln(1 + exp(-abs(0.1 * ((c.pol - c.ref) - (x.pol - x.ref))))) AS loss
    FROM g LEFT JOIN c ON c.pair_id = g.pair_id LEFT JOIN x ON x.pair_id = g.pair_id""",
    ["margin", "loss"],
    "R18",
)
def dpo_loss(spark, sf):
    """DPO loss on pairs of neighbouring rollouts (``rollout_id div 2``), the
    higher score chosen; sums of policy and reference logprobs over the
    response.  Groups of another size than 2 are reported with their size and no loss."""
    return dpo_pairs(token_rollouts(spark, sf))


def dpo_pairs(w, beta: float = 0.1):
    """R18 on wide rollouts; pairs come from ``min_by``/``max_by`` aggregates (no window)."""
    sl = F.col("seq_len")
    s = w.select(
        "rollout_id",
        "score",
        F.aggregate(F.filter("logprob", lambda v, i: i <= sl), F.lit(0.0), lambda a, v: a + v).alias("pol"),
        F.aggregate(F.filter("ref_logprob", lambda v, i: i <= sl), F.lit(0.0), lambda a, v: a + v).alias("ref"),
    ).withColumn("pair_id", F.expr("rollout_id div 2"))
    key = F.struct(F.col("score"), (-F.col("rollout_id")).alias("neg"))
    row = F.struct("rollout_id", "pol", "ref")
    p = s.groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("pair_size"), F.max_by(row, key).alias("c"), F.min_by(row, key).alias("x")
    )
    pair = F.col("pair_size") == 2
    p = p.select("pair_id", "pair_size", F.when(pair, F.col("c")).alias("c"), F.when(pair, F.col("x")).alias("x"))
    margin = beta * ((F.col("c.pol") - F.col("c.ref")) - (F.col("x.pol") - F.col("x.ref")))
    return p.select(
        "pair_id",
        "pair_size",
        F.col("c.rollout_id").alias("chosen_id"),
        F.col("x.rollout_id").alias("rejected_id"),
        margin.alias("margin"),
        F.when(pair, R.dpo_loss(F.col("c.pol"), F.col("x.pol"), F.col("c.ref"), F.col("x.ref"), beta)).alias("loss"),
    )


@query(
    "sample_cadence",
    """WITH u AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS update_no FROM orders),
         c AS (SELECT count(*) AS n FROM orders)
       SELECT o_orderkey, update_no FROM u, c WHERE (update_no - 1) % greatest(n // 10, 1) = 0""",
    [],
    "B07",
)
def sample_cadence(spark, sf):
    """Every ``max(1, total // 10)``-th update is sampled (updates = orders by key)."""
    from ..operators.batching import sample_cadence as cadence

    o = stored(TB.table(spark, sf, "orders").select("o_orderkey"), "order-keys")
    n = o.agg(F.count(F.lit(1))).scalar()
    u = global_row_number(o, ["o_orderkey"], span_bucket(o, "o_orderkey"), "rank")
    u = u.withColumn("update_no", F.col("rank") + 1).drop("rank")
    return cadence(u, "update_no", n, 10)
