"""Data-parallel ranks over the numeric rollouts and the prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PPO
from ..operators import ranks as K
from ..session import stored
from ..sources import tables as TB
from .bindings import ppo_raw_advantages, ppo_rewards, token_long, token_rollouts
from .q_ppo import GAE_CTE, rewards_cte
from .registry import query

WORLD = 4
SEED = PPO.seed
#: Rank of each rollout: neighbouring positions of the update's md5 order.
RANK_CTE = f"""rk AS (SELECT rollout_id, batch_id, pos // CAST(ceil(n / {float(WORLD)}) AS BIGINT) AS rank
  FROM (SELECT rollout_id, batch_id, count(*) OVER (PARTITION BY batch_id) AS n,
               row_number() OVER (PARTITION BY batch_id ORDER BY md5('{SEED}|' || CAST(batch_id AS VARCHAR) || '|' || CAST(rollout_id AS VARCHAR)), rollout_id) - 1 AS pos
        FROM ros))"""


def ranks_of(rollouts):
    """(rollout_id, rank), stored: read by the join and by nothing that needs the arrays."""
    ids = rollouts.select("rollout_id", (F.col("rollout_id") % 8).alias("batch_id"))
    return stored(K.deal_ranks(ids, "batch_id", "rollout_id", WORLD, SEED).select("rollout_id", "rank"), "ranks")


def order_ids(spark, sf):
    return TB.table(spark, sf, "orders").select(F.col("o_orderkey").alias("rollout_id"))


VALUES = ["kl_sum", "non_score_reward", "score", "rlhf_reward"]


@query(
    "rank_gather",
    f"""WITH {rewards_cte()}, {RANK_CTE},
    s AS (SELECT rollout_id, sum(kl) AS kl_sum, sum(nsr) AS nsr FROM rw GROUP BY rollout_id),
    v AS (SELECT ros.batch_id, rk.rank, coalesce(s.kl_sum, 0.0) AS kl_sum, coalesce(s.nsr, 0.0) AS non_score_reward, ros.score,
                 coalesce(s.nsr, 0.0) + ros.score AS rlhf_reward
          FROM ros JOIN rk ON ros.rollout_id = rk.rollout_id LEFT JOIN s ON s.rollout_id = ros.rollout_id),
    m AS (SELECT batch_id, rank, count(*) AS n, {', '.join(f'avg({v}) AS {v}' for v in VALUES)} FROM v GROUP BY batch_id, rank),
    g AS (SELECT batch_id, count(*) AS n_ranks, min(n) AS min_rank_rows, max(n) AS max_rank_rows,
                 {', '.join(f'avg({v}) AS {v}_gathered' for v in VALUES)} FROM m GROUP BY batch_id),
    a AS (SELECT batch_id, {', '.join(f'avg({v}) AS {v}_mean' for v in VALUES)} FROM v GROUP BY batch_id)
    SELECT g.*, a.* EXCLUDE (batch_id) FROM g JOIN a ON g.batch_id = a.batch_id""",
    [f"{v}_{k}" for v in VALUES for k in ("gathered", "mean")],
    "G12",
)
def rank_gather(spark, sf):
    """Objective values of an update gathered over its ranks (mean of rank means) next to the
    plain mean; they differ where the last rank is smaller."""
    ro = ppo_rewards(token_rollouts(spark, sf))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    sums = ro.select("rollout_id", "batch_id", total("kl").alias("kl_sum"), total("non_score_reward").alias("non_score_reward"), "score")
    sums = sums.withColumn("rlhf_reward", F.col("non_score_reward") + F.col("score"))
    return K.gathered(sums.join(ranks_of(order_ids(spark, sf)), "rollout_id"), "batch_id", VALUES)


@query(
    "rank_whiten",
    f"""WITH {GAE_CTE}, {RANK_CTE}, ar AS (SELECT av.*, rk.rank FROM av JOIN rk ON av.rollout_id = rk.rollout_id),
    sr AS (SELECT batch_id, rank, avg(adv) AS mu, var_samp(adv) AS var FROM ar WHERE t <= seq_len GROUP BY batch_id, rank)
    SELECT ar.rollout_id, ar.t, ar.rank, CASE WHEN t <= seq_len THEN (adv - mu) / sqrt(var + 1e-8) ELSE 0.0 END AS advantage
    FROM ar LEFT JOIN sr ON ar.batch_id = sr.batch_id AND ar.rank = sr.rank""",
    ["advantage"],
    "G12 G07",
)
def rank_whiten(spark, sf):
    """Advantages whitened inside each rank, as every process does on its own rollouts."""
    adv = ppo_raw_advantages(token_rollouts(spark, sf)).select("rollout_id", "batch_id", "seq_len", "adv_raw")
    adv = stored(adv.join(ranks_of(order_ids(spark, sf)), "rollout_id"), "rank-advantages")
    w = K.whiten_in_ranks(adv, "adv_raw", F.col("seq_len") + 1, ["batch_id", "rank"], "advantage")
    return token_long(w, ["advantage"], ["rollout_id", "rank"]).select("rollout_id", "t", "rank", "advantage")


def _sql_feistel(x: str, size: str, bits: str, turns: int = 4) -> str:
    """The rounds of ``ranks.feistel`` on columns, nested."""
    l, r = f"({x} >> {bits})", f"({x} & ((1::BIGINT << {bits}) - 1))"
    for i in range(turns):
        f = f"(CAST('0x' || substr(md5(CAST(seed AS VARCHAR) || '|{i}|' || CAST({r} AS VARCHAR)), 1, 15) AS BIGINT) & ((1::BIGINT << {bits}) - 1))"
        l, r = r, f"xor({l}, {f})"
    return f"(({l} << {bits}) | {r})"


@query(
    "rank_permutation",
    f"""WITH RECURSIVE o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n FROM orders),
    s AS (SELECT o_orderkey, idx // CAST(ceil(n / {float(WORLD)}) AS BIGINT) AS rank, idx % CAST(ceil(n / {float(WORLD)}) AS BIGINT) AS i,
                 CAST(ceil(n / {float(WORLD)}) AS BIGINT) AS each, n FROM o),
    z AS (SELECT *, least(each, n - rank * each) AS size, {SEED} + rank * {K.RANK_SEED_STEP} AS seed FROM s),
    b AS (SELECT *, CASE WHEN size <= 4 THEN 1 ELSE CAST(ceil(CAST(length(bin(size - 1)) AS DOUBLE) / 2) AS INTEGER) END AS bits FROM z),
    w(o_orderkey, rank, seed, size, bits, x) AS (
      SELECT o_orderkey, rank, seed, size, bits, {_sql_feistel('i', 'size', 'bits')} FROM b
      UNION ALL SELECT o_orderkey, rank, seed, size, bits, {_sql_feistel('x', 'size', 'bits')} FROM w WHERE x >= size)
    SELECT o_orderkey, rank, seed, x AS position FROM w WHERE x < size""",
    [],
    "B02",
)
def rank_permutation(spark, sf):
    """Each rank shuffles its own prompts with its own seed (``seed + rank * 100003``): the
    position of every row in its rank's permutation, computed from the row's index alone."""
    from ..operators.ranking import global_row_number, span_bucket

    o = stored(TB.table(spark, sf, "orders").select("o_orderkey"), "order-keys")
    n = o.count()
    each = -(-n // WORLD)
    idx = global_row_number(o, ["o_orderkey"], span_bucket(o, "o_orderkey"), "_i")
    rank = F.floor(F.col("_i") / F.lit(max(each, 1))).cast("long")
    out = idx.withColumn("rank", rank).withColumn("seed", K.rank_seed(SEED, F.col("rank")))
    at = F.col("_i") % F.lit(max(each, 1))
    sizes = [min(each, n - r * each) for r in range(WORLD)]
    position = F.lit(None).cast("long")
    for r in reversed(range(WORLD)):  # ranks share at most two sizes
        if sizes[r] > 0:
            position = F.when(F.col("rank") == r, K.permuted(at, F.col("seed"), sizes[r])).otherwise(position)
    return out.select("o_orderkey", "rank", "seed", position.alias("position"))
