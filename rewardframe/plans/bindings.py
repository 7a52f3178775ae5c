"""Driver tables bound to the reference's concepts (FIXTURES.md section B).

Every binding reads the whole table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PPO, SHAPING, PPOConfig
from ..functions import rewards as R
from ..functions import sequences as S
from ..functions.text import split_ws
from ..operators import advantages as G
from ..session import stored
from ..sources.tables import table

STOP_WORD = "and"  # stop/EOS token of the document rollouts
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def rlvr_completions(spark: SparkSession, sf: str) -> DataFrame:
    """Binding 1: completions in groups of 4 with an optional ground-truth label
    (documents LEFT JOIN benchmark on item_id = doc_id div 4)."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", F.col("text").alias("completion"), F.expr("doc_id div 4").alias("group_id")
    )
    bench = table(spark, sf, "benchmark").select(F.col("item_id").alias("group_id"), F.col("text").alias("label"))
    return docs.join(bench, "group_id", "left").withColumn("batch_id", F.expr("group_id % 8"))


def doc_rollouts(spark: SparkSession, sf: str, stop: str | None = STOP_WORD) -> DataFrame:
    """Binding 2: whitespace tokens of the whole document are the response,
    truncated at the first stop word (kept).  Ragged, so ``seq_len = size-1``."""
    return rollouts_of_documents(table(spark, sf, "documents"), stop)


def rollouts_of_documents(documents: DataFrame, stop: str | None = STOP_WORD) -> DataFrame:
    """Binding 2 on any documents DataFrame, batch or streaming (column functions only)."""
    d = documents.select("doc_id", "lang", "text", "n_chars")
    return (
        S.compute_once(d, tokens=split_ws("text"))
        .withColumn("post", S.truncate_at_stop("tokens", stop))
        .select(
            F.col("doc_id").alias("rollout_id"),
            F.expr("doc_id % 8").alias("batch_id"),
            "lang",
            "n_chars",
            "tokens",
            "post",
            S.seq_len_ragged("post").alias("seq_len"),
            S.contains_token("post", stop).alias("has_eos"),
            F.log1p(F.col("n_chars").cast("double")).alias("score_raw"),
        )
    )


def shaped_scores(ro: DataFrame, cfg=SHAPING) -> DataFrame:
    """Raw - missing EOS - length - repetition, each kept as a column; a penalty
    applies only with a coefficient over 0."""
    out = ro.withColumn("eos_penalty", R.missing_eos_penalty("has_eos", cfg.missing_eos_penalty)).withColumn(
        "length_penalty", R.length_penalty("seq_len", max(0.0, cfg.length_penalty_coef))
    )
    out = R.with_repetition_penalty(out, "post", "seq_len", cfg.repetition_n_gram, max(0.0, cfg.repetition_penalty_coef))
    return (
        out.withColumn(
            "score_shaped",
            F.col("score_raw") - F.col("eos_penalty") - F.col("length_penalty") - F.col("repetition_penalty"),
        )
    )


def conv_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Binding 3: a user turn followed by an assistant turn is (query, response).
    The window is per conversation (bounded by its turns)."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    w = Window.partitionBy("conv_id").orderBy("turn")
    nxt = c.withColumn("next_role", F.lead("role").over(w)).withColumn("next_text", F.lead("text").over(w))
    return nxt.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("query"), F.col("next_text").alias("response")
    )


def token_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with its lines sorted into token order."""
    # one hash shuffle by order: a partial (map-side) collect_list would not
    # reduce anything (a handful of lines per order), so aggregate after it
    li = table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER, "l_discount", "l_tax")
    li = li.repartition("l_orderkey")
    return li.groupBy(F.col("l_orderkey").alias("rollout_id")).agg(
        F.sort_array(F.collect_list(F.struct(*LINE_ORDER, "l_discount", "l_tax"))).alias("lines")
    )


def token_rollouts(spark: SparkSession, sf: str, cfg: PPOConfig = PPO) -> DataFrame:
    """Binding 4 in wide form: one row per order (orders without lines are
    empty responses), arrays over positions ``0..seq_len`` plus the score
    slot ``seq_len+1`` (logprob = ref = 1.0, value = 0.25) when it fits in L."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("rollout_id"), "o_totalprice")
    r = o.join(token_lines(spark, sf), "rollout_id", "left")
    lines = F.coalesce(F.col("lines"), F.array().cast(r.schema["lines"].dataType))
    too_long = F.raise_error(F.lit(f"a rollout has more than gen_len = {cfg.gen_len} tokens"))
    seq_len = F.when(F.size(lines) > cfg.gen_len, too_long).otherwise(F.size(lines) - 1).cast("int")
    slot = seq_len + 1 < cfg.gen_len

    def with_slot(per_line, slot_value: float):
        return F.concat(
            F.transform(lines, per_line),
            F.when(slot, F.array(F.lit(slot_value))).otherwise(G.empty_doubles()),
        )

    lp = lambda l: -(l["l_discount"] * 10 + 0.01)
    v = lambda l: l["l_quantity"] / 50
    out = r.select(
        "rollout_id",
        F.when(F.col("rollout_id") % 2 == 0, F.lit("baseline")).otherwise(F.lit("shaped")).alias("run_id"),
        (F.col("rollout_id") % 8).alias("batch_id"),
        seq_len.alias("seq_len"),
        with_slot(lp, 1.0).alias("logprob"),
        with_slot(lambda l: -(l["l_tax"] * 10 + 0.01), 1.0).alias("ref_logprob"),
        with_slot(v, 0.25).alias("value"),
        with_slot(lambda l: lp(l) + (l["l_tax"] - l["l_discount"]), 1.0).alias("new_logprob"),
        with_slot(lambda l: v(l) + (l["l_discount"] * 10 - 0.5), 0.25).alias("new_value"),
        (F.col("o_totalprice") / 1e5).alias("score_raw"),
    )
    return out.withColumn(
        "score",
        F.when(F.col("run_id") == "shaped", F.col("score_raw") - R.length_penalty("seq_len")).otherwise(
            F.col("score_raw")
        ),
    )


def ppo_rewards(ro: DataFrame, cfg: PPOConfig = PPO) -> DataFrame:
    """R09-R11 (+G04): per-token KL, KL reward and the score at its slot."""
    kl = F.zip_with("logprob", "ref_logprob", lambda lp, ref: R.kl_per_token(lp, ref, cfg.kl_estimator))
    place = F.when(F.col("seq_len") + 1 < cfg.gen_len, F.col("seq_len") + 1).otherwise(F.col("seq_len"))
    out = (
        ro.withColumn("kl", kl)
        .withColumn("non_score_reward", F.transform("kl", lambda k: -cfg.kl_coef * k))
        .withColumn("_place", place)
        .withColumn(
            "rewards",
            F.transform(
                "non_score_reward",
                lambda x, i: x + F.when(i == F.col("_place"), F.col("score")).otherwise(F.lit(0.0)),
            ),
        )
        .drop("_place")
    )
    if cfg.whiten_rewards:
        out = G.whiten_array(stored(out, "raw-rewards"), "rewards", F.col("seq_len") + 2, ["batch_id"], "rewards", shift_mean=False)
    return out


def ppo_raw_advantages(ro: DataFrame, cfg: PPOConfig = PPO) -> DataFrame:
    """GAE over the stored positions and returns."""
    out = ppo_rewards(ro, cfg)
    out = out.withColumn("adv_raw", G.gae(F.col("rewards"), F.col("value"), cfg.gamma, cfg.lam))
    return out.withColumn("returns", G.returns(F.col("adv_raw"), F.col("value")))


def ppo_advantages(ro: DataFrame, cfg: PPOConfig = PPO, keep: list[str] | None = None) -> DataFrame:
    """GAE, returns, and advantages whitened per batch over ``t <= seq_len`` then zero
    filled.  The chain up to GAE runs once: its rows (only the columns ``keep``, if given) are
    stored, and both the batch statistics and the result read them."""
    out = ppo_raw_advantages(ro, cfg)
    if keep is not None:
        out = out.select("rollout_id", "batch_id", "seq_len", "adv_raw", *keep)
    out = stored(out, "raw-advantages")
    return G.whiten_array(out, "adv_raw", F.col("seq_len") + 1, ["batch_id"], "advantages", fill=0.0)


def token_long(wide: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """Wide -> long: one row per stored position ``t`` (F04 table function)."""
    keep = keep or ["rollout_id", "run_id", "batch_id", "seq_len"]
    z = F.arrays_zip(*[F.col(c) for c in cols])
    # the _outer generator avoids the inferred ``size(z) > 0`` filter, which
    # would evaluate the whole per-rollout expression chain a second time
    return wide.select(*keep, F.posexplode_outer(z).alias("t", "_z")).where(F.col("t").isNotNull()).select(
        *keep, F.col("t").cast("int").alias("t"), *[F.col("_z")[c].alias(c) for c in cols]
    )
