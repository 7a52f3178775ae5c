"""E2 - verifiable rewards on completions in groups of 4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rewards as R
from ..functions.text import truthy, word_set
from ..operators import advantages as G
from ..operators import verifiable as V
from ..session import stored
from ..sources import tables as TB
from . import sqltext as Q
from .bindings import conv_pairs, rlvr_completions
from .registry import query

REWARD_SQL = Q.verifiable_reward("completion", "label")
GROUP_ADV_SQL = f"""WITH {Q.RLVR_CTE},
rw AS (SELECT doc_id, group_id, batch_id, lang, {Q.truthy('label')} AS has_label, {REWARD_SQL} AS reward FROM rc),
ga AS (SELECT *, avg(reward) OVER (PARTITION BY group_id) AS mu, stddev_samp(reward) OVER (PARTITION BY group_id) AS sd
       FROM rw)"""
ADV_SQL = "CASE WHEN sd IS NULL OR sd = 0 THEN 0.0 ELSE (reward - mu) / sd END"


def rewarded(spark, sf):
    rc = rlvr_completions(spark, sf)
    return rc.withColumn("has_label", truthy("label")).withColumn("reward", R.verifiable_reward("completion", "label"))


@query(
    "rlvr_reward_gt",
    f"WITH {Q.RLVR_CTE} SELECT doc_id, group_id, {Q.truthy('label')} AS has_label, {REWARD_SQL} AS reward FROM rc",
    ["reward"],
    "R05 R06 J03 F01",
)
def rlvr_reward_gt(spark, sf):
    """Reward of every completion; rows with a label take the ground-truth branch."""
    return rewarded(spark, sf).select("doc_id", "group_id", "has_label", "reward")


@query(
    "rlvr_reward_nogt",
    f"""WITH c AS (SELECT conv_id, turn, role, text, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS nr,
                          lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nt FROM conversations)
        SELECT conv_id, turn, CAST({Q.n_chars('nt')} AS BIGINT) AS n_chars, {Q.verifiable_reward('nt', None)} AS reward
        FROM c WHERE role = 'user' AND nr = 'assistant'""",
    ["reward"],
    "R06",
)
def rlvr_reward_nogt(spark, sf):
    """Assistant replies scored without ground truth (R06 branch)."""
    p = conv_pairs(spark, sf)
    return p.select(
        "conv_id", "turn", F.length("response").cast("long").alias("n_chars"), R.verifiable_reward("response", None).alias("reward")
    )


@query(
    "word_overlap",
    f"""WITH {Q.RLVR_CTE}
        SELECT doc_id, CAST(len({Q.word_set('completion')}) AS BIGINT) AS n_words,
               CAST(len({Q.word_set('label')}) AS BIGINT) AS n_label_words,
               CAST(len(list_intersect({Q.word_set('completion')}, {Q.word_set('label')})) AS BIGINT) AS n_common,
               {Q.overlap('completion', 'label')} AS overlap
        FROM rc""",
    ["overlap"],
    "R07 U02",
)
def word_overlap(spark, sf):
    """Recall of distinct lowercase words of the label found in the completion."""
    rc = rlvr_completions(spark, sf)
    c, g = word_set("completion"), word_set("label")
    return rc.select(
        "doc_id",
        F.size(c).alias("n_words"),
        F.size(g).alias("n_label_words"),
        F.size(F.array_intersect(c, g)).alias("n_common"),
        R.word_overlap("completion", "label").alias("overlap"),
    )


@query(
    "grpo_adv_group",
    f"{GROUP_ADV_SQL} SELECT doc_id, group_id, reward, {ADV_SQL} AS advantage FROM ga",
    ["reward", "advantage"],
    "G08 W05",
)
def grpo_adv_group(spark, sf):
    """Group-relative advantage, groups of 4 generations (eps 0)."""
    return G.group_advantage(rewarded(spark, sf), "reward", "group_id").select("doc_id", "group_id", "reward", "advantage")


@query(
    "grpo_adv_batch",
    f"""{GROUP_ADV_SQL}, bs AS (SELECT batch_id, stddev_samp(reward) AS bsd FROM rw GROUP BY batch_id)
        SELECT doc_id, group_id, ga.batch_id,
               CASE WHEN bsd IS NULL OR bsd = 0 THEN 0.0 ELSE (reward - mu) / bsd END AS advantage
        FROM ga JOIN bs ON ga.batch_id = bs.batch_id""",
    ["advantage"],
    "G09",
)
def grpo_adv_batch(spark, sf):
    """Centre by group mean, scale by the batch std (interpretation of "batch")."""
    # scored once: the group means and the batch deviation read the stored rewards
    r = stored(rewarded(spark, sf).select("doc_id", "group_id", "batch_id", "reward"), "rewards")
    out = G.batch_scaled_advantage(r, "reward", "group_id", "batch_id")
    return out.select("doc_id", "group_id", "batch_id", "advantage")


@query(
    "rlvr_summary",
    f"""{GROUP_ADV_SQL}
        SELECT lang, count(*) AS n_completions, count(*) FILTER (WHERE has_label) AS n_with_label,
               avg(reward) AS reward_mean, min(reward) AS reward_min, max(reward) AS reward_max,
               avg(abs({ADV_SQL})) AS adv_abs_mean
        FROM ga GROUP BY lang""",
    ["reward_mean", "reward_min", "reward_max", "adv_abs_mean"],
    "E2",
)
def rlvr_summary(spark, sf):
    """Flagship: E2 end to end (left join, rewards, group advantages) summarised per language."""
    adv = G.group_advantage(rewarded(spark, sf), "reward", "group_id")
    return adv.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_completions"),
        F.count(F.when(F.col("has_label"), 1)).alias("n_with_label"),
        F.avg("reward").alias("reward_mean"),
        F.min("reward").alias("reward_min"),
        F.max("reward").alias("reward_max"),
        F.avg(F.abs("advantage")).alias("adv_abs_mean"),
    )


def _rouge_sql(n: int) -> str:
    g = lambda e: Q.ngram_keys(e, n)
    return f"""WITH {Q.RLVR_CTE},
      lab AS MATERIALIZED (SELECT doc_id, {Q.rouge_tokens('completion')} AS tp, {Q.rouge_tokens('label')} AS tt
                           FROM rc WHERE {Q.truthy('label')}),
      p AS (SELECT doc_id, k, count(*) AS c FROM (SELECT doc_id, unnest({g('tp')}) AS k FROM lab) GROUP BY ALL),
      t AS (SELECT doc_id, k, count(*) AS c FROM (SELECT doc_id, unnest({g('tt')}) AS k FROM lab) GROUP BY ALL),
      i AS (SELECT p.doc_id, sum(least(p.c, t.c)) AS hit FROM p JOIN t ON p.doc_id = t.doc_id AND p.k = t.k GROUP BY p.doc_id),
      s AS (SELECT lab.doc_id, CAST(coalesce(i.hit, 0) AS DOUBLE) AS hit,
                   CAST(greatest(len(tp) - {n - 1}, 0) AS DOUBLE) AS np, CAST(greatest(len(tt) - {n - 1}, 0) AS DOUBLE) AS nt
            FROM lab LEFT JOIN i ON lab.doc_id = i.doc_id),
      f AS (SELECT doc_id, hit / greatest(np, 1) AS precision, hit / greatest(nt, 1) AS recall FROM s)
    SELECT rc.doc_id, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall,
           CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
    FROM rc LEFT JOIN f ON f.doc_id = rc.doc_id"""


def unlabelled_zero(rc, score):
    """ROUGE of every completion: 0.0 where there is no ground truth."""
    scores = score(rc.where(truthy("label")))
    out = rc.select("doc_id").join(scores, "doc_id", "left")
    return out.select("doc_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")])


@query("rouge1", _rouge_sql(1), ["precision", "recall", "f1"], "R08")
def rouge1(spark, sf):
    """ROUGE-1 precision/recall/F1 of completion vs label (no stemmer)."""
    return unlabelled_zero(rlvr_completions(spark, sf), lambda rc: V.rouge_n(rc, "doc_id", "completion", "label", 1))


@query("rouge2", _rouge_sql(2), ["precision", "recall", "f1"], "R08")
def rouge2(spark, sf):
    """ROUGE-2 precision/recall/F1 of completion vs label (no stemmer)."""
    return unlabelled_zero(rlvr_completions(spark, sf), lambda rc: V.rouge_n(rc, "doc_id", "completion", "label", 2))


ROUGE_L_SQL = f"""WITH {Q.RLVR_CTE},
      lab AS MATERIALIZED (SELECT doc_id, {Q.rouge_tokens('completion')} AS tp, {Q.rouge_tokens('label')} AS tt FROM rc WHERE {Q.truthy('label')}),
      p AS (SELECT doc_id, unnest(tp) AS w, generate_subscripts(tp, 1) AS i FROM lab),
      t AS (SELECT doc_id, unnest(tt) AS w, generate_subscripts(tt, 1) AS j FROM lab),
      m AS (SELECT p.doc_id, list(t.j ORDER BY p.i, t.j DESC) AS js FROM p JOIN t ON p.doc_id = t.doc_id AND p.w = t.w GROUP BY p.doc_id),
      -- least ends of the rising subsequences of each length
      l AS (SELECT doc_id, len(list_reduce(js, lambda e, j: list_concat(list_append(list_filter(e, lambda x: x < j), j),
                   e[len(list_filter(e, lambda x: x < j)) + 2:]), CAST([] AS BIGINT[]))) AS lcs FROM m),
      f AS (SELECT lab.doc_id, CAST(coalesce(lcs, 0) AS DOUBLE) / greatest(len(tp), 1) AS precision,
                   CAST(coalesce(lcs, 0) AS DOUBLE) / greatest(len(tt), 1) AS recall FROM lab LEFT JOIN l ON lab.doc_id = l.doc_id)
    SELECT rc.doc_id, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall,
           CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
    FROM rc LEFT JOIN f ON f.doc_id = rc.doc_id"""


@query("rougeL", ROUGE_L_SQL, ["precision", "recall", "f1"], "R08")
def rouge_l(spark, sf):
    """ROUGE-L precision/recall/F1 (longest common subsequence) per completion, 0.0 without a label."""
    return unlabelled_zero(rlvr_completions(spark, sf), lambda rc: V.rouge_l(rc, "doc_id", "completion", "label"))


@query(
    "rlvr_reward_registry",
    f"""WITH {Q.RLVR_CTE}
        SELECT doc_id, {REWARD_SQL} AS tldr, CASE WHEN {Q.truthy('label')} THEN {Q.overlap('completion', 'label')} END AS overlap_only
        FROM rc""",
    ["tldr", "overlap_only"],
    "F01",
)
def rlvr_reward_registry(spark, sf):
    """reward functions looked up by name in the registry and applied as columns."""
    rc = rlvr_completions(spark, sf)
    return rc.select(
        "doc_id",
        V.reward_fn("tldr")(F.col("completion"), F.col("label")).alias("tldr"),
        V.reward_fn("overlap_only")(F.col("completion"), F.col("label")).alias("overlap_only"),
    )


@query(
    "message_rewards",
    f"""WITH m AS (SELECT conv_id, min_by(text, turn) FILTER (WHERE role = 'assistant') AS completion, min_by(text, turn) FILTER (WHERE role = 'user') AS label
               FROM conversations GROUP BY conv_id)
        SELECT conv_id, {REWARD_SQL} AS reward FROM m""",
    ["reward"],
    "F01",
)
def message_rewards(spark, sf):
    """Completions and labels as message records (role, content): the reward of each
    conversation's first answer, its first question standing in for the label."""
    c = TB.table(spark, sf, "conversations")
    said = lambda role: F.when(F.col("role") == role, F.struct(F.col("role"), F.col("text").alias("content")))
    first = lambda role: F.min_by(said(role), F.when(F.col("role") == role, F.col("turn")))
    g = c.groupBy("conv_id").agg(first("assistant").alias("a"), first("user").alias("label"))
    g = g.withColumn("completion", F.array_compact(F.array("a")))
    return V.with_reward(g, "tldr", "completion", "label").select("conv_id", "reward")
