"""Preference pairs and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rewards import log_sigmoid_loss
from .ranking import bucketed_row_number, span_bucket


def rank_pairs(chosen: DataFrame, rejected: DataFrame, group: str, key: str, score: str, buckets: int = 4096) -> DataFrame:
    """J02 rank zip: the k-th chosen row of a group (by ``key``) is paired with
    the k-th rejected row; the longer side's surplus keeps NULL on the other, and so
    does every row of the NULL group (an unknown group matches none).
    Linear in the input (no all-pairs); ranks are
    built in two levels (at most ``buckets`` key ranges) so a large group is
    not one task."""

    def ranked(df, side):
        r = bucketed_row_number(df, [group], [key], span_bucket(df, key, buckets), "pair_rank")
        return r.select(group, "pair_rank", F.col(key).alias(f"{side}_id"), F.col(score).alias(f"score_{side}"))

    return ranked(chosen, "chosen").join(ranked(rejected, "rejected"), [group, "pair_rank"], "full_outer")


def preference_metrics(pairs: DataFrame, keys: list[str], chosen: str = "score_chosen", rejected: str = "score_rejected") -> DataFrame:
    """Mean ``-log sigmoid(r_c - r_r)``, accuracy and margin per ``keys`` over
    the complete pairs; ``n_unpaired`` counts the others."""
    d = F.col(chosen) - F.col(rejected)
    return pairs.groupBy(*keys).agg(
        F.count(d).alias("n_pairs"),
        F.count(F.when(d.isNull(), 1)).alias("n_unpaired"),
        F.avg(log_sigmoid_loss(d)).alias("loss"),
        F.avg(F.when(d > 0, F.lit(1.0)).when(d <= 0, F.lit(0.0))).alias("accuracy"),
        F.avg(d).alias("margin"),
    )


def weighted_reward(weights: dict[str, float]) -> Column:
    """Weighted sum of reward columns (weights are parameters; NULL adds 0)."""
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.lit(float(w)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return out


def fit_bradley_terry(pairs: DataFrame, chosen_vec: str, rejected_vec: str, max_iter: int = 50):
    """Reward head fitted as logistic regression without intercept on
    ``x_c - x_r`` (label 1) and ``x_r - x_c`` (label 0); the Bradley-Terry
    likelihood of the preference pairs."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    diff = F.zip_with(chosen_vec, rejected_vec, lambda a, b: a.cast("double") - b.cast("double"))
    pos = pairs.select(array_to_vector(diff).alias("features"), F.lit(1.0).alias("label"))
    neg = pairs.select(array_to_vector(F.transform(diff, lambda v: -v)).alias("features"), F.lit(0.0).alias("label"))
    lr = LogisticRegression(fitIntercept=False, maxIter=max_iter, regParam=0.0)
    return lr.fit(pos.unionByName(neg))
