"""Plan shapes that the performance notes rely on."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_token_filter_stays_above_generator(spark):
    plan = _plan(E.queries()["eval_head"](spark, SF001))
    # the tokeniser runs once, inside the generator; the size filter sits above it
    assert plan.count("split(") == 1
    assert plan.index("Filter") < plan.index("Generate")


def test_gae_chain_not_duplicated_by_inferred_filter(spark):
    from rewardframe.plans.bindings import token_long
    from rewardframe.plans.q_ppo import raw

    plan = _plan(token_long(raw(spark, SF001), ["adv_raw"]))
    assert "size(aggregate(" not in plan and plan.count("reverse(") == 1


def test_chain_below_whitening_runs_once(spark):
    # everything up to the raw advantages is one stored table that statistics and result read
    for name in ("adv_whiten", "ppo_stats", "update_metrics", "ratio_stats", "policy_loss"):
        plan = _plan(E.queries()[name](spark, SF001))
        assert "lineitem" not in plan and "collect_list" not in plan and "reverse(" not in plan, name


def test_ngrams_of_a_row_stay_in_the_row(spark):
    for name in ("ngram_counts", "repetition_multi", "shaped_score"):
        plan = _plan(E.queries()[name](spark, SF001))
        assert "Exchange" not in plan and plan.count("split(") == 1, name


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["kl_k1"](spark, SF001))
    assert "l_returnflag" not in plan and "l_shipdate" not in plan


def test_explicit_broadcast_only_for_bounded_dimension(spark):
    from rewardframe.sources.logs import label_special

    df = spark.createDataFrame([(151645,)], "tid long")
    assert "BroadcastHashJoin" in _plan(label_special(df, "tid"))


def test_approxkl_prunes_gae(spark):
    # approxkl needs only the two logprob arrays: GAE and whitening are pruned
    assert "reverse(" not in _plan(E.queries()["approx_kl"](spark, SF001))
    assert "reverse(" in _plan(E.queries()["value_loss"](spark, SF001))


def test_whitening_does_not_shuffle_token_arrays_by_batch(spark):
    # batch statistics come back as a stored table of known size, so only they move
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200KB")
    try:
        import re

        for name in ("adv_whiten", "whiten_rewards", "ppo_stats", "update_metrics", "grpo_adv_batch", "whiten"):
            assert not re.search(r"hashpartitioning\(batch_id#\d+L?, \d+\)", _plan(E.queries()[name](spark, SF001))), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_quantile_buckets_survive_an_outlier_key(spark):
    from rewardframe.operators.ranking import span_bucket

    df = spark.range(20_000).unionByName(spark.createDataFrame([(10**12,), (None,)], "id long"))
    sizes = df.groupBy(span_bucket(df, "id", 64).alias("b")).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 20_000 / 64
    monotone = df.where("id is not null").groupBy(span_bucket(df, "id", 64).alias("b")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    rows = sorted(monotone.collect())
    assert all(x.hi < y.lo for x, y in zip(rows, rows[1:]))
