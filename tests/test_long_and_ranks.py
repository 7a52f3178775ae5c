"""Block scans, ranks, seeded permutations, metric log, change points, bucketed joins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from rewardframe.operators import ranks as K
from rewardframe.operators.changepoint import cusum_shift
from rewardframe.operators.preferences import rank_pairs
from rewardframe.operators.ranking import bucketed_row_number, bucketed_running_sum, span_bucket
from rewardframe.operators.scans import block_width, discounted_suffix_sums, gae_scan
from rewardframe.session import stored
from rewardframe.sources import metric_log as ML
from rewardframe.sources.bucketed import write_bucketed
from rewardframe.streaming.runner import read_stream, run_handler
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _gae(r, v, gamma, lam):
    out, last = np.zeros(len(r)), 0.0
    for i in range(len(r) - 1, -1, -1):
        nxt = v[i + 1] if i + 1 < len(v) else 0.0
        last = r[i] + gamma * nxt - v[i] + gamma * lam * last
        out[i] = last
    return out


@pytest.mark.parametrize("gamma,lam,block", [(1.0, 0.95, 256), (0.99, 0.9, 7), (0.5, 0.02, 256), (1.0, 1.0, 64), (0.9, 0.0, 16), (0.0, 0.9, 16)])
def test_gae_scan_of_long_rollouts(spark, gamma, lam, block):
    rng = np.random.default_rng(4)
    sizes = {"long": 100_000 if (gamma, lam) == (1.0, 0.95) else 3_000, "a": 1, None: 600, "b": 257}
    rows, want = [], {}
    for k, n in sizes.items():
        r, v = rng.normal(size=n), rng.normal(size=n)
        want[k] = _gae(r, v, gamma, lam)
        rows += [(k, i, float(r[i]), float(v[i])) for i in range(n)]
    df = stored(spark.createDataFrame(rows, "k string, t long, r double, v double"), "test-long")
    got = gae_scan(df, ["k"], "t", "r", "v", gamma, lam, block).toPandas()
    assert len(got) == len(rows)
    for k, n in sizes.items():
        a = got[got.k.isnull()] if k is None else got[got.k == k]
        if k is None and lam * gamma == 0 and gamma:
            continue  # the shifted self-join of the degenerate case needs a key
        assert np.allclose(a.sort_values("t").advantage.to_numpy(), want[k], rtol=1e-9, atol=1e-9), k


def test_long_rollout_is_not_one_task(spark):
    df = stored(spark.range(200_000).selectExpr("1L as k", "id as t", "1.0D as r", "0.0D as v"), "test-one")
    out = gae_scan(df, ["k"], "t", "r", "v")
    assert "hashpartitioning(_blk" in _plan(out) and "hashpartitioning(k" not in _plan(out)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = gae_scan(df, ["k"], "t", "r", "v")
        most = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most < 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_suffix_sums_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, i, {0: 1.0, 10: 4.0}.get(i)) for i in range(11)], "k long, t long, x double")
    got = {r["t"]: r["x_sum"] for r in discounted_suffix_sums(df, ["k"], "t", ["x"], 0.5, 4).collect()}
    assert got[0] == pytest.approx(1 + 4 * 0.5**10) and got[9] == 2.0 and got[10] == 4.0
    assert discounted_suffix_sums(df.limit(0), ["k"], "t", ["x"], 0.5).count() == 0
    with pytest.raises(ValueError):
        discounted_suffix_sums(df, ["k"], "t", ["x"], 1.5)
    assert 0.001 ** block_width(0.001) > 0


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "g string, x long")
    r = bucketed_row_number(df, ["g"], ["x"], span_bucket(df, "x", 8)).collect()
    assert sorted((x["g"] or "", x["x"], x["rank"]) for x in r) == [("", 3, 0), ("", 4, 1), ("a", 1, 0), ("a", 2, 1)]
    s = bucketed_running_sum(df, ["g"], ["x"], "x", span_bucket(df, "x", 8), "s").collect()
    assert sorted((x["g"] or "", x["s"]) for x in s) == [("", 3), ("", 7), ("a", 1), ("a", 3)]
    c = spark.createDataFrame([("a", 1, 1.0), (None, 2, 2.0), ("a", 5, 3.0)], "g string, k long, s double")
    j = spark.createDataFrame([(None, 3, 0.5), ("a", 4, 0.6)], "g string, k long, s double")
    pairs = sorted((x["g"] or "", x["chosen_id"] or 0, x["rejected_id"] or 0) for x in rank_pairs(c, j, "g", "k", "s").collect())
    assert pairs == [("", 0, 3), ("", 2, 0), ("a", 1, 4), ("a", 5, 0)]


def test_unequal_ranks(spark):
    df = spark.range(10).selectExpr("id", "0L as u", "cast(id as double) as v")
    dealt = K.deal_ranks(df, "u", "id", 4)
    sizes = sorted(r["count"] for r in dealt.groupBy("rank").count().collect())
    assert sizes == [1, 3, 3, 3]
    g = K.gathered(dealt, "u", ["v"]).first()
    by = {}
    for r in dealt.collect():
        by.setdefault(r["rank"], []).append(r["v"])
    assert g["v_gathered"] == pytest.approx(np.mean([np.mean(x) for x in by.values()]))
    assert g["v_mean"] == 4.5 and g["v_gathered"] != pytest.approx(4.5)
    assert (g["n_ranks"], g["min_rank_rows"], g["max_rank_rows"]) == (4, 1, 3)


def test_rank_gather_differs_from_the_plain_mean(spark):
    got = E.queries()["rank_gather"](spark, SF001).collect()
    unequal = [r for r in got if r["min_rank_rows"] < r["max_rank_rows"]]
    assert unequal and all(r["score_gathered"] != r["score_mean"] for r in unequal)
    assert all(r["score_gathered"] == pytest.approx(r["score_mean"]) for r in got if r not in unequal)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000])
def test_permutations_hit_every_index_once(spark, size):
    df = spark.range(size)
    a = [r[0] for r in df.select(K.permuted(F.col("id"), F.lit(42), size)).collect()]
    b = [r[0] for r in df.select(K.permuted(F.col("id"), K.rank_seed(42, F.lit(1)), size)).collect()]
    assert sorted(a) == sorted(b) == list(range(size))
    assert size < 16 or (a != b and a != list(range(size)))
    assert "Exchange" not in _plan(df.select(K.permuted(F.col("id"), F.lit(42), size)))


def test_log_written_twice_is_the_same(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.6), (None, 1, 0.7), ("b/c=d", 3, None)], "run_id string, update long, loss double")
    for _ in range(2):
        ML.write_records(rows, path)
    ML.write_records(rows.where("update = 2").withColumn("loss", F.lit(9.0)), path)
    got = ML.read_records(spark, path, rows.schema)
    assert got.schema == rows.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.withColumn("loss", F.when(F.col("update") == 2, 9.0).otherwise(F.col("loss"))).collect()))
    assert ML.read_records(spark, str(tmp_path / "none"), rows.schema).count() == 0


def test_stream_log_keeps_the_newest_record(spark, tmp_path):
    src, log = str(tmp_path / "in"), str(tmp_path / "log")
    sink = ML.log_sink(log)

    def run(rows, mode):
        spark.createDataFrame(rows, "run_id string, update long, loss double").coalesce(1).write.mode(mode).parquet(src)
        run_handler(read_stream(spark, src), sink, "log", location=str(tmp_path / "q"))

    run([("a", 1, 1.0), ("a", 2, 2.0)], "overwrite")
    run([("a", 2, 5.0), ("b", 1, 3.0)], "append")  # goes on from the checkpoint
    schema = spark.createDataFrame([], "run_id string, update long, loss double").schema
    want = [("a", 1, 1.0), ("a", 2, 5.0), ("b", 1, 3.0)]
    assert sorted(map(tuple, ML.read_records(spark, log, schema).collect())) == want
    sink(spark.createDataFrame(want[1:], schema), 1)  # the last micro-batch again
    assert sorted(map(tuple, ML.read_records(spark, log, schema).collect())) == want


def test_cusum_finds_the_step(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.1, 700), rng.normal(1, 0.1, 300)])
    rows = [("r", i, float(v)) for i, v in enumerate(x)] + [(None, 0, 1.0), ("flat", 0, 2.0), ("flat", 1, 2.0), ("gap", 5, None)]
    df = spark.createDataFrame(rows, "run string, step long, x double")
    got = {r["run"]: r for r in cusum_shift(df, ["run"], "step", "x", buckets=16).collect()}
    assert got["r"]["shift_after"] == 699 and got["r"]["shift"] == pytest.approx(x[700:].mean() - x[:700].mean())
    assert got["r"]["n_steps"] == 1000
    assert got[None]["n_steps"] == 1 and got[None]["shift_after"] is None and got["flat"]["shift"] is None and "gap" not in got


def test_bucketed_tables_join_without_exchange(spark):
    a = write_bucketed(spark.range(1000).selectExpr("id as k", "id * 2 as a"), "left", "k")
    b = write_bucketed(spark.range(500).selectExpr("id * 2 as k", "id as b"), "right", "k")
    j = a.hint("merge").join(b.hint("merge"), "k")
    plan = _plan(j)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert j.count() == 500


def test_join_ref_has_no_exchange_and_one_scan_a_table(spark):
    plan = _plan(E.queries()["join_ref"](spark, SF001))
    assert "Exchange" not in plan and plan.count("FileScan") == 3 and "collect_list" not in plan


def test_dpo_reports_groups_that_are_no_pair(spark):
    from rewardframe.plans.q_ppo import dpo_pairs

    rows = [(0, 2.0), (1, 1.0), (2, 3.0), (5, 1.0)] + [(6, 0.0), (6, 1.0), (7, 2.0)]
    df = spark.createDataFrame([(i, 0, s, [-1.0 - s], [-1.5]) for i, s in rows], "rollout_id long, seq_len int, score double, logprob array<double>, ref_logprob array<double>")
    got = {r.pair_id: r for r in dpo_pairs(df).collect()}
    assert {k: r.pair_size for k, r in got.items()} == {0: 2, 1: 1, 2: 1, 3: 3}
    assert got[0].chosen_id == 0 and got[0].rejected_id == 1 and got[0].loss > 0
    assert all(got[k].loss is None and got[k].margin is None and got[k].chosen_id is None for k in (1, 2, 3))


def test_batch_plan_of_several_ranks():
    from rewardframe.operators.batching import BatchPlan

    p = BatchPlan(per_device_train_batch_size=4, gradient_accumulation_steps=8, world_size=3, num_mini_batches=4)
    assert (p.local_batch_size, p.batch_size, p.mini_batch_size, p.micro_batch_size, p.local_mini_batch_size) == (32, 96, 24, 12, 8)
    p.check_whitening()
    with pytest.raises(ValueError):
        BatchPlan(4, 4, 3, 4).check_whitening()
    with pytest.raises(ValueError):
        _ = BatchPlan(1, 3, 4, 2).local_mini_batch_size


def test_lag_across_buckets(spark):
    from rewardframe.operators.ranking import bucketed_lag

    df = spark.createDataFrame([(None if i % 3 == 0 else "a", i, i * 10 if i % 4 else None) for i in range(60)], "g string, x long, v long")
    got = {(r.g, r.x): r.p for r in bucketed_lag(df, ["g"], ["x"], "v", span_bucket(df, "x", 7), "p").collect()}
    for g in (None, "a"):
        xs = [i for i in range(60) if (i % 3 == 0) == (g is None)]
        assert [got[g, x] for x in xs] == [None] + [i * 10 if i % 4 else None for i in xs[:-1]]
