"""Golden values from FIXTURES.md section C (computed independently with numpy)."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rewardframe.config import PPO
from rewardframe.functions import logits as LG
from rewardframe.functions import rewards as R
from rewardframe.functions import sequences as S
from rewardframe.operators import advantages as G
from rewardframe.operators import losses as O
from rewardframe.plans.bindings import ppo_advantages, ppo_rewards

approx = lambda v, rel=0, abs_=1e-6: pytest.approx(v, abs=abs_)


def test_c1_c2_gae_returns_whitening(spark):
    r = [-0.2608, 0.2625, 0.2393, 1.8045]
    v = [-0.2169, -0.0679, -0.2465, 0.7171]
    df = spark.createDataFrame([(1, 0, r, v)], "id long, batch_id long, r array<double>, v array<double>")
    df = df.withColumn("adv", G.gae(F.col("r"), F.col("v"), 1.0, 0.95)).withColumn("ret", G.returns(F.col("adv"), F.col("v")))
    row = df.first()
    assert row.adv == approx([1.985832, 2.208033, 2.235930, 1.087400])
    assert row.ret == approx([1.768932, 2.140133, 1.989430, 1.804500])
    w = G.whiten_array(df, "adv", F.lit(4), ["batch_id"], "w").first().w
    assert w == approx([0.197407, 0.609149, 0.660842, -1.467398])
    w2 = G.whiten_array(df, "adv", F.lit(4), ["batch_id"], "w", shift_mean=False).first().w
    assert w2 == approx([2.076706, 2.488448, 2.540141, 0.411901])


def test_gae_long_form_matches_in_row(spark):
    r = [-0.2608, 0.2625, 0.2393, 1.8045]
    v = [-0.2169, -0.0679, -0.2465, 0.7171]
    long = spark.createDataFrame([(1, t, r[t], v[t]) for t in range(4)], "rid long, t int, r double, v double")
    out = sorted(G.gae_grouped(long, "rid", "t", "r", "v").collect(), key=lambda x: x.t)
    assert [x.advantage for x in out] == approx([1.985832, 2.208033, 2.235930, 1.087400])


def test_c3_value_loss(spark):
    vpred = [-1.0219, -0.0490, -0.1745, 1.6224]  # worked inputs of the notes
    old = [-0.2169, -0.0679, -0.2465, 0.7171]
    ret = [-0.2608, 0.2625, 0.2393, 1.7703]
    rows = [(vpred[i], old[i], ret[i]) for i in range(4)]
    df = spark.createDataFrame(rows, "vp double, old double, ret double")
    clipped = F.least(F.greatest(F.col("vp"), F.col("old") - 0.2), F.col("old") + 0.2)
    a, b = O.vf_terms(F.col("vp"), F.col("old"), F.col("ret"), 0.2)
    out = df.agg(F.collect_list(clipped).alias("c"), (0.5 * F.avg(F.greatest(a, b))).alias("loss"),
                 F.avg(F.when(b > a, 1.0).otherwise(0.0)).alias("cf")).first()
    assert out.c == approx([-0.4169, -0.0490, -0.1745, 0.9171])
    assert out.loss == pytest.approx(0.1969357675, abs=1e-9)
    assert out.cf == 0.25


def test_c4_policy_loss(spark):
    new = [-0.1687, -2.4028, -1.2637, -0.0962]  # worked inputs of the notes
    old = [-0.1887, -3.4028, -1.3637, -1.0962]
    adv = [1.9858, 2.2080, 2.2359, 1.0874]
    df = spark.createDataFrame([(new[i], old[i], adv[i]) for i in range(4)], "nl double, lp double, a double")
    r = O.ratio(F.col("nl"), F.col("lp"))
    l1, l2 = O.pg_terms(F.col("a"), r, 0.2)
    out = df.agg(F.collect_list(r).alias("r"), F.avg(F.greatest(l1, l2)).alias("loss"),
                 F.avg(F.when(l2 > l1, 1.0).otherwise(0.0)).alias("cf"),
                 (0.5 * F.avg((F.col("nl") - F.col("lp")) ** 2)).alias("kl")).first()
    assert out.r == approx([1.020201, 2.718282, 1.105171, 2.718282])
    assert out.loss == pytest.approx(-2.112861869, abs=1e-4)
    assert out.cf == 0.5
    assert out.kl == pytest.approx(0.2513, abs=1e-4)


def test_c5_kl(spark):
    df = spark.createDataFrame([(-1.0, -1.5), (-1.5, -1.0), (1.0, 1.0)], "lp double, ref double")
    rows = df.select(R.kl_per_token("lp", "ref", "k1").alias("k1"), R.kl_per_token("lp", "ref", "k3").alias("k3")).collect()
    assert [r.k1 for r in rows] == approx([0.5, -0.5, 0.0])
    assert [r.k3 for r in rows] == approx([0.106531, 0.148721, 0.0])
    with pytest.raises(ValueError):
        R.kl_per_token("lp", "ref", "k2")


def test_c6_repetition(spark):
    seqs = [[1, 2, 3, 1, 2, 3], [1, 1, 1, 1, 1, 1], [1, 2], [1, 2, 3, 4], [1, 2, 3] * 3]
    df = spark.createDataFrame([(s,) for s in seqs], "x array<int>")
    # the lists are already x[:seq_len]: feed x + [stop] with seq_len = len(x)
    df = df.select(F.concat("x", F.array(F.lit(9))).alias("post"), F.size("x").alias("seq_len"))
    out = [r.p for r in R.with_repetition_penalty(df, out="p").collect()]
    assert out == approx([0.025, 0.025, 0.0, 0.0, 0.042857])
    col = [r.p for r in df.select(R.repetition_penalty("post", "seq_len").alias("p")).collect()]
    assert col == approx(out)


def test_c7_verifiable_reward(spark):
    cases = [("", "a b", -0.6), ("", None, -0.5), ("   ", "a b", -0.594), ("The cat sat", "the cat ran", 0.488667),
             ("x" * 50, "y", 0.3), ("x" * 200, None, 0.4), ("x" * 300, "x", 0.0), ("x" * 300, None, 0.0),
             ("short", None, 0.1), ("short", "", 0.1), ("short", "   ", 0.01)]
    df = spark.createDataFrame([(c, g) for c, g, _ in cases], "c string, g string")
    got = [r.r for r in df.select(R.verifiable_reward("c", "g").alias("r")).collect()]
    assert got == approx([e for _, _, e in cases])


def test_c8_logsoftmax_entropy(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2)], "z array<double>, i int")
    r = df.select(LG.selective_log_softmax(F.col("z"), F.col("i")).alias("lp"), LG.entropy(F.col("z")).alias("h")).first()
    assert r.lp == pytest.approx(-0.407606, abs=1e-6)
    assert r.h == pytest.approx(0.832396, abs=1e-6)


def test_c9_preference_loss(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-1.0,)], "d double")
    got = [r.l for r in df.select(R.log_sigmoid_loss(F.col("d")).alias("l")).collect()]
    assert got == approx([0.693147, 0.313262, 1.313262])


def test_c10_group_advantages(spark):
    rows = [(1, float(v)) for v in (1, 2, 3, 4)] + [(2, 2.0)] * 4 + [(3, 5.0)]
    df = spark.createDataFrame(rows, "g long, r double")
    out = G.group_advantage(df, "r", "g").orderBy("g", "r").collect()
    assert [x.advantage for x in out if x.g == 1] == approx([-1.161895, -0.387298, 0.387298, 1.161895])
    assert [x.advantage for x in out if x.g == 2] == [0.0] * 4
    assert [x.advantage for x in out if x.g == 3] == [0.0]  # group of one: NULL std -> 0


def test_c11_truncation(spark):
    df = spark.createDataFrame([([5, 9, 7, 9],), ([5, 6, 7, 8],), ([9, 1, 2, 3],), ([0, 0, 0, 0],)], "x array<int>")
    post = S.truncate_padded("x", 9, 0)
    rows = df.select(post.alias("p"), S.seq_len_padded(post, 0).alias("sl")).collect()
    assert [r.p for r in rows] == [[5, 9, 0, 0], [5, 6, 7, 8], [9, 0, 0, 0], [0, 0, 0, 0]]
    assert [r.sl for r in rows] == [1, 3, 0, -1]
    assert df.select(R.length_penalty(F.lit(-1)).alias("p")).first().p == pytest.approx(-0.01)
    # ragged form keeps the stop, idempotent
    rag = df.select(S.truncate_at_stop("x", 9).alias("p")).select(S.truncate_at_stop("p", 9).alias("q"), "p").collect()
    assert all(r.p == r.q for r in rag)
    assert df.select(S.truncate_at_stop("x", None).alias("p")).first().p == [5, 9, 7, 9]


def _c12_batch(spark):
    lp = [[-1, -2, -0.5, -3, -4], [-0.3, -0.7, -1.1, -0.2, -0.9]]
    ref = [[-1.2, -1.5, -0.5, -2, -1], [-0.4, -0.6, -1, -0.3, -0.8]]
    v = [[0.1, 0.2, 0.3, 0.4, 0.5], [0.5, 0.4, 0.3, 0.2, 0.1]]
    seq, scores, L = [2, 4], [1.5, -0.5], 5
    rows = []
    for b in range(2):
        n = min(seq[b] + 2, L)  # stored: tokens plus the score slot when it fits
        mask_lp = [float(lp[b][t]) if t <= seq[b] else 1.0 for t in range(n)]
        mask_ref = [float(ref[b][t]) if t <= seq[b] else 1.0 for t in range(n)]
        rows.append((b, "run", 0, seq[b], mask_lp, mask_ref, [float(x) for x in v[b][:n]], mask_lp, v[b][:n], scores[b]))
    schema = ("rollout_id long, run_id string, batch_id long, seq_len int, logprob array<double>, ref_logprob array<double>, "
              "value array<double>, new_logprob array<double>, new_value array<double>, score double")
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("est", ["k1", "k3"])
def test_c12_whole_batch(spark, est):
    cfg = replace(PPO, gen_len=5, kl_estimator=est, kl_coef=0.1, gamma=1.0, lam=0.95)
    exp = {
        "k1": dict(kl=[-0.3, -0.1], r0=[-0.02, 0.05, 0, 1.5], r1=[-0.01, 0.01, 0.01, -0.01, -0.49],
                   a0=[1.255862, 1.23775, 1.145, 1.1], a1=[-0.851595, -0.780626, -0.726975, -0.6705, -0.59],
                   ret0=[1.355862, 1.43775, 1.445, 1.5], w0=[1.246312, 1.228304, 1.136085, 0],
                   w1=[-0.849064, -0.778502, -0.725159, -0.669007, -0.588969], okl=-0.2, nsr=0.02, rlhf=0.52),
        "k3": dict(kl=[0.167452, 0.025188], r0=[-0.001873, -0.014872, 0, 1.5],
                   r1=[-0.000484, -0.000517, -0.000517, -0.000484, -0.500517],
                   a0=[1.212361, 1.172878, 1.145, 1.1], a1=[-0.861969, -0.801563, -0.737943, -0.670975, -0.600517],
                   ret0=[1.312361, 1.372878, 1.445, 1.5], w0=[1.239550, 1.199767, 1.171677, 0],
                   w1=[-0.850542, -0.789677, -0.725574, -0.658097, -0.587103], okl=0.096320, nsr=-0.009632, rlhf=0.490368),
    }[est]
    out = {r.rollout_id: r for r in ppo_advantages(_c12_batch(spark), cfg).collect()}
    assert [sum(out[0].kl), sum(out[1].kl)] == approx(exp["kl"])
    assert out[0].rewards == approx(exp["r0"]) and out[1].rewards == approx(exp["r1"])
    assert out[0].adv_raw == approx(exp["a0"]) and out[1].adv_raw == approx(exp["a1"])
    assert out[0].returns == approx(exp["ret0"])
    assert out[0].advantages == approx(exp["w0"]) and out[1].advantages == approx(exp["w1"])
    okl = (sum(out[0].kl) + sum(out[1].kl)) / 2
    nsr = (sum(out[0].non_score_reward) + sum(out[1].non_score_reward)) / 2
    assert okl == pytest.approx(exp["okl"], abs=1e-6)
    assert nsr == pytest.approx(exp["nsr"], abs=1e-6)
    assert nsr + (1.5 - 0.5) / 2 == pytest.approx(exp["rlhf"], abs=1e-6)
    # entropy: reference form counts -1 per pad slot; valid form does not
    ent_valid = [sum(-x for x in out[b].logprob[: out[b].seq_len + 1]) for b in (0, 1)]
    ent_ref = [ent_valid[b] - (5 - out[b].seq_len - 1) for b in (0, 1)]
    assert sum(ent_ref) / 2 == pytest.approx(2.35) and sum(ent_valid) / 2 == pytest.approx(3.35)


def test_c12_reward_whitening_option(spark):
    cfg = replace(PPO, gen_len=5, whiten_rewards=True)
    out = {r.rollout_id: r for r in ppo_rewards(_c12_batch(spark), cfg).collect()}
    vals = out[0].rewards + out[1].rewards
    # shift_mean=False keeps the mean of the masked rewards
    raw = {r.rollout_id: r for r in ppo_rewards(_c12_batch(spark), replace(cfg, whiten_rewards=False)).collect()}
    raw_vals = raw[0].rewards + raw[1].rewards
    assert sum(vals) / len(vals) == pytest.approx(sum(raw_vals) / len(raw_vals), abs=1e-9)


def test_masked_var_edges(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, False)], "v double, m boolean")
    assert df.agg(G.masked_var("v", "m").alias("x")).first().x is None  # n = 1
    df0 = spark.createDataFrame([(1.0, False)], "v double, m boolean")
    with pytest.raises(Exception):
        df0.agg(G.masked_var("v", "m")).collect()


def test_a05_a09_helpers(spark):
    df = spark.createDataFrame([([0, 0, 5, 6, 0, 7],)], "x array<int>")
    r = df.select(
        S.masked_input_ids("x", 0, 99).alias("m"), S.position_ids("x", 0).alias("p"),
        S.reward_index(F.array(F.lit(4), F.lit(5), F.lit(0), F.lit(0)), 0, 3).alias("k"),
    ).first()
    assert r.m == [99, 99, 5, 6, 99, 7]
    assert r.p == [0, 0, 0, 1, 2, 2]  # cumsum(mask) - mask
    assert r.k == 4  # first pad at 2 -> last token 1 -> +3 context
