"""Reward and shaping expressions (R01-R11, R13, R18) as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import ngram_keys, repeated_distinct
from .text import col_, has_content, n_chars, truthy, word_set


def length_penalty(seq_len: Column | str, coef: float = 0.01) -> Column:
    """``coef * seq_len``; seq_len is an index, so an empty response
    (-1) earns a bonus of ``coef``."""
    if coef == 0.0:
        return F.lit(0.0)
    return F.lit(float(coef)) * col_(seq_len).cast("double")


def repetition_ratio(seq: Column, n: int = 3) -> Column:
    """Distinct n-grams occurring more than once over the number of n-grams."""
    keys = ngram_keys(seq, n)
    m = F.size(keys)
    return F.when(m > 0, repeated_distinct(keys) / m).otherwise(F.lit(0.0))


def repetition_penalty(post: Column | str, seq_len: Column | str, n: int = 3, coef: float = 0.1) -> Column:
    """``coef * ratio`` over ``post[:seq_len]`` (last kept token excluded);
    0 when ``seq_len < n``."""
    if coef == 0.0:
        return F.lit(0.0)
    sl = col_(seq_len)
    seq = F.slice(col_(post), 1, F.greatest(sl, F.lit(0)))
    return F.when(sl < n, F.lit(0.0)).otherwise(F.lit(float(coef)) * repetition_ratio(seq, n))


def with_repetition_penalty(
    df, post: str = "post", seq_len: str = "seq_len", n: int = 3, coef: float = 0.1, out: str = "repetition_penalty"
):
    """R02 as a DataFrame step: the sorted n-grams are computed once per row."""
    return with_repetition_penalties(df, {out: n}, post, seq_len, coef)


def with_repetition_penalties(df, outs: dict[str, int], post: str = "post", seq_len: str = "seq_len", coef: float = 0.1):
    """R02 for several n at once, a column for each ``outs`` entry (name: n).  N-grams stay
    tuples of words: sorting them and comparing neighbours needs no strings built."""
    from .sequences import compute_once, ngram_rows, repeated_in_sorted

    if coef == 0.0:
        return df.withColumns({out: F.lit(0.0) for out in outs})
    sl = F.col(seq_len)
    held = compute_once(df, _seq=F.slice(F.col(post), 1, F.greatest(sl, F.lit(0))))
    held = compute_once(held, **{f"_s_{out}": F.sort_array(ngram_rows("_seq", n)) for out, n in outs.items()})
    pen = {
        out: F.when((sl < n) | (F.size(f"_s_{out}") == 0), F.lit(0.0)).otherwise(
            F.lit(float(coef)) * repeated_in_sorted(f"_s_{out}") / F.size(f"_s_{out}")
        )
        for out, n in outs.items()
    }
    return held.withColumns(pen).drop("_seq", *[f"_s_{out}" for out in outs])


def repetition_penalty_exploded(
    df, key: str = "rollout_id", post: str = "post", seq_len: str = "seq_len", n: int = 3, coef: float = 0.1,
    out: str = "repetition_penalty",
):
    """R02, exploded form: n-grams become rows, counted per ``(key, gram)``
    with partial aggregation, then per key.  One very long response is
    spread over many tasks instead of one in-row sort; results equal
    :func:`with_repetition_penalty`."""
    from .sequences import explode_rows

    sl = F.col(seq_len)
    grams = df.select(
        key, explode_rows(ngram_keys(F.slice(F.col(post), 1, F.greatest(sl, F.lit(0))), n)).alias("_g")
    ).where(F.col("_g").isNotNull())
    per = grams.groupBy(key, "_g").agg(F.count(F.lit(1)).alias("_c")).groupBy(key).agg(
        F.count(F.when(F.col("_c") > 1, 1)).alias("_rep"), F.sum("_c").alias("_m")
    )
    pen = F.when((sl < n) | F.col("_m").isNull(), F.lit(0.0)).otherwise(F.lit(float(coef)) * F.col("_rep") / F.col("_m"))
    return df.join(per, key, "left").withColumn(out, pen).drop("_rep", "_m")


def missing_eos_penalty(has_eos: Column | str, penalty: float | None = 1.0) -> Column:
    """``penalty`` when the truncated response holds no EOS; off when None."""
    if penalty is None:
        return F.lit(0.0)
    return F.when(col_(has_eos), F.lit(0.0)).otherwise(F.lit(float(penalty)))


def word_overlap(completion: Column | str, truth: Column | str) -> Column:
    """|C ∩ G| / |G| over distinct lowercase whitespace words; NULL when G is empty."""
    c, g = word_set(completion), word_set(truth)
    return F.try_divide(F.size(F.array_intersect(c, g)).cast("double"), F.size(g).cast("double"))


def verifiable_reward(completion: Column | str, label: Column | str | None) -> Column:
    """Rule-based reward on characters with and without ground truth."""
    text = col_(completion)
    n = n_chars(text).cast("double")
    base = F.when(has_content(text), F.lit(0.1)).otherwise(F.lit(-0.5))
    too_long = -0.1 * (n - 200.0) / 100.0
    with_gt = (
        base
        + F.when((n >= 50) & (n <= 200), F.lit(0.2))
        .when(n > 200, too_long)
        .otherwise(-0.1 * (50.0 - n) / 50.0)
        + F.when(truthy(label), F.coalesce(F.lit(0.7) * word_overlap(text, label), F.lit(0.0))).otherwise(F.lit(0.0))
    ) if label is not None else None
    without_gt = base + F.when((n >= 50) & (n <= 200), F.lit(0.3)).when(n > 200, too_long).otherwise(F.lit(0.0))
    if label is None:
        return without_gt
    return F.when(truthy(label), with_gt).otherwise(without_gt)


def kl_per_token(logprob: Column | str, ref_logprob: Column | str, estimator: str = "k1") -> Column:
    """k1 = -logr, k3 = exp(logr) - 1 - logr with logr = ref - lp."""
    logr = col_(ref_logprob) - col_(logprob)
    if estimator == "k1":
        return -logr
    if estimator == "k3":
        return F.expm1(logr) - logr
    raise ValueError(f"unknown kl estimator {estimator!r}")


def log_sigmoid_loss(d: Column) -> Column:
    """``-log sigmoid(d)`` in the stable form ``max(-d,0) + log1p(exp(-|d|))``."""
    return F.greatest(-d, F.lit(0.0)) + F.log1p(F.exp(-F.abs(d)))


def dpo_loss(pc: Column, pr: Column, rc: Column, rr: Column, beta: float = 0.1) -> Column:
    """``-log sigmoid(beta * ((pc - rc) - (pr - rr)))`` on summed logprobs
    of chosen (c) and rejected (r) under policy (p) and reference (r)."""
    return log_sigmoid_loss(F.lit(float(beta)) * ((pc - rc) - (pr - rr)))
