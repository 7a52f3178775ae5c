"""Verifiable rewards as DataFrame operators: ROUGE-n/L (R08) and the F01
reward-function registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rewards as R
from ..functions.sequences import compute_once, ngram_keys
from ..functions.text import rouge_tokens

RewardFn = Callable[[Column, Column], Column]

_REGISTRY: dict[str, RewardFn] = {
    "tldr": lambda c, g: R.verifiable_reward(c, g),
    "overlap_only": lambda c, g: F.when(g.isNotNull() & (g != ""), R.word_overlap(c, g)),
    "length_only": lambda c, g: R.verifiable_reward(c, None),
}


def register_reward(name: str, fn: RewardFn) -> None:
    """add ``fn(completion, label) -> Column``.  A ``pandas_udf`` taking
    two Series is accepted too (Arrow batches, same signature)."""
    _REGISTRY[name] = fn


def reward_fn(name: str) -> RewardFn:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"no reward function {name!r}; known: {sorted(_REGISTRY)}") from None


def record_text(df: DataFrame, col: str) -> Column:
    """the text of a completion or label column, which holds plain text, a message record
    (a struct with ``content``, empty text if that is NULL) or a list of such records, of which
    the first counts (NULL without any)."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        first = F.get(F.col(col), 0)
        return F.when(first.isNotNull(), F.coalesce(first["content"], F.lit("")))
    if isinstance(kind, T.StructType):
        return F.when(F.col(col).isNotNull(), F.coalesce(F.col(col)["content"], F.lit("")))
    return F.col(col)


def with_reward(df: DataFrame, name: str, completion: str, label: str, out: str = "reward") -> DataFrame:
    """the named reward of each completion; text or message records on both sides."""
    return df.withColumn(out, reward_fn(name)(record_text(df, completion), record_text(df, label)))


def rouge_n(df: DataFrame, key: str, pred: str, target: str, n: int) -> DataFrame:
    """ROUGE-n precision/recall/F1 per row (target = label, prediction = completion).

    Both sides' n-grams are exploded together with a side flag and counted
    per ``(key, gram)`` (partial aggregation), then clipped counts
    ``sum(min(c_pred, c_target))`` are summed per key.  A NULL sentinel gram
    keeps rows without any n-gram."""
    side = lambda arr, p, t: F.transform(arr, lambda k: F.struct(k.alias("k"), F.lit(p).alias("p"), F.lit(t).alias("t")))
    toks = df.select(key, rouge_tokens(pred).alias("_tp"), rouge_tokens(target).alias("_tt"))
    grams = F.concat(
        side(ngram_keys("_tp", n), 1, 0),
        side(ngram_keys("_tt", n), 0, 1),
        F.array(F.struct(F.lit(None).cast("string").alias("k"), F.lit(0).alias("p"), F.lit(0).alias("t"))),
    )
    per_gram = (
        toks.select(key, F.explode_outer(grams).alias("g"))
        .groupBy(key, F.col("g.k").alias("k"))
        .agg(F.sum("g.p").alias("cp"), F.sum("g.t").alias("ct"))
    )
    s = per_gram.groupBy(key).agg(
        F.sum(F.least("cp", "ct")).cast("double").alias("hit"),
        F.sum("cp").cast("double").alias("np"),
        F.sum("ct").cast("double").alias("nt"),
    )
    p = F.col("hit") / F.greatest(F.col("np"), F.lit(1.0))
    r = F.col("hit") / F.greatest(F.col("nt"), F.lit(1.0))
    out = s.select(key, p.alias("precision"), r.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return out.withColumn("f1", f1)


def with_lcs_length(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``out``: length of the longest common subsequence of two token arrays (Hunt and Szymanski
    1977): walking the first array, each token contributes the positions where the second one
    has it, in falling order, and the longest strictly rising subsequence of these is the
    answer.  Its state is the least end of a rising subsequence of each length, so an array no
    longer than the second: pass the shorter one second.  The table of positions is computed
    once a row, as the lambda reads it for every token."""
    words = F.array_distinct(b)
    places = F.transform(words, lambda w: F.reverse(F.filter(F.transform(b, lambda v, i: F.when(v == w, i)), lambda i: i.isNotNull())))
    held = compute_once(df, _at=F.map_from_arrays(words, places))
    none = F.array().cast("array<int>")
    matches = F.flatten(F.transform(a, lambda w: F.coalesce(F.try_element_at("_at", w), none)))

    def extend(ends, j):
        below = F.size(F.filter(ends, lambda x: x < j))
        return F.concat(F.slice(ends, 1, below), F.array(j), F.slice(ends, below + 2, F.size(ends)))

    return compute_once(held, **{out: F.size(F.aggregate(matches, none, extend))}).drop("_at")


def rouge_l(df: DataFrame, key: str, pred: str, target: str) -> DataFrame:
    """ROUGE-L precision/recall/F1 from the longest common subsequence, inside the row."""
    toks = compute_once(df.select(key, pred, target), _tp=rouge_tokens(pred), _tt=rouge_tokens(target))
    first = F.size("_tp") >= F.size("_tt")  # the subsequence is the same either way round
    sides = compute_once(toks.select(key, "_tp", "_tt"), _a=F.when(first, F.col("_tp")).otherwise(F.col("_tt")),
                         _b=F.when(first, F.col("_tt")).otherwise(F.col("_tp")))
    s = with_lcs_length(sides, "_a", "_b", "_n").withColumn("_lcs", F.col("_n").cast("double"))
    p = F.col("_lcs") / F.greatest(F.size("_tp"), F.lit(1))
    r = F.col("_lcs") / F.greatest(F.size("_tt"), F.lit(1))
    out = s.select(key, p.alias("precision"), r.alias("recall"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    return out.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, f1).otherwise(F.lit(0.0)))
