"""Change points of metric series (W07): the largest excursion of the centred running sum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import bucketed_running_sum, group_key, span_bucket

DIGITS = 9  # excursions are compared at this precision, so equal ones fall to the earlier step


def cusum_shift(series: DataFrame, keys: list[str], step: str, value: str, buckets: int = 1024) -> DataFrame:
    """CUSUM of each series: ``S_k = sum(x_i - mean, i <= k)``; the step of the largest ``|S_k|`` is
    the last one before the shift.  Per series: n_steps, shift_after, excursion (signed),
    mean_before, mean_after, shift; a series without an excursion (one step, or constant) has
    NULL in all but n_steps.  One row per step; NULL values are left out.  Running sums are
    built in two levels, so a series of any length spreads over tasks.  ``series`` is read
    several times: pass a stored table."""
    s = series.where(F.col(value).isNotNull()).withColumn("_one", F.lit(1))
    bucket = span_bucket(s, step, buckets)
    run = bucketed_running_sum(s, keys, [step], value, bucket, "_sum")
    run = bucketed_running_sum(run, keys, [step], "_one", bucket, "_k")
    total = s.groupBy(group_key(keys).alias("_key")).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("_n"))
    at = run.withColumn("_key", group_key(keys)).join(total, "_key").where(F.col("_k") < F.col("_n"))
    at = at.withColumn("_s", F.col("_sum") - F.col("_k") * F.col("_total") / F.col("_n"))
    size = F.round(F.abs("_s"), DIGITS)
    peak = at.where(size > 0).groupBy("_key").agg(F.max_by(F.struct(step, "_s", "_k", "_sum"), F.struct(size, (-F.col("_k")))).alias("p"))
    out = total.join(peak, "_key", "left")
    before = F.col("p._sum") / F.col("p._k")
    after = (F.col("_total") - F.col("p._sum")) / (F.col("_n") - F.col("p._k"))
    names = [F.col("_key")[c].alias(c) for c in keys]
    return out.select(*names, F.col("_n").alias("n_steps"), F.col("p")[step].alias("shift_after"), F.col("p._s").alias("excursion"),
                      before.alias("mean_before"), after.alias("mean_after"), (after - before).alias("shift"))
