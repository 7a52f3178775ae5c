"""Row numbers over large groups without a one-task window.

``row_number() over (partition by g order by k)`` sends every row of a group
to one task.  When a group can hold a large share of the table (a batch, a
language, a whole epoch) the rank is built in two levels instead: rows are
numbered inside ``(g, bucket)`` where ``bucket`` is a monotone coarsening of
``k``, and each bucket is shifted by the row counts of the earlier buckets
(a small table of ``#groups x #buckets`` rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_BUCKET_CHARS = 3  # 4096 buckets on a uniform md5 key


def md5_key(*parts: Column | str) -> Column:
    """Reproducible shuffle key ``md5(p1|p2|...)`` (same value in DuckDB)."""
    cols = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def hex_bucket(key: Column | str, chars: int = HEX_BUCKET_CHARS) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(k, 1, chars), 16, 10).cast("int")


def range_bucket(key: Column | str, width: int) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.floor(k / F.lit(width)).cast("long")


def span_bucket(df: DataFrame, key: str, n: int = 4096) -> Column:
    """Monotone bucket of a numeric key: the number of the key's ``n - 1``
    quantiles below it, found by binary search.  Buckets hold nearly equal row
    counts whatever the keys' distribution; NULL is in bucket 0.  The quantiles
    come from a mergeable sketch, at most ``n - 1`` numbers."""

    def numbers(xs, kind: str) -> Column:  # one folded literal, not a Column for each number
        return F.split(F.lit(",".join(map(str, xs))), ",").cast(f"array<{kind}>")

    at = numbers([i / n for i in range(1, n)], "double")
    found = sorted(set(df.agg(F.percentile_approx(key, at, 10 * n).alias("b")).first().b or []))
    bounds = numbers(found, df.schema[key].dataType.simpleString())
    k = F.col(key)

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        open_, above = s["lo"] < s["hi"], F.coalesce(F.get(bounds, mid) < k, F.lit(False))
        return F.struct(
            F.when(open_ & above, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(open_ & ~above, mid).otherwise(s["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(found)).alias("hi"))
    steps = F.array(*[F.lit(i) for i in range(n.bit_length())])
    return F.aggregate(steps, start, halve, lambda s: s["lo"]).cast("long")


def bucketed_row_number(
    df: DataFrame,
    partition_cols: list[str],
    order_cols: list[str],
    bucket: Column,
    out: str = "rank",
) -> DataFrame:
    """0-based ``row_number`` within ``partition_cols`` ordered by ``order_cols``;
    ``bucket`` must be non-decreasing in the order key."""
    b = df.withColumns({"_key": group_key(partition_cols), "_bkt": bucket})
    counts = b.groupBy("_key", "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = Window.partitionBy("_key", "_bkt").orderBy(*order_cols)
    ranked = b.withColumn("_local", F.row_number().over(local) - 1)
    return ranked.join(offsets, ["_key", "_bkt"]).withColumn(
        out, (F.col("_off") + F.col("_local")).cast("long")
    ).drop("_key", "_bkt", "_off", "_local")


def group_key(cols: list[str]) -> Column:
    """The group as one value that is equal to itself also where columns are NULL, so that a
    plain join on it keeps NULL groups and the partitioning of the windows."""
    return F.struct(*[F.col(f"`{c}`") for c in cols]) if cols else F.struct(F.lit(0))


def bucketed_running_sum(
    df: DataFrame,
    partition_cols: list[str],
    order_cols: list[str],
    value: str,
    bucket: Column,
    out: str,
) -> DataFrame:
    """Inclusive running ``sum(value)`` in key order (W04) without a one-task
    window: per-bucket totals (small table) give each bucket's offset, a
    window inside ``(partition, bucket)`` gives the local part."""
    b = df.withColumns({"_key": group_key(partition_cols), "_bkt": bucket})
    sums = b.groupBy("_key", "_bkt").agg(F.sum(value).alias("_s"))
    before = Window.partitionBy("_key").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    local = Window.partitionBy("_key", "_bkt").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    return (
        b.withColumn("_loc", F.sum(value).over(local))
        .join(offsets, ["_key", "_bkt"])
        .withColumn(out, F.col("_off") + F.col("_loc"))
        .drop("_key", "_bkt", "_off", "_loc")
    )


def global_row_number(df: DataFrame, order_cols: list[str], bucket: Column, out: str = "rank") -> DataFrame:
    """0-based rank over the whole table (two-level, see module docstring)."""
    return bucketed_row_number(df.withColumn("_all", F.lit(0)), ["_all"], order_cols, bucket, out).drop("_all")


def bucketed_lag(df: DataFrame, partition_cols: list[str], order_cols: list[str], value: str, bucket: Column, out: str) -> DataFrame:
    """``value`` of the previous row of the group in key order (NULL for the first), without a
    one-task window: inside a bucket by a window, for a bucket's first row from the last row of
    the bucket before it (a small table)."""
    b = df.withColumns({"_key": group_key(partition_cols), "_bkt": bucket})
    last = b.groupBy("_key", "_bkt").agg(F.max_by(F.struct(value), F.struct(*order_cols)).alias("_v"))
    last = last.withColumn("_prev", F.lag("_v").over(Window.partitionBy("_key").orderBy("_bkt"))[value]).drop("_v")
    own = Window.partitionBy("_key", "_bkt").orderBy(*order_cols)
    rows = b.withColumns({"_no": F.row_number().over(own), "_lag": F.lag(value).over(own)})
    got = F.when(F.col("_no") == 1, F.col("_prev")).otherwise(F.col("_lag"))
    return rows.join(last, ["_key", "_bkt"]).withColumn(out, got).drop("_key", "_bkt", "_no", "_lag", "_prev")
