"""Heavy hitters (T02, Q02): exact top-k by counts of hash buckets, or by a frequent-items sketch,
and a count of the candidates.

A mergeable sketch follows at most ``items`` values per task, so the first pass shuffles sketches,
not values; the second counts the few candidates exactly.  The sketch's error bound proves that
no value outside the candidates reaches the k-th count; where it cannot, the buckets decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

ITEMS = 1 << 18
#: A frequent-items sketch of ``m`` counters errs by at most 3.5 / m of all rows.
ERROR = 3.5
BUCKETS = 1 << 18
HASH = "_hash"


def candidates(values: DataFrame, col: str, items: int, listed: int) -> tuple[DataFrame, float]:
    """(stored table of at most ``listed`` values of the highest estimates, bound): no other
    value occurs more than ``bound`` times.  An unlisted value either has a lower estimate (and
    estimates are upper bounds), or is below the sketch's threshold of one error, hence its
    count below two."""
    sketch = values.where(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(`{col}`, {items})").alias("s"))
    sketch = stored(sketch, "top-sketch")
    found = stored(sketch.select(F.inline(F.expr(f"approx_top_k_estimate(s, {listed})"))).select(F.col("item").alias(col), "count"), "top-candidates")
    n, least, rows = sketch.select("n").first()[0], *found.agg(F.min("count"), F.count(F.lit(1))).first()
    return found.select(col), max(2 * ERROR * n / items, least if rows >= listed else 0)


def hashed(values: DataFrame, col: str, value: Column | None) -> tuple[DataFrame, Column]:
    """(``values`` with a 64-bit hash of each value, the value).  The value is the non-null column
    ``col``, or ``value``, an expression that no two different rows of ``values`` share: those are
    hashed by their columns, and only rows that are counted have it built."""
    if value is None:
        values, value = values.select(col).where(F.col(col).isNotNull()), F.col(col)
    return values.withColumn(HASH, F.xxhash64(*values.columns)), value.alias(col)


def counted(rows: DataFrame, value: Column, col: str, k: int) -> DataFrame:
    return rows.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col).limit(k)


def top_k_exact(values: DataFrame, col: str, k: int, value: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent values with their counts ``n``, most frequent first, ties by value.
    Values are counted by hash bucket first, which shuffles at most ``buckets`` rows a task; no value is
    more frequent than its bucket.  Values of the fullest buckets are counted each, and then, if
    other buckets reach the k-th count, those of all that do.  ``values`` is evaluated two or three times."""
    rows, value = hashed(values, col, value)
    rows = rows.withColumn(HASH, F.pmod(HASH, F.lit(buckets)))
    load = stored(rows.groupBy(HASH).agg(F.count(F.lit(1)).alias("n")), "bucket-loads")
    full = stored(load.orderBy(F.desc("n"), HASH).limit(min(buckets, 50 * k)), "full-buckets")

    def within(some):  # at most ``buckets`` longs
        return counted(rows.join(F.broadcast(some.select(HASH)), HASH, "left_semi"), value, col, k)

    top = stored(within(full), "top-exact")
    found, least = top.agg(F.count(F.lit(1)), F.min("n")).first()
    reach = load.where(F.col("n") >= (least if found == k else 0))
    if reach.join(full, HASH, "left_anti").isEmpty():
        return top.orderBy(F.desc("n"), col)
    return within(reach)


def top_k(
    values: DataFrame, col: str, k: int, items: int = ITEMS, listed: int | None = None, value: Column | None = None
) -> DataFrame:
    """As :func:`top_k_exact`, by the sketch.  It follows the values' hashes: a value is no more
    frequent than its hash, so the bound holds for values, and the values of the listed hashes are
    counted exactly.  ``values`` is evaluated twice."""
    if k > items:  # more than the sketch could ever prove
        return top_k_exact(values, col, k, value)
    rows, built = hashed(values, col, value)
    found, bound = candidates(rows, HASH, items, min(items, listed or 50 * k))
    top = stored(counted(rows.join(F.broadcast(found), HASH, "left_semi"), built, col, k), "top-exact")
    worst = top.agg(F.count(F.lit(1)), F.min("n")).first()
    if worst[0] == k and worst[1] > bound:
        return top.orderBy(F.desc("n"), col)
    return top_k_exact(values, col, k, value)
