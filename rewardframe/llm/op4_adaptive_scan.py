"""Approximate nearest neighbours by an adaptive dimension scan (ADSampling, Gao and
Long 2023) over inverted lists; nearness is the largest inner product.

1. Inner product becomes distance: one more component makes all vectors equally long
   (queries get 0 there), so the nearest vector has the largest product.
2. Centroids are learnt by k-means on a bounded sample (``sample_rows`` rows of smallest
   hash); every row is put in its centroid's list, lists cut into blocks of about
   ``block_rows``.  How many lists a query probes is the least number that reaches
   ``aim`` recall for queries from the sample.
3. A query's 20th best among the sample's rows in its lists bounds its result at once.
   Block scan: vectors are turned by one random rotation and read in blocks of 16
   columns.  After each block the partial distance is tested against the query's 20th
   best so far; a candidate whose distance exceeds it at 3 standard errors is abandoned.
4. Survivors are scored exactly on the original vectors in double precision; the best 20
   of each block meet in one window per query.

Defined cases: null and zero vectors and those with a null or non-finite component take
no part; vectors are compared with those of their length, each length in a run of its
own; a query never finds rows of its own id; of repeated query ids one counts; repeated rows can be found each; ties go to the
smaller id; with fewer candidates all are returned; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common as C
from .op1_itq_neardup import lengths, matrix, usable

SAMPLE_ROWS = 16_384
LIST_ROWS = 2_048
MOST_LISTS = 4_096
BLOCK_ROWS = 4_096
COLUMNS = 16
ERRORS = 3.0
AIM = 0.98


def augment(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(1, keepdims=True), 0))])


def fit_lists(x: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """k-means centroids of the sample, from a seeded choice of rows."""
    rng = np.random.default_rng(3)
    c = x[np.sort(rng.choice(len(x), min(lists, len(x)), replace=False))].copy()
    for _ in range(rounds):
        own = nearest(x, c)[:, 0]
        n = np.bincount(own, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, own, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray, full: bool = False) -> np.ndarray:
    d = (c * c).sum(1) - 2 * (x @ c.T)
    return np.argsort(d, axis=1, kind="stable") if full else d.argmin(1)[:, None]


def probes_for(x: np.ndarray, c: np.ndarray, k: int, aim: float) -> int:
    """Lists to probe for ``aim`` recall, by queries and neighbours from the sample."""
    q = x[:: max(1, len(x) // 256)][:256].copy()
    own = np.arange(0, len(x), max(1, len(x) // 256))[:256]
    q[:, -1] = 0
    d = (x * x).sum(1) - 2 * (q @ x.T)
    d[np.arange(len(q)), own] = np.inf
    k = min(k, max(1, len(x) - 1))
    best = np.argpartition(d, k - 1, axis=1)[:, :k]
    rank = np.argsort(nearest(q, c, True), axis=1)
    at = np.take_along_axis(rank, nearest(x, c)[:, 0][best], axis=1)
    hit = np.cumsum(np.bincount(at.ravel(), minlength=len(c))) / at.size
    return int(np.searchsorted(hit, aim)) + 1


def _assign_fn(c: np.ndarray, dim: int, top: float):
    def fn(batches):
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                p = b.slice(s, 4096)
                own = nearest(augment(matrix(p.column("vec"), dim), top), c)[:, 0].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(own), p.column("id"), p.column("vec")], names=["list", "id", "vec"])
    return fn


def known_best(q: np.ndarray, ids: np.ndarray, probed: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray, k: int) -> np.ndarray:
    """Each query's ``k``-th largest product with sample rows of other ids in lists it
    probes (less a rounding allowance); minus infinity if there are fewer."""
    if len(sample) <= k:
        return np.full(len(q), -np.inf)
    s = q @ sample.T
    s[(ids[:, None] == sample_ids) | ~probed] = -np.inf
    best = np.partition(s, len(sample) - k, axis=1)[:, len(sample) - k]
    return best - 1e-9 * (1 + np.abs(best))


def _probe_fn(c: np.ndarray, dim: int, probes: int, sizes: np.ndarray, blocks: np.ndarray, k: int, augmented: np.ndarray, sample_ids: np.ndarray):
    """A query row for each block of each list to probe; more lists if they hold few rows."""
    sample_lists = nearest(augmented, c)[:, 0]

    def fn(batches):
        for b in batches:
            for s in range(0, b.num_rows, 1024):
                p = b.slice(s, 1024)
                q = matrix(p.column("vec"), dim)
                near = nearest(np.hstack([q, np.zeros((len(q), 1))]), c, True)
                enough = (np.cumsum(sizes[near], axis=1) - sizes[near]) < 2 * k + 2
                use = (np.arange(len(c)) < probes) | enough
                probed = np.empty_like(use)
                np.put_along_axis(probed, near, use, axis=1)
                row, at = np.nonzero(use)
                lists = near[row, at]
                n = blocks[lists]
                block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                floor = np.concatenate([
                    known_best(q[z: z + 128], np.asarray(p.column("id"))[z: z + 128], probed[z: z + 128][:, sample_lists], augmented[:, :-1], sample_ids, k)
                    for z in range(0, len(q), 128)])
                for z in range(0, len(row), 20_000):
                    take = pa.array(row[z: z + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(lists, n)[z: z + 20_000].astype(np.int32)), pa.array(block[z: z + 20_000].astype(np.int32)),
                         pa.array(np.ones(len(take), np.int32)), p.column("id").take(take), p.column("vec").take(take),
                         pa.array(floor[row[z: z + 20_000]])], names=["list", "block", "query", "id", "vec", "floor"])
    return fn


def scan(q, xq, rot, x, ids, own, k, top, steps, floor=-np.inf, errors=ERRORS, chunk=1024):
    """Best ``k`` of one block for one query, none under ``floor``: (ids, scores)."""
    dim, base = rot.shape[1], float((xq * xq).sum()) + top
    best, score, limit = np.empty(0, np.int64), np.empty(0), max(base - 2 * floor, 0.0)
    for lo in range(0, len(x), chunk):
        live = np.arange(lo, min(lo + chunk, len(x)))
        part = np.zeros(len(live))
        for s, e in steps:
            diff = rot[live, s:e] - q[s:e]
            part += np.einsum("ij,ij->i", diff, diff)
            if limit < np.inf:
                slack = (1 + errors / np.sqrt(e)) ** 2 * e / dim if e < dim else 1.0
                ok = part <= limit * slack + 1e-9 * base
                live, part = live[ok], part[ok]
                if not len(live):
                    break
        live = live[ids[live] != own]
        if not len(live):
            continue
        own_score = (x[live] * xq).sum(1)
        live, own_score = live[own_score >= floor], own_score[own_score >= floor]
        best = np.concatenate([best, live])
        score = np.concatenate([score, own_score])
        o = np.lexsort((ids[best], -score))[:k]
        best, score = best[o], score[o]
        if len(best) == k:
            limit = min(limit, max(base - 2 * score[-1], 0.0))
    return ids[best], score


def _scan_fn(dim: int, top: float, rotation: np.ndarray, k: int):
    steps = [(s, min(s + COLUMNS, dim + 1)) for s in range(0, dim + 1, COLUMNS)]

    def fn(batches):
        at, xs, ids, block = None, [], [], None
        for b in batches:
            where = np.asarray(b.column("list")).astype(np.int64) << 32 | np.asarray(b.column("block"))
            kind = np.asarray(b.column("query"))
            cut = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (kind[1:] != kind[:-1]), [True]]))
            for lo, hi in zip(cut, cut[1:]):
                if where[lo] != at:
                    at, xs, ids, block = where[lo], [], [], None
                x = matrix(b.column("vec").slice(lo, hi - lo), dim)
                i = np.asarray(b.column("id").slice(lo, hi - lo).fill_null(-(1 << 63)))
                if kind[lo] == 0:  # the block's vectors come before its queries
                    xs.append(x)
                    ids.append(i)
                    continue
                if not xs:
                    continue
                if block is None:
                    x0 = np.concatenate(xs)
                    block = (augment(x0, top) @ rotation, x0, np.concatenate(ids))
                rot, x0, i0 = block
                floor = np.asarray(b.column("floor").slice(lo, hi - lo))
                turned = np.hstack([x, np.zeros((len(x), 1))]) @ rotation
                for s in range(0, len(x), 512):
                    found = [scan(turned[r], x[r], rot, x0, i0, i[r], k, top, steps, floor[r]) for r in range(s, min(s + 512, len(x)))]
                    n = [len(f[0]) for f in found]
                    if sum(n):
                        vec_id = np.concatenate([f[0] for f in found])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.repeat(i[s: s + 512], n)), pa.array(vec_id, mask=vec_id == -(1 << 63)), pa.array(np.concatenate([f[1] for f in found]))],
                            names=["query_id", "vec_id", "score"])
    return fn


def adaptive_scan(vectors: DataFrame, is_query: F.Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
                  sample_rows: int = SAMPLE_ROWS, list_rows: int = LIST_ROWS, block_rows: int = BLOCK_ROWS, aim: float = AIM) -> DataFrame:
    """query_id, rank, vec_id, score for the rows where ``is_query`` (over id, vec) holds."""
    spark = vectors.sparkSession
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    dims = lengths(src, "vec")
    # an id asks with one vector, whatever the lengths of its rows
    asked = src.where(usable(F.col("vec")) & is_query).groupBy("id").agg(F.min("vec").alias("vec")) if len(dims) > 1 else None
    found = [_scan_length(src, d, asked, is_query, k, sample_rows, list_rows, block_rows, aim) for d in dims]
    return reduce(DataFrame.unionByName, found, C.empty_like(spark, "query_id long, rank int, vec_id long, score double"))


def _scan_length(src: DataFrame, dim: int, asked: DataFrame | None, is_query: F.Column, k: int, sample_rows: int, list_rows: int,
                 block_rows: int, aim: float) -> DataFrame:
    """The scan among the vectors of one length."""
    spark = src.sparkSession
    fine = src.where(usable(F.col("vec")) & (F.size("vec") == dim))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, top = fine.agg(F.count(F.lit(1)), F.max(norm)).first()
    few = fine.orderBy(F.xxhash64("vec"), "id").limit(sample_rows).select("id", "vec").collect()
    named = np.array([-(1 << 63) if r.id is None else r.id for r in few], np.int64)
    sample = augment(np.array([r.vec for r in few], float), top)
    c = fit_lists(sample, int(min(MOST_LISTS, max(1, round(n / list_rows)))))
    probes = probes_for(sample, c, k, aim)
    rotation, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((dim + 1, dim + 1)))
    kind = src.schema["vec"].dataType.simpleString()
    own = C.stored(fine.mapInArrow(_assign_fn(c, dim, top), f"list int, id long, vec {kind}"), "op4-lists")
    sizes = np.zeros(len(c), np.int64)
    for r in own.groupBy("list").count().collect():  # at most MOST_LISTS rows
        sizes[r["list"]] = r["count"]
    blocks = -(-sizes // block_rows)
    many = spark.createDataFrame([(i, int(max(1, x))) for i, x in enumerate(blocks)], "list int, _nb int")
    own_b = own.join(F.broadcast(many), "list")  # at most MOST_LISTS rows
    rows = own_b.select("list", F.pmod(F.xxhash64("id", "vec"), F.col("_nb")).cast("int").alias("block"), F.lit(0).alias("query"), "id", "vec",
                        F.lit(0.0).alias("floor"))
    asked = own.where(is_query).select("id", "vec").groupBy("id").agg(F.min("vec").alias("vec")) if asked is None else asked.where(F.size("vec") == dim)
    asked = asked.mapInArrow(_probe_fn(c, dim, probes, sizes, blocks, k, sample, named), f"list int, block int, query int, id long, vec {kind}, floor double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = rows.unionByName(asked).repartition(parts, "list", "block").sortWithinPartitions("list", "block", "query")
    found = both.mapInArrow(_scan_fn(dim, top, rotation, k), "query_id long, vec_id long, score double")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the 20 nearest rows of every vector whose id is divisible by 20."""
    return adaptive_scan(C.read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
