"""Helpers shared by the training-data operators: shared-folder tables, skew-proof
ranks, connected components, and vectorised hashing of Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from rewardframe.session import ensure_checkpoint_dir

U64 = np.uint64
#: Text bytes taken at a time inside one task; bounds the numpy temporaries.
CHUNK_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, as the given file layout has it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: cuts lineage,
    survives a lost executor, and gives the planner true sizes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rank_within(df: DataFrame, keys: list[str], spread: F.Column, order: list[F.Column], rows: int = 20_000,
                weight: str | None = None, out: str = "rank") -> DataFrame:
    """Exclusive running count (or running sum of ``weight``) of each row inside its
    key group, where one key may hold most rows.  ``spread`` is a double in [0, 1)
    that leads the order: each group is cut into ranges of it of about ``rows`` rows,
    ranges are summed first, and only a range is ever sorted in one task.  ``df`` is
    read three times: pass a stored table."""
    w = F.lit(1) if weight is None else F.col(weight)
    size = stored(df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias("_nb")), "rank-keys")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    d = df.withColumn("_u", spread).alias("d").join(size.alias("s"), cond).select("d.*", "s._nb")
    d = d.withColumn("_b", F.floor(F.col("_u") * F.col("_nb")).cast("long"))
    sums = d.groupBy(*keys, "_b").agg(F.sum(w).alias("_s"))
    run = W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    before = stored(sums.select(*keys, "_b", F.coalesce(F.sum("_s").over(run), F.lit(0)).alias("_before")), "rank-sums")
    cond = F.col("d._b") == F.col("s._b")
    for k in keys:
        cond = cond & F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}"))
    d = d.alias("d").join(before.alias("s"), cond).select("d.*", "s._before")
    own = W.partitionBy(*keys, "_b").orderBy("_u", *order).rowsBetween(W.unboundedPreceding, -1)
    r = F.col("_before") + F.coalesce(F.sum(w).over(own), F.lit(0))
    return d.withColumn(out, r.cast("long")).drop("_u", "_nb", "_b", "_before")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star steps
    (Kiveris et al. 2014): (id, component) for every id in an edge, the component
    being its smallest id.  Each round is two joins, stored in the shared folder."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = stored(e, "cc")
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


# --- text buffers ---------------------------------------------------------------------

def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) + U64(seed)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (bijective)."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(29))) * U64(0xA0761D6478BD642F)
    return x ^ (x >> U64(32))


_BYTE = _splitmix(256, 0x5EED)
_BASE = 0x9E3779B97F4A7C55 | 1
_POW = {"pw": np.ones(1, U64), "ipw": np.ones(1, U64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["pw"]) < n:
        n = max(n, CHUNK_BYTES + 4096)
        inv = pow(_BASE, -1, 1 << 64)
        for k, base in (("pw", _BASE), ("ipw", inv)):
            out = np.full(n, base, U64)
            out[0] = 1
            _POW[k] = np.multiply.accumulate(out)
    return _POW["pw"], _POW["ipw"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of byte codes times base**position, modulo 2**64."""
    pw, _ = _powers(len(data) + 1)
    out = np.empty(len(data) + 1, U64)
    out[0] = 0
    np.cumsum(_BYTE[data] * pw[: len(data)], out=out[1:])
    return out


def span_hash(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of the bytes [start, end)."""
    _, ipw = _powers(len(p))
    return mix((p[end] - p[start]) * ipw[start] + (end - start).astype(U64))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    if col.null_count:
        col = col.fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and len(off) else np.empty(0, np.uint8)
    return data, off


def doc_chunks(off: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer document stands alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of bytes other than space and \\t..\\r;
    a run never crosses a row's end.  ``off`` starts at 0 for ``data``."""
    on = np.zeros(len(data) + 1, bool)
    on[:-1] = ~_SPACE[data]
    first = np.empty(len(data) + 1, bool)
    first[0] = on[0]
    first[1:] = on[1:] & ~on[:-1]
    edge = off[1:-1]
    edge = edge[edge < len(data)]
    first[edge] = on[edge]
    start = np.flatnonzero(first[:-1])
    last = np.empty(len(data), bool)
    last[:] = on[:-1] & ~on[1:]
    edge = off[1:-1] - 1
    edge = edge[edge >= 0]
    last[edge] |= on[edge]
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``k``-word shingles; a row of 1 to
    k-1 words has one shingle of all its words, a row without words none."""
    n = len(off) - 1
    off = off - off[0]
    start, end, row = word_spans(data, off)
    if not len(start):
        return [np.empty(0, U64)] * n
    word = span_hash(prefix_hash(data), start, end)
    first = np.searchsorted(row, np.arange(n + 1))
    mult = _splitmix(k, 77) | U64(1)
    full = np.zeros(max(0, len(word) - k + 1), U64)
    for j in range(k):
        full += word[j: j + len(full)] * mult[j]
    full = mix(full)
    out = []
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= k:
            out.append(np.unique(full[a: b - k + 1]))
        elif b > a:
            out.append(mix((word[a:b] * mult[: b - a]).sum(keepdims=True, dtype=U64) + U64(b - a)))
        else:
            out.append(np.empty(0, U64))
    return out


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Whole key groups of a partition sorted by ``keys``, several at a time: each
    table ends at a group's end and is cut once it has ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) < rows:
            continue
        t = pa.Table.from_batches(held)
        ids = [np.asarray(t.column(k).combine_chunks()) for k in keys]
        change = np.zeros(t.num_rows - 1, bool)
        for x in ids:
            change |= x[1:] != x[:-1]
        at = np.flatnonzero(change) + 1
        if len(at):
            yield t.slice(0, int(at[-1]))
            held = t.slice(int(at[-1])).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def starts_of(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Group boundaries (with 0 and the end) in a table sorted by ``keys``."""
    n = t.num_rows
    change = np.zeros(n + 1, bool)
    change[0] = change[n] = True
    for k in keys:
        x = np.asarray(t.column(k).combine_chunks())
        change[1:n] |= x[1:] != x[:-1]
    return np.flatnonzero(change)


def fixed_binary(col: pa.ChunkedArray | pa.Array, width: int, dtype: type) -> np.ndarray:
    """Rows of equal-length binaries as a matrix."""
    data, off = text_buffer(col)
    return np.frombuffer(data[off[0]: off[-1]].tobytes(), dtype).reshape(len(off) - 1, width)


def binary_rows(m: np.ndarray) -> pa.Array:
    """A matrix as rows of binaries."""
    raw, step = m.tobytes(), m.dtype.itemsize * m.shape[1]
    off = np.arange(len(m) + 1, dtype=np.int32) * step
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(raw)])


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` for functions over record batches."""
    return df.mapInArrow(fn, schema)


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))


# --- pairs inside buckets ---------------------------------------------------------------

def bucket_blocks(cand: DataFrame, key: str, ident: str, rows: int) -> DataFrame:
    """Keep keys with two or more members, and cut the larger buckets into blocks of
    about ``rows``: a member goes to every pair (bi, bj) its block is part of, so no
    task ever holds a whole large bucket.  Pairs of a block pair are those of
    different ``side``, or any if bi = bj."""
    count = cand.groupBy(key).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    out = cand.join(count, key).withColumn("_nb", F.ceil(F.col("_c") / F.lit(rows)).cast("int"))
    out = out.withColumn("_b", F.pmod(F.xxhash64(F.col(ident), F.lit(11)), F.col("_nb")).cast("int"))
    out = out.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return out.withColumn("bi", F.least("_b", "_j")).withColumn("bj", F.greatest("_b", "_j")) \
        .withColumn("side", (F.col("_b") > F.col("_j")).cast("int")).drop("_c", "_nb", "_b", "_j")


def by_bucket(df: DataFrame) -> DataFrame:
    """Deal blocks to tasks, sorted so that each block is consecutive."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, "key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")


def pair_chunks(starts: np.ndarray, most: int = 300_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All index pairs i < j inside the groups that ``starts`` bounds, a bounded
    number at a time."""
    n = int(starts[-1])
    end = np.repeat(starts[1:], np.diff(starts))
    cnt = end - 1 - np.arange(n)
    cum = np.concatenate([[0], np.cumsum(cnt)])
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + most, "right")) - 1)
        c = cnt[lo:hi]
        i = np.repeat(np.arange(lo, hi), c)
        j = i + 1 + np.arange(len(i)) - np.repeat(cum[lo:hi] - cum[lo], c)
        if len(i):
            yield i, j
        lo = hi


def low_labels(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable from each of ``n`` local rows over the links (i, j)."""
    lab = ids.copy()
    while len(i):
        old = lab.copy()
        m = np.minimum(lab[i], lab[j])
        np.minimum.at(lab, i, m)
        np.minimum.at(lab, j, m)
        if (lab == old).all():
            break
    return lab
