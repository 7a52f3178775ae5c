"""Embedding near-dedup by iterative quantisation (Gong and Lazebnik 2011).

1. Equal vectors form a class.  A rotation is learnt on a bounded sample (the
   ``sample_rows`` classes of smallest hash): principal directions, then alternating
   between sign codes and the orthogonal Procrustes rotation.  Its signs (up to 64) open
   the code; signs of fixed random rotations fill it up to ``WORDS`` words of 64 bits at
   every dimension.
2. Multi-index Hamming tables: the code is cut into 16-bit substrings, one table each; a
   code is filed under each substring and its 16 one-bit neighbours, so two codes meet if
   some substring differs in at most two bits.  In its bucket a pair is kept for reranking
   if the word of that substring differs in at most ``near_bits`` bits.  Each pair is
   handled in one table and key only: the first word that keeps it, there the first table.
3. Members with such a pair bring their original vectors to the bucket; cosine is
   computed there in double precision.  Buckets emit counts and the smallest class that
   a member reaches, never pairs; large buckets are cut into block pairs.
4. Connected components over those edges.

A word misses a pair at cosine 0.95 with probability about 0.002 (sign bits of random
rotations differ with probability angle / pi), three words with about 1e-8; closer pairs
far less.  The README has the measured recall by dimension.
Defined cases: a null or zero vector and one with a null or non-finite component link
with nothing; vectors are compared with those of their length, each length in a run of
its own; repeated rows are rows of their own; null ids never name a component; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

THRESHOLD = 0.95
TABLE_BITS = 16
WORD_BITS = 64
WORDS = 3
NEAR_BITS = 18
SAMPLE_ROWS = 16_384
BLOCK_ROWS = 1024


def usable(vec: F.Column) -> F.Column:
    """All components present and finite, not all zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def lengths(df: DataFrame, vec_col: str) -> list[int]:
    """Vector lengths that occur among usable rows, most common first."""
    found = df.where(usable(F.col(vec_col))).groupBy(F.size(vec_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).collect()
    return [int(r.d) for r in found]


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column of one length as doubles."""
    flat = col.flatten().cast(pa.float64())
    return np.asarray(flat).reshape(-1, dim)


def unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def fit_rotation(sample: np.ndarray, dim: int, bits: int, rounds: int = 50) -> np.ndarray:
    """dim x bits projection: principal directions turned by the learnt rotation."""
    moment = sample.T @ sample if len(sample) else np.eye(dim)
    _, vecs = np.linalg.eigh(moment)
    vecs = vecs[:, ::-1][:, :bits]
    r, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((bits, bits)))
    v = sample @ vecs
    for _ in range(rounds if len(sample) else 0):
        u, _, wt = np.linalg.svd(np.sign(v @ r).T @ v)
        r = (u @ wt).T
    return vecs @ r


def fit_projection(sample: np.ndarray, dim: int) -> np.ndarray:
    """dim x (WORDS * WORD_BITS): the learnt rotation, then random rotations."""
    parts = [fit_rotation(sample, dim, min(WORD_BITS, dim))]
    rng = np.random.default_rng(11)
    while sum(x.shape[1] for x in parts) < WORDS * WORD_BITS:
        parts.append(np.linalg.qr(rng.standard_normal((dim, min(WORD_BITS, dim))))[0])
    return np.hstack(parts)[:, : WORDS * WORD_BITS]


def codes_of(m: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Code words of each vector, one column a word."""
    on = (unit(m) @ projection > 0).reshape(len(m), WORDS, WORD_BITS)
    return (on.astype(np.uint64) << np.arange(WORD_BITS, dtype=np.uint64)).sum(2, dtype=np.uint64)


def _codes_fn(projection: np.ndarray, dim: int):
    def fn(batches):
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                code = codes_of(matrix(b.column("vec").slice(s, 4096), dim), projection).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("ck").slice(s, 4096)] + [pa.array(code[:, w].copy()) for w in range(WORDS)],
                                                 names=["ck"] + [f"c{w}" for w in range(WORDS)])
    return fn


def _keys_fn(batches):
    """(key, ck, code): a row for each table and neighbour; ``code`` is the table's word."""
    flips = np.concatenate([[0], 1 << np.arange(TABLE_BITS)]).astype(np.int64)
    tables = WORD_BITS // TABLE_BITS
    shift = np.arange(tables, dtype=np.uint64) * np.uint64(TABLE_BITS)
    for b in batches:
        for s in range(0, b.num_rows, 4096):
            ck = np.asarray(b.column("ck").slice(s, 4096))
            for w in range(WORDS):
                code = np.asarray(b.column(f"c{w}").slice(s, 4096)).view(np.uint64)
                sub = (code[:, None] >> shift).astype(np.int64) & 0xFFFF
                table = w * tables + np.arange(tables)
                key = ((table[None, :, None] << TABLE_BITS) | (sub[:, :, None] ^ flips)).reshape(len(code), -1)
                each = key.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().astype(np.int32)), pa.array(np.repeat(ck, each)),
                     pa.array(np.repeat(code.view(np.int64), each))], names=["key", "ck", "code"])


def _handled(code, key, bi, bj, side, i, j, near_bits):
    """Pairs within ``near_bits`` that belong to this table and key: the word's first table
    in which their substrings differ in at most two bits, and there the smaller key."""
    ok = (bi[i] == bj[i]) | (side[i] != side[j])
    x = code[i] ^ code[j]
    ok &= np.bitwise_count(x) <= near_bits
    i, j, x = i[ok], j[ok], x[ok]
    table, k = (key[i] >> TABLE_BITS) % (WORD_BITS // TABLE_BITS), key[i] & 0xFFFF
    ok = np.ones(len(i), bool)
    for t in range(WORD_BITS // TABLE_BITS):
        part = (x >> np.uint64(t * TABLE_BITS)) & np.uint64(0xFFFF)
        ok &= (table <= t) | (np.bitwise_count(part) > 2)
    shift = (table * TABLE_BITS).astype(np.uint64)
    a = ((code[i] >> shift) & np.uint64(0xFFFF)).astype(np.int64)
    b = ((code[j] >> shift) & np.uint64(0xFFFF)).astype(np.int64)
    apart = np.bitwise_count((a ^ b).astype(np.uint64))
    ok &= np.where(apart == 0, a == k, np.where(apart == 1, np.minimum(a, b) == k, k < (a ^ b ^ k)))
    return i[ok], j[ok]


def met(x: np.ndarray, near_bits: int) -> np.ndarray:
    """Whether a word keeps a pair, ``x`` the bits in which it differs."""
    some = np.zeros(len(x), bool)
    for t in range(WORD_BITS // TABLE_BITS):
        some |= np.bitwise_count((x >> np.uint64(t * TABLE_BITS)) & np.uint64(0xFFFF)) <= 2
    return some & (np.bitwise_count(x) <= near_bits)


_KEYS = ["key", "bi", "bj"]


def _columns(t: pa.Table) -> tuple:
    c = {k: np.asarray(t.column(k).combine_chunks()) for k in ("code", "key", "bi", "bj", "side")}
    return c["code"].view(np.uint64), c["key"].astype(np.int64), c["bi"], c["bj"], c["side"]


def _near_fn(near_bits: int):
    def fn(batches):
        for t in C.groups_of(batches, _KEYS, 20_000):
            c = _columns(t)
            live = np.zeros(t.num_rows, bool)
            for i, j in C.pair_chunks(C.starts_of(t, _KEYS)):
                i, j = _handled(*c, i, j, near_bits)
                live[i] = live[j] = True
            yield from t.filter(pa.array(live)).combine_chunks().to_batches()
    return fn


def _rerank_fn(dim: int, threshold: float, near_bits: int):
    def fn(batches):
        for t in C.groups_of(batches, _KEYS, 4096):
            t = t.combine_chunks()
            c = _columns(t)
            ck, w = (np.asarray(t.column(k).combine_chunks()) for k in ("ck", "w"))
            words = [np.asarray(t.column(f"c{k}").combine_chunks()).view(np.uint64) for k in range(WORDS)]
            word = c[1] // (WORD_BITS // TABLE_BITS << TABLE_BITS)
            u = unit(matrix(t.column("vec").combine_chunks(), dim))
            links, fi, fj = np.zeros(len(ck), np.int64), [], []
            for i, j in C.pair_chunks(C.starts_of(t, _KEYS)):
                i, j = _handled(*c, i, j, near_bits)
                for k in range(WORDS - 1):
                    ok = (word[i] <= k) | ~met(words[k][i] ^ words[k][j], near_bits)
                    i, j = i[ok], j[ok]
                for s in range(0, len(i), 50_000):
                    x, y = i[s: s + 50_000], j[s: s + 50_000]
                    ok = np.einsum("ij,ij->i", u[x], u[y]) >= threshold
                    x, y = x[ok], y[ok]
                    np.add.at(links, x, w[y])
                    np.add.at(links, y, w[x])
                    fi.append(x)
                    fj.append(y)
            if not fi:
                continue
            low = C.low_labels(len(ck), np.concatenate(fi), np.concatenate(fj), ck)
            out = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ck[out]), pa.array(links[out]), pa.array(low[out])], names=["ck", "links", "low"])
    return fn


def near_links(classes: DataFrame, dim: int, threshold: float, near_bits: int, sample_rows: int, block_rows: int) -> DataFrame:
    """(ck, links, low) of the classes of vectors of one length."""
    sample = classes.orderBy("ck").limit(sample_rows).select("vec").collect()
    projection = fit_projection(unit(np.array([r.vec for r in sample], float).reshape(-1, dim)), dim)
    words = ", ".join(f"c{w} long" for w in range(WORDS))
    codes = C.stored(classes.select("ck", "vec").mapInArrow(_codes_fn(projection, dim), f"ck long, {words}"), "op1-codes")
    cand = C.bucket_blocks(codes.mapInArrow(_keys_fn, "key int, ck long, code long"), "key", "ck", block_rows)
    schema = "key int, ck long, code long, bi int, bj int, side int"
    live = C.by_bucket(cand.select("key", "ck", "code", "bi", "bj", "side")).mapInArrow(_near_fn(near_bits), schema)
    full = live.join(classes.select("ck", "w", "vec").join(codes, "ck"), "ck")
    return C.by_bucket(full).mapInArrow(_rerank_fn(dim, threshold, near_bits), "ck long, links long, low long")


def itq_neardup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                near_bits: int = NEAR_BITS, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
    dims = lengths(src, "vec")
    fine = usable(F.col("vec"))
    rows = C.stored(src.select("id", F.when(fine, F.xxhash64("vec")).alias("ck"), F.when(fine, F.col("vec")).alias("vec")), "op1-rows")
    classes = C.stored(rows.where("ck is not null").groupBy("ck").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("w"), F.first("vec").alias("vec")), "op1-classes")
    found = [near_links(classes.where(F.size("vec") == d), d, threshold, near_bits, sample_rows, block_rows) for d in dims]
    links = C.stored(reduce(DataFrame.unionByName, found, C.empty_like(vectors.sparkSession, "ck long, links long, low long")), "op1-links")
    number = links.groupBy("ck").agg(F.sum("links").alias("links"))
    part = C.components(links.select(F.col("ck").alias("a"), F.col("low").alias("b"))).select(F.col("id").alias("ck"), "component")
    of = classes.select("ck", "rep", "w").join(number, "ck", "left").join(part, "ck", "left").withColumn("component", F.coalesce("component", "ck"))
    name = of.groupBy("component").agg(F.min("rep").alias("low"))
    of = of.join(name, "component").select("ck", "low", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"))
    out = rows.select("id", "ck").join(of, "ck", "left")
    alone = F.col("ck").isNull()
    return out.select("id", F.when(alone, F.lit(0)).otherwise(F.col("links")).cast("long").alias("n_links"),
                      F.when(alone, F.col("id")).otherwise(F.col("low")).alias("component_id")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op1_itq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: vectors of cosine 0.95 or more, whatever their labels."""
    return itq_neardup(C.read(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
