"""N-gram Jaccard self-join with Bayesian candidate pruning.

Two documents link if the Jaccard similarity of their sets of five-word shingles is
0.8 or more (words: runs of bytes other than space and \\t..\\r, case kept).

1. Documents with one shingle set form a class; from here on classes are joined.
2. 128 MinHash values a class; 20 bands of 4 give the buckets (a pair at 0.8 misses all
   bands with probability 3e-5).  A pair is handled only in its first common band.
3. Pruning (BayesLSH, Satuluri and Parthasarathy 2012): MinHash values are compared 16 at a
   time; with a uniform prior, m agreements of n give the similarity a Beta(m+1, n-m+1)
   posterior, and a pair is dropped once P(similarity >= 0.8) is under 1e-5.
4. Members with a pair left send their shingle sets to that bucket, where the similarity
   is computed exactly.  Buckets emit, for each member, its number of links and the
   smallest class it reaches there, never pairs; large buckets are cut into block pairs.
5. Connected components over those edges.

Defined cases: a document of 1 to 4 words has one shingle of all its words; without
words (null, empty, blank) it links with nothing; repeated rows are documents of their
own and count as copies; null ids never name a class; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WORDS = 5
THRESHOLD = 0.8
HASHES, BAND, BANDS, STEP = 128, 4, 20, 16
TOLERANCE = 1e-5
BLOCK_ROWS = 512

_A = C._splitmix(HASHES, 0xA11CE) | np.uint64(1)
_B = C._splitmix(HASHES, 0xB0B)


def least_agreements(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> dict[int, int]:
    """n -> smallest number of agreements among n that keeps a pair."""
    x = (np.arange(20_000) + 0.5) / 20_000
    out = {}
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):
            logp = m * np.log(x) + (n - m) * np.log1p(-x)
            p = np.exp(logp - logp.max())
            if p[x >= threshold].sum() / p.sum() >= tolerance:
                out[n] = m
                break
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the 128 smallest multiply-shift hashes of a set."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(low, ((shingles[i: i + 512, None] * _A + _B) >> np.uint64(32)).min(0), out=low)
    return (low & np.uint64(0xFFFF)).astype(np.uint16)


def _set_key(s: np.ndarray) -> int:
    return int(C.mix(C.mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def _sign_fn(words: int):
    def fn(batches):
        for b in batches:
            data, off = C.text_buffer(b.column("text"))
            keys, sizes, sigs = [], [], []
            for i, j in C.doc_chunks(off):
                for s in C.shingle_sets(data[off[i]: off[j]], off[i: j + 1] - off[i], words):
                    keys.append(_set_key(s))
                    sizes.append(len(s))
                    sigs.append(signature(s) if len(s) else np.zeros(HASHES, np.uint16))
            sig = C.binary_rows(np.array(sigs, np.uint16).reshape(-1, HASHES))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("rid"), b.column("text_key"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), sig],
                names=["id", "rid", "text_key", "ck", "m", "sig"])
    return fn


def _bands_fn():
    def fn(batches):
        salt = C._splitmix(BANDS, 5)
        for b in batches:
            sig = C.fixed_binary(b.column("sig"), HASHES, np.uint16)
            word = np.ascontiguousarray(sig[:, : BAND * BANDS]).view(np.uint64).reshape(-1, BANDS)
            key = C.mix(word ^ salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel()), pa.array(np.repeat(np.asarray(b.column("ck")), BANDS)),
                 pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig)))], names=["key", "ck", "band"])
    return fn


def _likely(sig, m, band, bi, bj, side, i, j, threshold, least):
    """Pairs that this bucket handles and that survive the pruning."""
    ok = ((bi[i] == bj[i]) | (side[i] != side[j])) & (np.minimum(m[i], m[j]) >= threshold * np.maximum(m[i], m[j]) - 1e-9)
    i, j = i[ok], j[ok]
    agree = np.zeros(len(i), np.int32)
    for n, need in least.items():
        agree += (sig[i, n - STEP: n] == sig[j, n - STEP: n]).sum(1, dtype=np.int32)
        ok = agree >= need
        i, j, agree = i[ok], j[ok], agree[ok]
    word = np.ascontiguousarray(sig[:, : BAND * BANDS]).view(np.uint64).reshape(-1, BANDS)
    out_i, out_j = [], []
    for k in range(0, len(i), 50_000):
        x, y = i[k: k + 50_000], j[k: k + 50_000]
        first = (word[x] == word[y]).argmax(1)
        ok = first == band[x]
        out_i.append(x[ok])
        out_j.append(y[ok])
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (i, j)


def _columns(t: pa.Table) -> dict:
    out = {k: np.asarray(t.column(k).combine_chunks()) for k in ("key", "ck", "band", "bi", "bj", "side", "m")}
    return out | {"sig": C.fixed_binary(t.column("sig"), HASHES, np.uint16)}


def _prune_fn(threshold: float, least: dict):
    def fn(batches):
        for t in C.groups_of(batches, ["key", "bi", "bj"], 8192):
            c = _columns(t)
            live = np.zeros(t.num_rows, bool)
            for i, j in C.pair_chunks(C.starts_of(t, ["key", "bi", "bj"]), 100_000):
                i, j = _likely(c["sig"], c["m"], c["band"], c["bi"], c["bj"], c["side"], i, j, threshold, least)
                live[i] = live[j] = True
            yield pa.RecordBatch.from_arrays([pa.array(c[k][live]) for k in ("ck", "key", "band", "bi", "bj", "side")],
                                             names=["ck", "key", "band", "bi", "bj", "side"])
    return fn


def _sets_fn(words: int):
    """Each class's shingle set, sent to each of its buckets."""
    def fn(batches):
        for b in batches:
            data, off = C.text_buffer(b.column("text"))
            ck, w = np.asarray(b.column("ck")), np.asarray(b.column("w"))
            to = b.column("buckets")
            at = np.asarray(to.offsets)
            f = {k: np.asarray(to.values.field(k)) for k in ("key", "band", "bi", "bj", "side")}
            for i, e in C.doc_chunks(off):
                sets = C.shingle_sets(data[off[i]: off[e]], off[i: e + 1] - off[i], words)
                for r, s in zip(range(i, e), sets):
                    if _set_key(s) != ck[r]:  # another text under this row identity
                        continue
                    sig = signature(s).tobytes()
                    raw = s.tobytes()
                    for lo in range(at[r], at[r + 1], 64):
                        k = slice(lo, min(lo + 64, at[r + 1]))
                        n = k.stop - k.start
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(f["key"][k]), pa.array(f["band"][k]), pa.array(f["bi"][k]), pa.array(f["bj"][k]), pa.array(f["side"][k]),
                             pa.array(np.full(n, ck[r])), pa.array(np.full(n, w[r])), pa.array(np.full(n, len(s), np.int32)),
                             pa.array([sig] * n, pa.binary()), pa.array([raw] * n, pa.binary())],
                            names=["key", "band", "bi", "bj", "side", "ck", "w", "m", "sig", "shingles"])
    return fn


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (i, j)."""
    if len(i) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    size = [len(s) for s in sets]
    _, inv, cnt = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    col = np.cumsum(cnt > 1) - 1
    row = np.repeat(np.arange(len(sets)), size)
    ok = cnt[inv] > 1
    row, col = row[ok], col[inv[ok]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    o = np.argsort(col, kind="stable")
    row, col = row[o], col[o]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):
        a, b = np.searchsorted(col, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, int(col[-1]) + 1 - lo)), np.float32)
        m[row[a:b], col[a:b] - lo] = 1
        both += m @ m.T
    return both[i, j].astype(np.int64)


def _verify_fn(threshold: float, least: dict):
    def fn(batches):
        for t in C.groups_of(batches, ["key", "bi", "bj"], 512):
            t = t.combine_chunks()
            c = _columns(t)
            w = np.asarray(t.column("w").combine_chunks())
            starts = C.starts_of(t, ["key", "bi", "bj"])
            data, off = C.text_buffer(t.column("shingles"))
            for lo, hi in zip(starts, starts[1:]):
                _, k = np.unique(c["ck"][lo:hi], return_index=True)
                k = np.sort(k) + lo
                part = {x: v[k] for x, v in c.items()}
                links = np.zeros(len(k), np.int64)
                sets = [np.frombuffer(data[off[x]: off[x + 1]].tobytes(), np.uint64) for x in k]
                ii, jj = [], []
                for i, j in C.pair_chunks(np.array([0, len(k)]), 100_000):
                    i, j = _likely(part["sig"], part["m"], part["band"], part["bi"], part["bj"], part["side"], i, j, threshold, least)
                    ii.append(i)
                    jj.append(j)
                if not ii:
                    continue
                i, j = np.concatenate(ii), np.concatenate(jj)
                if not len(i):
                    continue
                both = _common(sets, i, j)
                ok = both >= threshold * (part["m"][i] + part["m"][j] - both) - 1e-9
                i, j = i[ok], j[ok]
                np.add.at(links, i, w[k][j])
                np.add.at(links, j, w[k][i])
                low = C.low_labels(len(k), i, j, part["ck"])
                out = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(part["ck"][out]), pa.array(links[out]), pa.array(low[out])], names=["ck", "links", "low"])
    return fn


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
               tolerance: float = TOLERANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: id, copy_id (smallest id with the same shingle set),
    n_links (documents linked with it, copies included), class_id (smallest id
    reachable by links), kept (id = class_id); text_key (hash of the text) and class_key
    (hash that names the class, the text's own for a document without words)."""
    least = least_agreements(threshold, tolerance)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    base = base.withColumn("text_key", F.xxhash64("text")).withColumn("rid", F.coalesce("id", "text_key"))
    signed = C.stored(base.mapInArrow(_sign_fn(words), "id long, rid long, text_key long, ck long, m int, sig binary"), "op6-signed")
    full = signed.where("m > 0")
    classes = C.stored(full.groupBy("ck").agg(F.min("id").alias("copy_id"), F.min("rid").alias("rep"), F.count(F.lit(1)).alias("w"),
                                              F.min("m").alias("m"), F.first("sig").alias("sig")), "op6-classes")
    bands = classes.select("ck", "sig").mapInArrow(_bands_fn(), "key long, ck long, band int")
    cand = C.bucket_blocks(bands, "key", "ck", block_rows)
    cand = cand.join(classes.select("ck", "m", "sig"), "ck")
    live = C.stored(C.by_bucket(cand).mapInArrow(_prune_fn(threshold, least), "ck long, key long, band int, bi int, bj int, side int"), "op6-live")
    to = live.groupBy("ck").agg(F.collect_list(F.struct("key", "band", "bi", "bj", "side")).alias("buckets"))
    to = to.join(classes.select("ck", "rep", "w"), "ck").withColumnRenamed("rep", "rid")
    sets = base.select("rid", "text").join(to, "rid").select("ck", "w", "text", "buckets").mapInArrow(
        _sets_fn(words), "key long, band int, bi int, bj int, side int, ck long, w long, m int, sig binary, shingles binary")
    links = C.stored(C.by_bucket(sets).mapInArrow(_verify_fn(threshold, least), "ck long, links long, low long"), "op6-links")
    number = links.groupBy("ck").agg(F.sum("links").alias("links"))
    part = C.components(links.select(F.col("ck").alias("a"), F.col("low").alias("b"))).select(F.col("id").alias("ck"), "component")
    of = classes.select("ck", "copy_id", "w").join(number, "ck", "left").join(part, "ck", "left") \
        .withColumn("component", F.coalesce("component", "ck"))
    name = of.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    of = of.join(name, "component").select("ck", "copy_id", "class_id", "component", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    out = signed.select("id", "text_key", F.when(F.col("m") > 0, F.col("ck")).alias("ck")).join(of, "ck", "left")
    alone = F.col("ck").isNull()
    return out.select("id", F.when(alone, F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
                      F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                      F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                      "text_key", F.coalesce("component", "text_key").alias("class_key")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("class_id")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: documents whose five-word shingle sets have Jaccard similarity of 0.8 or more."""
    return ngram_join(C.read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "copy_id", "n_links", "class_id", "kept")
