"""Hard-negative mining by Fagin's threshold algorithm.

Components become floor(256 x), so scores are integers and compare exactly.  Candidates are
dealt to blocks; an anchor visits every block, positives first, then negatives:

1. In a block each dimension has a list of the candidates in order of their component
   (for positives a list for each label).
2. Sorted access: an anchor reads every list from the end that its component's sign makes the
   better one, some rows deeper at each step.  Candidates seen for the first time are scored
   in full (random access).
3. The threshold is the sum, over the dimensions, of the anchor's component times the last
   value read: no unseen candidate can score higher.  The scan stops once it lies strictly
   below the kth score of every window asked for (strictly, as an equal score could still win
   by its smaller id), or below the window's lower bound.
4. A block's best are merged by Spark's ranked window, whose limit acts before the shuffle.

A positive is a window without bounds over the anchor's label; a negative's window is
[low, high] times its positive's score over the other labels.

Defined cases: rows with a null label or vector, or a null or non-finite component take no
part; vectors are compared with those of their length (empty ones score 0); components
beyond 64 bits count as the end of that range, and a score beyond it is shown as that end; a null vec_id is no
anchor and comes last among equal scores; repeated rows are different rows; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common as C

BLOCK = 4096
FIRST_DEPTH = 16
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
_LAST = np.iinfo(np.int64).max


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(rid, vec_id, label, dim, v): rows that take part, components as integers."""
    x = F.col(f"`{vec_col}`")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    ok = F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & ~F.exists(x, bad)
    ints = F.transform(x, lambda e: F.floor(e.cast("double") * 256).cast("long"))
    return vectors.where(ok).select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                                    F.col(f"`{label_col}`").cast("long").alias("label"), F.size(x).alias("dim"), ints.alias("v"))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), dim)


class Lists:
    """Sorted access to some candidates of a block."""

    def __init__(self, ids: np.ndarray, rid: np.ndarray, v: np.ndarray):
        self.ids, self.rid, self.v = ids, rid, v
        self.order = np.argsort(v, axis=0, kind="stable").T  # dimension by place
        self.sorted = np.take_along_axis(v, self.order.T, 0).T

    def scan(self, a: np.ndarray, stop, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows seen, their scores) for anchor ``a``; ``stop(rows, scores, threshold)`` ends the
        scan; ``skip`` marks rows that are no candidates."""
        n = len(self.ids)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen = skip.copy()
        rows, scores = [], []
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            end = min(n, depth + step) if len(up) + len(down) else n
            fresh = np.zeros(n, bool)
            if len(up) + len(down):
                fresh[self.order[up, n - end: n - depth]] = True
                fresh[self.order[down, depth:end]] = True
            else:
                fresh[:] = True  # all components are 0: no list tells candidates apart
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            if len(new):
                rows.append(new)
                scores.append(self.v[new] @ a)
            depth, step = end, step * 2
            if depth < n and rows:
                t = (a[up] * self.sorted[up, n - depth]).sum() + (a[down] * self.sorted[down, depth - 1]).sum()
                rows, scores = [np.concatenate(rows)], [np.concatenate(scores)]
                if stop(rows[0], scores[0], t):
                    break
        if not rows:
            return np.empty(0, np.int64), np.empty(0, self.v.dtype)
        return np.concatenate(rows), np.concatenate(scores)


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    if len(score) > 8 * k and score.dtype != object:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= kth)
        return near[_best(ids[near], score[near], k)] if len(near) < len(score) else _order(ids, score)[:k]
    return _order(ids, score)[:k]


def _order(ids: np.ndarray, score: np.ndarray) -> np.ndarray:
    o = np.argsort(ids, kind="stable")
    return o[np.argsort(-score[o], kind="stable")]


def _kth(score: np.ndarray, k: int):
    """The kth highest score, None if there are fewer."""
    if len(score) < k:
        return None
    return sorted(score)[-k] if score.dtype == object else np.partition(score, len(score) - k)[len(score) - k]


def positives_of(lists: Lists, a: np.ndarray, rid: int, k: int) -> list[tuple[int, int]]:
    """Best ``k`` (place in the lists, score) other than the anchor itself."""
    def stop(rows, scores, t):
        kth = _kth(scores, k)
        return kth is not None and kth > t

    rows, score = lists.scan(a, stop, lists.rid == rid)
    return [(int(rows[i]), int(score[i])) for i in _best(lists.ids[rows], score, k)]


def negatives_of(lists: Lists, a: np.ndarray, same: np.ndarray, windows: list[int], k: int, low: int, high: int) -> list[list[tuple[int, int]]]:
    """For each positive score the best ``k`` rows that are not ``same`` and lie in its window."""
    def inside(scores, p):
        return (100 * scores >= low * p) & (100 * scores <= high * p)

    def stop(rows, scores, t):
        for p in windows:
            if 100 * int(t) < low * p or low * p > high * p:
                continue  # nothing unseen reaches the window, or no score can
            kth = _kth(scores[inside(scores, p)], k)
            if kth is None or not kth > t:
                return False
        return True

    rows, score = lists.scan(a, stop, same)
    out = []
    for p in windows:
        at = np.flatnonzero(inside(score, p)) if len(score) else np.empty(0, np.int64)
        out.append([(int(rows[at[i]]), int(score[at[i]])) for i in _best(lists.ids[rows[at]], score[at], k)])
    return out


def _exact(v: np.ndarray, w: np.ndarray) -> type:
    """A type in which 100 times the inner products of ``v`` and ``w`` are exact."""
    top = max(1, v.shape[1]) * float(np.abs(v.astype(float)).max(initial=0)) * float(np.abs(w.astype(float)).max(initial=0)) * 100
    return np.float64 if top < 2**53 else object


def _long(x: int) -> int:
    return max(-(2**63), min(_LAST, x))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """Per block its candidates, whole, and its anchors batch by batch.  Rows come sorted by
    (dim, block, kind); only one block's candidates are held."""
    def pieces():
        for b in batches:
            if b.num_rows:
                at = C.starts_of(pa.Table.from_batches([b]), ["dim", "block", "kind"])
                yield from (b.slice(int(lo), int(hi - lo)) for lo, hi in zip(at, at[1:]))

    stream = pieces()
    piece = next(stream, None)

    def of(key: tuple, kind: int):
        nonlocal piece
        while piece is not None and (piece.column("dim")[0].as_py(), piece.column("block")[0].as_py(), piece.column("kind")[0].as_py()) == (*key, kind):
            yield piece
            piece = next(stream, None)

    while piece is not None:
        key = piece.column("dim")[0].as_py(), piece.column("block")[0].as_py()
        held = list(of(key, 0))
        anchors = of(key, 1)
        if held:
            yield pa.Table.from_batches(held), anchors
        for _ in anchors:  # what is left of a block without candidates
            pass


def _mine_fn(k_pos: int, k_neg: int, low: int, high: int, negatives: bool):
    def fn(batches):
        for block, anchors in _blocks(batches):
            dim = block.column("dim")[0].as_py()
            v = _matrix(block.column("v").combine_chunks(), dim)
            rid, label = np.asarray(block.column("rid")), np.asarray(block.column("label"))
            ids = np.asarray(block.column("vec_id").fill_null(_LAST))
            by_type: dict = {}
            for b in anchors:
                av = _matrix(b.column("v"), dim)
                kind = _exact(v, av)
                if kind not in by_type:
                    x = v.astype(kind)
                    whole = np.arange(len(ids))
                    parts = [whole] if negatives else [np.flatnonzero(label == c) for c in np.unique(label)]
                    by_type[kind] = {None if negatives else int(label[p[0]]): (p, Lists(ids[p], rid[p], x[p])) for p in parts}
                lists = by_type[kind]
                av = av.astype(kind)
                a_rid, a_label = b.column("rid").to_pylist(), b.column("label").to_pylist()
                asked = b.column("windows").to_pylist()
                out = []
                for i in range(b.num_rows):
                    if negatives:
                        part, of = lists[None]
                        found = negatives_of(of, av[i], label == a_label[i], [int(w) for w in asked[i]], k_neg, low, high)
                        out += [(a_rid[i], w, int(ids[part[r]]), int(rid[part[r]]), _long(s)) for w, best in zip(asked[i], found) for r, s in best]
                    elif a_label[i] in lists:
                        part, of = lists[a_label[i]]
                        out += [(a_rid[i], None, int(ids[part[r]]), int(rid[part[r]]), _long(s)) for r, s in positives_of(of, av[i], a_rid[i], k_pos)]
                cols = list(zip(*out)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "window", "id", "rid", "score"])
    return fn


def _dealt(rows: DataFrame, anchors: DataFrame, block: int) -> DataFrame:
    """Candidates in blocks of their length, each anchor in all blocks of its length."""
    sizes = C.stored(rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("nb")), "op13-lengths")
    cand = rows.join(sizes, "dim").select("dim", F.pmod(F.xxhash64("rid"), F.col("nb")).cast("int").alias("block"), F.lit(0).alias("kind"),
                                          "rid", "vec_id", "label", "v", F.array().cast("array<long>").alias("windows"))
    ask = anchors.join(sizes, "dim").select("dim", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"), F.lit(1).alias("kind"),
                                            "rid", "vec_id", "label", "v", "windows")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cand.unionByName(ask).repartition(n, "dim", "block").sortWithinPartitions("dim", "block", "kind")


def hard_negatives(vectors: DataFrame, anchor: F.Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows
    where ``anchor`` (over vec_id) holds."""
    rows = C.stored(usable(vectors, id_col, vec_col, label_col), "op13-rows")
    anchors = rows.where(anchor)
    none = F.array().cast("array<long>")
    found = "a long, window long, id long, rid long, score long"
    mine = lambda df, neg: df.mapInArrow(_mine_fn(positives, negatives, low, high, neg), found)
    best = [F.desc("score"), "id", "rid"]
    pos = mine(_dealt(rows, anchors.withColumn("windows", none), block), False)
    pos = pos.withColumn("rank", F.row_number().over(W.partitionBy("a").orderBy(*best))).where(F.col("rank") <= positives)
    pos = C.stored(pos.select("a", F.col("id").alias("pid"), F.col("score").alias("ps")), "op13-positives")
    asked = pos.groupBy("a").agg(F.sort_array(F.collect_set("ps")).alias("windows")).withColumnRenamed("a", "rid")  # at most ``positives`` scores
    neg = mine(_dealt(rows, anchors.join(asked, "rid"), block), True)
    neg = neg.withColumn("rank", F.row_number().over(W.partitionBy("a", "window").orderBy(*best))).where(F.col("rank") <= negatives)
    null = lambda c: F.when(F.col(c) != _LAST, F.col(c))
    out = pos.join(neg.withColumnRenamed("window", "ps"), ["a", "ps"]).join(anchors.select(F.col("rid").alias("a"), "vec_id"), "a")
    return out.select(F.col("vec_id").alias("anchor_id"), null("pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                      null("id").alias("negative_id"), F.col("ps").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: negatives for every 50th vector against all rows."""
    rows = C.read(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


SQL = f"""
WITH r AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.rid, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM r a JOIN r b ON a.rid <> b.rid AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT a, anchor_id, rid AS prid, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, rid) <= {POSITIVES}),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.a, p.prid ORDER BY s.score DESC, s.vec_id, s.rid) AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS BIGINT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
