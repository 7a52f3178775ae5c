"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic
calibration.

1. Document statistics: lengths, shares of byte classes, word and line repetition,
   capitals, symbols; of the whole text, from its bytes.  Language, source and id are
   no inputs.
2. 256 random Fourier features of the standardised statistics approximate a Gaussian
   kernel.  Each partition sums its normal equations; 257 summed rows reach the driver.
3. Ridge on three quarters of the training rows (a hash of the id picks them); the others
   calibrate: their scores are counted in 4,000 bins, and pooling adjacent violators
   makes the share of label 1 rise with the score.

Training rows are those with a label of 0 or 1 whose crc32(id as text) modulo 3 is not 1.
Defined cases: null text is empty and is scored like any other; of repeated labels of an
id the majority counts (ties: 1); repeated documents get the same score; null ids are
not held out and have no label; without training rows every score is 0.5, with one label
only it is that label; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

RFF = 256
RIDGE = 1e-4
BINS = 4_000
LOW, HIGH = -0.75, 1.75
_GROUPS = [b"", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"'\"-?", b"!", b"#$%&*@^~=+<>/\\_`",
           b"|()[]{}", bytes(range(0x80, 0x9F)), bytes(range(0x9F, 0xC0)), bytes(range(0xC0, 0x100))]
_CLASS = np.zeros(256, np.int64)
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _i
_N = len(_GROUPS)
FEATURES = _N + 10


def _distinct(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes per row."""
    k = np.sort(C.mix(h + C.mix(row.astype(np.uint64))) >> np.uint64(24) | row.astype(np.uint64) << np.uint64(40))
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.empty(0, bool)
    return np.bincount((k[new] >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """rows x FEATURES statistics of the texts in a buffer."""
    n = len(off) - 1
    off = off - off[0]
    size = np.diff(off).astype(float)
    row = np.repeat(np.arange(n), np.diff(off))
    share = np.bincount(row * _N + _CLASS[data], minlength=n * _N).reshape(n, _N)
    p = C.prefix_hash(data)
    ws, we, wr = C.word_spans(data, off)
    words = np.bincount(wr, minlength=n).astype(float)
    upper, symbol = (_CLASS == 2), (_CLASS >= 8) & (_CLASS <= 10)
    cap = np.bincount(wr, upper[data[ws]], n)
    loud = np.bincount(wr, upper[data[np.maximum(we - 2, ws)]] & upper[data[ws]] & (we - ws > 1), n)
    sym = np.bincount(wr, symbol[data[we - 1]], n)
    length2 = np.bincount(wr, (we - ws).astype(float) ** 2, n)
    cut = np.flatnonzero(data == 10)
    ls = np.unique(np.concatenate([off[:-1], cut + 1]))
    ls = ls[ls < len(data)] if len(data) else ls[:0]
    lr = np.searchsorted(off, ls, "right") - 1
    le = np.minimum(np.append(ls[1:], len(data)), off[lr + 1]) if len(ls) else ls
    lines = np.bincount(lr, minlength=n).astype(float)
    one = np.maximum(size, 1)[:, None]
    w1, l1 = np.maximum(words, 1), np.maximum(lines, 1)
    half = [np.log1p(size), np.log1p(words), (size / w1).clip(0, 50), np.sqrt(length2 / w1).clip(0, 50),
            _distinct(C.span_hash(p, ws, we), wr, n) / w1, _distinct(C.span_hash(p, ls, le), lr, n) / l1, np.log1p(words / l1), cap / w1, loud / w1, sym / w1]
    return np.hstack([share / one, np.stack(half, 1)])


def batch_statistics(col: pa.Array) -> np.ndarray:
    data, off = C.text_buffer(col)
    out = [statistics(data[off[i]: off[j]], off[i: j + 1]) for i, j in C.doc_chunks(off)]
    return np.concatenate(out) if out else np.empty((0, FEATURES))


@dataclass
class Model:
    """Everything the scoring tasks need; a fixed size whatever the input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return rff((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.values[0])
        out = np.empty(len(x))
        for s in range(0, len(x), 4096):
            out[s: s + 4096] = np.interp(self.raw(x[s: s + 4096]), self.knots, self.values)
        return out


def rff(z: np.ndarray) -> np.ndarray:
    """Random Fourier features, with a constant."""
    rng = np.random.default_rng(5)
    w = rng.standard_normal((FEATURES, RFF)) / np.sqrt(FEATURES)
    return np.hstack([np.sqrt(2 / RFF) * np.cos(z.clip(-8, 8) @ w + rng.uniform(0, 2 * np.pi, RFF)), np.ones((len(z), 1))])


def held_out(id_col: str = "id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return C.fixed_binary(b.column("f"), FEATURES, np.float64)


def _feature_fn(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("id"), C.binary_rows(batch_statistics(b.column("text")))], names=["id", "f"])


def _sums(df: DataFrame, fn) -> dict[int, np.ndarray]:
    """Per partition ``fn`` maps (features, labels) to a matrix; their sum, row by row."""
    def part(batches):
        total = None
        for b in batches:
            m = fn(_matrix(b), np.asarray(b.column("y")))
            total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int64)), C.binary_rows(total)], names=["i", "v"])

    def whole(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column("i").to_pylist(), b.column("v").to_pylist()):
                v = np.frombuffer(v)
                sums[i] = sums[i] + v if i in sums else v
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["i", "v"])

    rows = df.select("f", "y").mapInArrow(part, "i long, v binary").repartition(8, "i").mapInArrow(whole, "i long, v binary").collect()
    return {r.i: np.frombuffer(bytes(r.v)) for r in rows}


def isotonic(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: rising shares of label 1 over bins with n > 0."""
    blocks: list[list[float]] = []
    for c, s in zip(n, ones):
        blocks.append([c, s, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            c2, s2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + c2, blocks[-1][1] + s2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / c) for c, s, k in blocks])


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model:
    """Model from (id, f) and the labels, by the training rows alone."""
    lab = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")) \
        .where("id is not null and y in (0, 1)").groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    train = C.stored(features.join(lab.where(~held_out()), "id").withColumn("cal", F.pmod(F.xxhash64("id"), F.lit(4)) == 0), "op8-train")
    main, cal = train.where("not cal"), train.where("cal")
    s = _sums(main, lambda x, y: np.stack([x.sum(0), (x * x).sum(0), np.full(FEATURES, float(len(x))), np.full(FEATURES, y.sum())]))
    none = np.zeros(FEATURES)
    if not s or s[2][0] == 0 or s[3][0] in (0.0, s[2][0]):
        only = s[3][0] / s[2][0] if s and s[2][0] else 0.5
        return Model(none, none + 1, None, none, np.array([only]))
    n = s[2][0]
    mean = s[0] / n
    scale = np.sqrt(np.maximum(s[1] / n - mean * mean, 0))
    scale[scale < 1e-9] = 1.0

    def normal(x, y):
        z = rff((x - mean) / scale)
        return z.T @ np.hstack([z, y[:, None]])
    a = _sums(main, normal)
    a = np.stack([a[i] for i in range(RFF + 1)])
    w = np.linalg.solve(a[:, :-1] + RIDGE * n * np.diag(np.append(np.ones(RFF), 0.0)) + 1e-9 * np.eye(RFF + 1), a[:, -1])
    model = Model(mean, scale, w, none, none)

    def bins(batches):
        for b in batches:
            k = np.floor((model.raw(_matrix(b)).clip(LOW, HIGH) - LOW) / (HIGH - LOW) * (BINS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), b.column("y")], names=["k", "y"])
    got = cal.select("f", "y").mapInArrow(bins, "k long, y double").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).orderBy("k").collect()
    if not got:  # too few rows to calibrate on
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        return model
    k, m, ones = (np.array([r[i] for r in got], float) for i in range(3))
    model.knots, model.values = LOW + (k + 0.5) / (BINS - 1) * (HIGH - LOW), isotonic(m, ones)
    return model


def features_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f): a document's id and statistics, stored."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return C.stored(src.mapInArrow(_feature_fn, "id long, f binary"), "op8-features")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score, predicted."""
    f = features_of(docs, id_col, text_col)
    model = fit(f, labels, id_col, label_col)

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(model.score(_matrix(b)))], names=["id", "held_out", "score"])
    out = f.withColumn("held_out", held_out()).mapInArrow(score, "id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more; texts are not shuffled."""
    model = fit(features_of(docs, id_col, text_col), labels, id_col, label_col)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(model.score(batch_statistics(b.column(text_col))) >= 0.5))
    return docs.mapInArrow(keep, docs.schema)


def op8_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: quality of every document."""
    return quality(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")
