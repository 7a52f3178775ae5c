"""Suffix-array dedup over whole documents (exact repeated byte strings).

Every byte that lies in a ``length``-byte string which also starts somewhere else in
the corpus is removed.  Blockwise construction with a difference cover:

1. *Suffix buckets.*  A suffix with at least ``length`` bytes left in its document goes
   to the bucket of the smallest ``gram``-byte hash in its first ``length`` bytes.  Equal
   strings share that gram and their offset to it, so a repeat never crosses buckets.
   Neighbouring suffixes share their bucket, so a run of them is one row (about one row
   for 170 bytes).  Buckets with one member cannot hold a repeat and end here.
2. *Cover sample.*  In a bucket the suffixes at columns (offsets to the gram) that lie in the
   difference cover modulo 31 are ranked by their bytes: 31 bytes at first, then, as the
   sample is closed under steps of 31, by pairs of ranks over 62, 124, 248, ... bytes.
3. *Sorting.*  Buckets are sorted one after the other, a bounded number of rows at a time: a
   suffix by its column, its bytes up to the next cover column, the rank there, and the
   bytes that rank leaves over.  Neighbours equal in all of these are equal byte for byte.

No hash decides there: one only spares suffixes whose hash nobody shares the sort.  Buckets of
more than ``hot_rows`` rows never come together in a task: their suffixes are counted by
Spark's partial aggregation, by two 64-bit hashes each.  Groups of equal texts (128 bits) are removed
whole and send one representative to the buckets.

With ``words``, passages of that many words or more that repeat go from ``kept_text`` too, however
short their bytes: each word becomes a ``WORD_BYTES``-byte hash and the same steps find the
repeated strings of ``words`` hashes.  White space between two kept words stays.  All other
columns tell of the byte strings alone.

Defined cases: null text is empty; a text shorter than ``length`` bytes keeps all its
bytes (no string of that length starts in it); repeated rows are different documents;
null ids stay null; an empty table gives no rows; extra columns are ignored.  Text is UTF-8 bytes, so a cut may fall inside a character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

U64 = np.uint64
LENGTH = 400
GRAM = 64
#: Perfect difference set: every residue difference modulo 31 occurs once.
COVER_MOD, COVER = 31, (1, 5, 11, 24, 25, 27)
HOT_ROWS = 50_000
WORD_BYTES = 6
#: Fewest words of a repeated passage that goes from the query's ``text``.
PASSAGE_WORDS = 51
_POS_BITS = 21


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours, by block-wise running minima."""
    n = len(x) - w + 1
    pad = (-len(x)) % w
    m = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    fwd = np.minimum.accumulate(m, axis=1).ravel()
    bwd = np.ascontiguousarray(np.minimum.accumulate(m[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(bwd[:n], fwd[w - 1: w - 1 + n])


def bucket_runs(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Runs of suffixes with one bucket: (row, first, count, anchor - first, bucket, hash
    of the run's bytes), positions relative to the row's start.  Segment by segment."""
    out = []
    w = length - gram + 1
    low = np.uint64((1 << _POS_BITS) - 1)
    for s in range(int(off[0]), int(off[-1]), C.CHUNK_BYTES):
        seg = data[s: min(s + C.CHUNK_BYTES + length - 1, int(off[-1]))]
        m = len(seg) - length + 1
        if m <= 0:
            break
        p = C.prefix_hash(seg)
        g = C.span_hash(p, np.arange(len(seg) - gram + 1), np.arange(gram, len(seg) + 1))
        place = low - np.arange(len(g), dtype=np.uint64)
        a = (low - (_window_min((g & ~low) | place, w) & low)).astype(np.int64)
        r0, r1 = np.searchsorted(off, [s, s + m - 1], "right") - 1
        ok = np.zeros(m, bool)
        row = np.empty(m, np.int64)
        for r in range(int(r0), int(r1) + 1):
            lo, hi = max(0, int(off[r]) - s), min(m, int(off[r + 1]) - s)
            row[lo:hi] = r
            ok[lo: max(lo, min(hi, int(off[r + 1]) - s - length + 1))] = True
        begin = ok.copy()
        begin[1:] &= (a[1:] != a[:-1]) | (row[1:] != row[:-1]) | ~ok[:-1]
        i0 = np.flatnonzero(begin)
        if not len(i0):
            continue
        stop = np.flatnonzero(ok & ~np.append((ok[1:] & ~begin[1:]), False))
        r = row[i0]
        out.append((r, i0 + s - off[r], stop - i0 + 1, a[i0] - i0, g[a[i0]].view(np.int64), C.span_hash(p, i0, stop + length)))
    if not out:
        z = np.empty(0, np.int64)
        return z, z, z, z, z, z.view(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _runs_fn(length: int, gram: int):
    def fn(batches):
        for b in batches:
            data, off = C.text_buffer(b.column("text"))
            dg = np.asarray(b.column("dg"))
            ids = b.column("id")
            for i, j in C.doc_chunks(off, 2 * C.CHUNK_BYTES):
                r, first, n, back, h, body = bucket_runs(data, off[i: j + 1], length, gram)
                r = r + i
                # a run whose bytes repeat in its own text (a line over and over) is settled
                # here: one run goes on, and the repeats are merged spans
                o = np.lexsort((first, body, h, r))
                same = (r[o][1:] == r[o][:-1]) & (h[o][1:] == h[o][:-1]) & (body[o][1:] == body[o][:-1])
                again, twice = np.zeros(len(o), bool), np.zeros(len(o), bool)
                again[o[1:][same]] = True
                twice[o[1:][same]] = twice[o[:-1][same]] = True
                k = np.flatnonzero(twice)
                if len(k):
                    k = k[np.lexsort((first[k], r[k]))]
                    hi = first[k] + n[k] + length - 1
                    top = np.maximum.accumulate(hi + (r[k] << 40)) - (r[k] << 40)
                    new = np.concatenate([[True], (r[k][1:] != r[k][:-1]) | (first[k][1:] > top[:-1])])
                    lo, end = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(k)) - 1
                    none = pa.nulls(len(lo), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [none, pa.array(dg[r[k][lo]]), ids.take(pa.array(r[k][lo])), pa.array(first[k][lo]), pa.nulls(len(lo), pa.int32()),
                         pa.nulls(len(lo), pa.int32()), pa.array(top[end])], names=["h", "dg", "id", "first", "n", "back", "own"])
                r, first, n, back, h = (x[~again] for x in (r, first, n, back, h))
                own = C.mix(dg[r].view(np.uint64) + C.mix((first + back).astype(np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(dg[r]), ids.take(pa.array(r)), pa.array(first), pa.array(n.astype(np.int32)),
                     pa.array(back.astype(np.int32)), pa.array(own)],
                    names=["h", "dg", "id", "first", "n", "back", "own"])
    return fn


def _cut_fn(length: int):
    """Ship the bytes of each surviving run: its suffixes' first ``length`` bytes."""
    def fn(batches):
        for b in batches:
            data, off = C.text_buffer(b.column("text"))
            runs = b.column("runs")
            at = np.asarray(runs.offsets)
            v = runs.values
            f = {k: np.asarray(v.field(k)) for k in ("h", "first", "n", "back", "hot")}
            dg = np.asarray(b.column("dg"))
            for i in range(b.num_rows):
                for j in range(at[i], at[i + 1], 512):
                    k = slice(j, min(j + 512, at[i + 1]))
                    lo = off[i] + f["first"][k]
                    hi = lo + f["n"][k] + length - 1
                    size = hi - lo
                    pos = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    body = b"".join(data[x:y].tobytes() for x, y in zip(lo, hi))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f["h"][k]), pa.array(np.full(len(lo), dg[i])), pa.array(f["first"][k]),
                         pa.array(f["back"][k]), pa.array(f["hot"][k]),
                         pa.Array.from_buffers(pa.binary(), len(lo), [None, pa.py_buffer(pos.tobytes()), pa.py_buffer(body)])],
                        names=["h", "dg", "first", "back", "hot", "body"])
    return fn


def _suffixes(body: pa.Array, length: int):
    """All suffixes with ``length`` bytes in the given rows: (bytes, row, place in the row, position)."""
    data, off = C.text_buffer(body)
    data, off = data[off[0]: off[-1]], off - off[0]
    n = off[1:] - off[:-1] - length + 1
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return data, row, at, off[:-1][row] + at


def _numbers(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number, zeros past the end: comparing
    such numbers in turn compares bytes."""
    far = np.concatenate([data, np.zeros(512, np.uint8)])
    out = np.zeros(len(far) - 7, U64)
    for j in range(8):
        out = (out << U64(8)) | far[j: j + len(out)]
    return out


_FIRST = np.array([0] + [((1 << 8 * n) - 1) << (64 - 8 * n) for n in range(1, 9)], U64)


def _words_at(numbers: np.ndarray, pos: np.ndarray, size: np.ndarray | int, words: int) -> list[np.ndarray]:
    """The ``size`` bytes at each position as ``words`` numbers, zero-filled."""
    return [numbers[pos + 8 * j] & _FIRST[np.clip(size - 8 * j, 0, 8)] for j in range(words)]


def _dense(cols: list[np.ndarray]) -> np.ndarray:
    """Rank of each row in the order of the columns; equal rows share a rank."""
    o = np.lexsort(cols[::-1])
    step = np.zeros(len(o), np.int64)
    for c in cols:
        step[1:] |= c[o][1:] != c[o][:-1]
    rank = np.empty(len(o), np.int64)
    rank[o] = np.cumsum(step)
    return rank


def cover_ranks(numbers: np.ndarray, first: np.ndarray, blocks: int) -> np.ndarray:
    """Ranks of the suffixes at ``first`` by their next ``blocks * COVER_MOD`` bytes.  The cover
    sample is closed under steps of COVER_MOD, so ranks of one block double to 2, 4, 8, ..."""
    if not blocks:
        return np.zeros(len(first), np.int64)
    mask = np.zeros(len(numbers), bool)
    for j in range(blocks):
        mask[first + j * COVER_MOD] = True
    sample = np.flatnonzero(mask)
    index = np.cumsum(mask, dtype=np.int32) - 1

    def ahead(rank, k):  # rank k blocks on; only read where the whole stretch lies in one body
        to = sample + k * COVER_MOD
        ok = (to < len(mask)) & mask[np.minimum(to, len(mask) - 1)]
        return np.where(ok, rank[index[np.where(ok, to, 0)]], 0)

    rank, width = _dense(_words_at(numbers, sample, COVER_MOD, -(-COVER_MOD // 8))), 1
    out, done = None, blocks  # the stretch is put together from its end
    while True:
        if blocks & width:
            done -= width
            part = rank[index[first + done * COVER_MOD]]
            out = part if out is None else _dense([part, out])
        width *= 2
        if width > blocks:
            return out
        rank = _dense([rank, ahead(rank, width // 2)])


def repeated_suffixes(body: pa.Array, back: np.ndarray, group: np.ndarray, length: int):
    """(row, place, repeated) of all suffixes: sorted inside their bucket and column by the bytes up to the
    next cover column, the rank there, and the bytes that rank leaves over.  Suffixes whose
    hash nobody shares cannot repeat and are not sorted."""
    data, row, at, pos = _suffixes(body, length)
    dup = np.zeros(len(row), bool)
    h = C.mix(C.span_hash(C.prefix_hash(data), pos, pos + length) ^ C.mix(group[row].astype(np.uint64)))
    o = np.argsort(h, kind="stable")
    same = h[o][1:] == h[o][:-1]
    maybe = np.zeros(len(row), bool)
    maybe[o[1:][same]] = maybe[o[:-1][same]] = True
    k = np.flatnonzero(maybe)
    if not len(k):
        return row, at, dup
    col = at[k] - back[row[k]]
    step = np.array([next(d for d in range(COVER_MOD) if (c + d) % COVER_MOD in COVER) for c in range(COVER_MOD)])
    d, far = step[col % COVER_MOD], int(step.max())
    blocks = max(0, length - far) // COVER_MOD
    deep = blocks * COVER_MOD
    numbers = _numbers(data)
    rank = cover_ranks(numbers, pos[k] + d, blocks)
    if not blocks:
        d = np.zeros_like(d)
    head = _words_at(numbers, pos[k], d, -(-far // 8))
    tail = _words_at(numbers, pos[k] + d + deep, length - d - deep, -(-(length - deep) // 8))
    keys = [group[row[k]], col, *head, rank, *tail]
    o = np.lexsort(keys[::-1])
    eq = np.ones(len(o) - 1, bool)
    for c in keys:
        eq &= c[o][1:] == c[o][:-1]
    dup[k[o[1:][eq]]] = dup[k[o[:-1][eq]]] = True
    return row, at, dup


def _dups_fn(length: int, rows: int):
    def fn(batches):
        for t in C.groups_of(batches, ["h"], rows):
            t = t.combine_chunks()
            h, dg, first, back = (np.asarray(t.column(k).combine_chunks()) for k in ("h", "dg", "first", "back"))
            # a text's run counts once, also if equal texts sent it twice
            o = np.lexsort((first, dg, h))
            same = (h[o][1:] == h[o][:-1]) & (dg[o][1:] == dg[o][:-1]) & (first[o][1:] == first[o][:-1])
            keep = np.sort(o[np.concatenate([[True], ~same])]) if len(o) else o
            body = t.column("body").combine_chunks()
            group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
            # blocks of whole buckets; a bucket is under hot_rows rows
            bounds = [0]
            gk = group[keep]
            while bounds[-1] < len(keep):
                e = min(bounds[-1] + rows, len(keep))
                e2 = int(np.searchsorted(gk, gk[e - 1], "right"))
                bounds.append(e2)
            for lo, hi in zip(bounds, bounds[1:]):
                k = keep[lo:hi]
                row, at, dup = repeated_suffixes(body.take(pa.array(k)), back[k], group[k], length)
                yield _spans(row, at, dup, dg[k], first[k], length)
    return fn


def _spans(row, at, dup, dg, first, length):
    i = np.flatnonzero(dup)
    new = np.concatenate([[True], (row[i][1:] != row[i][:-1]) | (at[i][1:] != at[i][:-1] + 1)]) if len(i) else np.empty(0, bool)
    lo = i[new]
    hi = i[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(i) - 1]]).astype(int)] if len(i) else i
    return pa.RecordBatch.from_arrays(
        [pa.array(dg[row[lo]]), pa.array(first[row[lo]] + at[lo]), pa.array(first[row[hi]] + at[hi] + length)],
        names=["dg", "lo", "hi"])


def _hot_keys_fn(length: int):
    """Suffixes of hot buckets by two independent 64-bit hashes of their bytes."""
    def fn(batches):
        for b in batches:
            h, dg, first = (np.asarray(b.column(k)) for k in ("h", "dg", "first"))
            for i in range(0, b.num_rows, 256):
                k = slice(i, min(i + 256, b.num_rows))
                data, row, at, p = _suffixes(b.column("body").slice(i, 256), length)
                bucket = C.mix(h[k][row].view(np.uint64))
                key = C.mix(C.span_hash(C.prefix_hash(data), p, p + length) ^ bucket)
                key2 = C.mix(C.span_hash(C.prefix_hash(data ^ np.uint8(0xA5)), p, p + length) + bucket)
                pos = first[k][row] + at
                own = C.mix(dg[k][row].view(np.uint64) + C.mix(pos.astype(np.uint64))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(key2.view(np.int64)), pa.array(dg[k][row]), pa.array(pos), pa.array(own)],
                                                 names=["key", "key2", "dg", "pos", "own"])
    return fn


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Union of half-open spans, touching ones joined."""
    out: list[list[int]] = []
    for i in np.argsort(lo, kind="stable"):
        if out and lo[i] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(hi[i]))
        else:
            out.append([int(lo[i]), int(hi[i])])
    return [tuple(x) for x in out]


def _words_fn(batches):
    """Each text as the hashes of its words."""
    for b in batches:
        data, off = C.text_buffer(b.column("text"))
        for i, j in C.doc_chunks(off):
            part, at = data[off[i]: off[j]], off[i: j + 1] - off[i]
            start, end, row = C.word_spans(part, at)
            h = C.mix(C.span_hash(C.prefix_hash(part), start, end))
            body = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]).tobytes()
            pos = (np.searchsorted(row, np.arange(j - i + 1)) * WORD_BYTES).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").slice(i, j - i), b.column("dg").slice(i, j - i),
                 pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(pos.tobytes()), pa.py_buffer(body)])], names=["id", "dg", "text"])


def word_cuts(raw: bytes, spans: list[tuple[int, int]] | None) -> list[tuple[int, int]]:
    """Bytes of the words that spans of the word hashes cover whole (None: of all words)."""
    start, end, _ = C.word_spans(*_one(raw))
    whole = [(0, len(start))] if spans is None else [(-(-lo // WORD_BYTES), hi // WORD_BYTES) for lo, hi in spans]
    return [(int(start[lo]), int(end[hi - 1])) for lo, hi in whole if lo < hi]


def _one(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(raw, np.uint8), np.array([0, len(raw)])


def _without(raw: bytes, cut: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for x, y in cut:
        kept.append(raw[at:x])
        at = y
    kept.append(raw[at:])
    return b"".join(kept)


def _apply_fn(length: int, with_text: bool, words: int | None = None):
    def fn(batches):
        for b in batches:
            data, off = C.text_buffer(b.column("text"))
            copies = np.asarray(b.column("copies"))
            spans = b.column("spans")
            rows, kept_text = [], []
            for i in range(b.num_rows):
                raw = data[off[i]: off[i + 1]].tobytes()
                cut, passage = [], []
                if spans[i].is_valid:
                    v = spans[i].values
                    lo, hi, word = (np.asarray(v.field(k).cast(pa.int64())) for k in ("lo", "hi", "word"))
                    cut = merge_spans(lo[word == 0], hi[word == 0])
                    if words:
                        passage = word_cuts(raw, merge_spans(lo[word == 1], hi[word == 1]))
                if copies[i] > 1 and len(raw) >= length:
                    cut = [(0, len(raw))]
                if words and copies[i] > 1 and len(raw.split()) >= words:
                    passage = word_cuts(raw, None)
                kept = _without(raw, cut)
                rows.append((len(raw), sum(y - x for x, y in cut), len(cut), hashlib.sha256(kept).hexdigest(),
                             [{"lo": x, "hi": y} for x, y in cut]))
                if passage:
                    kept = _without(raw, merge_spans(*np.array(cut + passage, np.int64).reshape(-1, 2).T))
                kept_text.append(kept)
            cols = list(zip(*rows)) if rows else [[]] * 5
            arrays = [b.column("id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                      pa.array(cols[3], pa.string()), pa.array(cols[4], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
            if with_text:
                arrays.append(pa.array([k.decode("utf-8", "ignore") for k in kept_text], pa.string()))
                names.append("kept_text")
                rest = [n for n in b.schema.names if n.startswith("x_")]
                arrays += [b.column(n) for n in rest]
                names += rest
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return fn


def repeat_spans(base: DataFrame, length: int, gram: int, hot_rows: int, block_rows: int) -> DataFrame:
    """(dg, lo, hi): repeated strings of the texts (id, dg, text), equal ``dg`` as one text."""
    runs = C.stored(base.select("id", "dg", "text").mapInArrow(
        _runs_fn(length, gram), "h long, dg long, id long, first long, n int, back int, own long"), "op9-runs")
    local = runs.where("h is null").select("dg", F.col("first").alias("lo"), F.col("own").alias("hi")).distinct()
    runs = runs.where("h is not null")
    alive = runs.groupBy("h").agg(F.min("own").alias("a"), F.max("own").alias("b"), F.count(F.lit(1)).alias("c")).where("a <> b") \
        .select("h", (F.col("c") > hot_rows).alias("hot"))
    todo = runs.join(alive, "h").groupBy("dg").agg(
        F.min("id").alias("rep"), F.collect_set(F.struct("h", "first", "n", "back", "hot")).alias("runs"))
    snippets = base.select("id", "dg", "text").join(todo, "dg").where("id <=> rep").select("dg", "text", "runs").mapInArrow(
        _cut_fn(length), "h long, dg long, first long, back int, hot boolean, body binary")
    snippets = C.stored(snippets, "op9-snippets")
    n = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = snippets.where("not hot").repartition(n, "h").sortWithinPartitions("h").mapInArrow(
        _dups_fn(length, block_rows), "dg long, lo long, hi long")
    keys = snippets.where("hot").mapInArrow(_hot_keys_fn(length), "key long, key2 long, dg long, pos long, own long")
    twice = keys.groupBy("key", "key2").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a <> b").select("key", "key2")
    hot = keys.join(twice, ["key", "key2"], "left_semi").select("dg", F.col("pos").alias("lo"), (F.col("pos") + length).alias("hi"))
    return C.stored(cold.unionByName(hot).unionByName(local), "op9-spans")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                 hot_rows: int = HOT_ROWS, block_rows: int = 1024, carry: list[str] | None = None, words: int | None = None) -> DataFrame:
    """One row per input row: (id, n_bytes, n_removed, n_spans, kept_sha256, removed)
    with ``removed`` the spans in the input bytes.  With ``carry`` (column names) also
    ``kept_text`` and those columns as ``x_<name>``; bytes of characters cut in two are
    dropped from ``kept_text``.  With ``words`` repeated passages of so many words go too."""
    carry_cols = [F.col(f"`{c}`").alias(f"x_{c}") for c in carry or []]
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                       *carry_cols)
    base = base.withColumns({"dg": F.xxhash64("text"), "dg2": F.xxhash64(F.lit(1), "text")})
    # a text is removed whole only where 128 bits are equal
    copies = base.groupBy("dg", "dg2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = copies.groupBy("dg").agg(F.collect_list(F.struct("dg2", "copies")).alias("twins"))
    spans = repeat_spans(base, length, gram, hot_rows, block_rows).withColumn("word", F.lit(0))
    if words:
        coded = base.select("id", "dg", "text").mapInArrow(_words_fn, "id long, dg long, text binary")
        spans = spans.unionByName(repeat_spans(coded, words * WORD_BYTES, gram, hot_rows, block_rows).withColumn("word", F.lit(1)))
    spans = spans.groupBy("dg").agg(F.collect_list(F.struct("lo", "hi", "word")).alias("spans"))
    full = base.join(copies.join(spans, "dg", "full_outer"), "dg", "left")
    own = F.get(F.filter("twins", lambda t: t["dg2"] == F.col("dg2")), 0)["copies"]
    full = full.withColumn("copies", F.coalesce(own, F.lit(1)))
    out = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<lo:long,hi:long>>"
    if carry is not None:
        out += ", kept_text string" + "".join(f", `x_{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return full.drop("dg", "dg2", "twins").mapInArrow(_apply_fn(length, carry is not None, words), out)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: repeated 400-byte strings of all documents; ``text`` is what is left when repeated
    passages of over 50 words, which may be shorter than that, go as well."""
    out = suffix_dedup(C.read(spark, sf_dir, "documents"), carry=[], words=PASSAGE_WORDS)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", F.col("kept_text").alias("text"))
