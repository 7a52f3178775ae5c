"""Merkle manifest, label-propagation shards and hard negatives against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rewardframe.llm import common as C
from rewardframe.llm import op11_merkle as o11
from rewardframe.llm import op12_label_shards as o12
from rewardframe.llm import op13_hard_negatives as o13

DOC = "doc_id long, text string, lang string, source string, n_chars long"
VEC = "vec_id long, embedding array<float>, label int"
#: Extra columns named like the operators' own.
EXTRA = ", id long, key string, h string, idx int, up string, root string, g int, u double, shard int, slot int, rid int, dim int, block int, windows int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(r, text):
    return _h(*map(_enc, (r[0], r[3], r[2], r[4], text)))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([_h(*row[i:i + 3]) for i in range(0, len(row), 3)])
    return levels


def _walk(levels, i):
    for row in levels[:-1]:
        lo = i - i % 3
        yield row[lo:i], row[i + 1: lo + 3]
        i //= 3


def _merkle(rows):
    """One tuple a row: doc_id, leaf, subroot, root, proof, folded root."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, _leaf(r, r[1]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
    trees = {s: _tree([x[2] for x in groups[s]]) for s in names}
    top = _tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[s]):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h, seen = _leaf(r, text), []
            for left, right in [*_walk(trees[s], i), *_walk(top, k)]:
                h = _h(*left, h, *right)
                seen += left + right
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], _h(*seen), h))
    return out


def _proved(df):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    cut = [F.replace(F.col("text"), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in o11.FIELDS]
    m = o11.manifest(df, extra={"bad": F.when(tampered, o11.leaf_digest(cut))})
    got = o11.verify(o11.proofs(m), F.lower(F.hex(F.coalesce("bad", F.unhex("leaf"))))).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"] == m.root()) for r in got)
    return got


def _key(t):
    return tuple((x is not None, x or 0) for x in t)


@pytest.mark.parametrize("n", [1, 4, 82, 700])
def test_merkle_equals_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(i), f"line {i}\nend é" * int(rng.integers(1, 4)), "en", "s", 3) for i in rng.permutation(n)]
    rows += [(n + i, None, None, [None, "", "é", "z"][i % 4], i) for i in range(n // 20)]
    got = _proved(spark.createDataFrame(rows, DOC).repartition(3))
    cols = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    assert sorted(map(_key, ([r[c] for c in cols] for r in got))) == sorted(map(_key, _merkle(rows)))


def test_merkle_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "a\nb", "en", None, 3), (5, "", "en", "t", 0), (5, "", "en", "t", 0), (5, "x\n" * 40_000, "en", "t", 1),
            (2, "\n", "x", "t", None), (4, "\n\n", "x", "one", None)] * 2
    wide = [(*r, 1, "k", "h", 1, "u", "r", 1, 1.0, 1, 1, 1, 1, 1, 1) for r in rows]
    got = _proved(spark.createDataFrame(wide, DOC + EXTRA))
    want = _merkle(rows)
    assert sorted(map(_key, ((r["id"], r["leaf"], r["subroot"], r["root"]) for r in got))) == sorted(_key(w[:4]) for w in want)
    # equal rows may swap places, each with the path of its own
    assert Counter((r["id"], r["proof_sha256"]) for r in got) == Counter((w[0], w[4]) for w in want)
    assert all(r["verified"] for r in got if r["id"] is None)


def test_merkle_of_nothing_and_of_one_row(spark):
    empty = o11.manifest(C.empty_like(spark, DOC))
    assert empty.root() is None and o11.proofs(empty).count() == 0
    one = o11.proofs(o11.manifest(spark.createDataFrame([(1, "a", "b", "c", 1)], DOC))).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["path"] == ""


def test_merkle_stores_no_level_between_steps(spark):
    m = o11.manifest(spark.range(1000).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars"))
    assert [x.count() for x in m.groups.levels] == [1000, 13]


# --- shards ---------------------------------------------------------------------------


def _shards(df, shards=16, rows=20_000):
    return o12.shard(df, o12.text_group(F.col("text")), {"doc_id": F.col("doc_id"), "text": F.col("text")}, shards, rows=rows).collect()


def _even(got, n, shards=16):
    assert len(got) == n
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(shards))
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def _parts(got):
    where = defaultdict(set)
    size = Counter()
    for r in got:
        where[r["text"] or ""].add(r["shard"])
        size[r["text"] or ""] += 1
    return {t: len(s) for t, s in where.items()}, size


def test_shards_keep_groups_whole(spark):
    rows = [(i, f"g{i % 300}" if i < 900 else f"s{i}") for i in range(2003)]
    got = _shards(spark.createDataFrame(rows, "doc_id long, text string"), rows=100)
    _even(got, 2003)
    parts, _ = _parts(got)
    assert max(parts.values()) == 1


def test_shards_when_every_row_is_linked(spark):
    # no shard ever has a free row, so rows can only swap: not all groups can gather
    rows = [(i, f"g{i // 3}") for i in range(4800)]
    got = _shards(spark.createDataFrame(rows, "doc_id long, text string"), rows=500)
    _even(got, len(rows))
    parts, _ = _parts(got)
    assert sum(p > 1 for p in parts.values()) <= 0.15 * len(parts)


def test_shards_gather_all_groups_given_some_space(spark):
    rows = [(i, f"g{i // 7}") for i in range(7 * 600)] + [(i, f"s{i}") for i in range(7 * 600, 7 * 600 + 800)]
    got = _shards(spark.createDataFrame(rows, "doc_id long, text string"), rows=300)
    _even(got, len(rows))
    parts, _ = _parts(got)
    assert sum(p > 1 for p in parts.values()) <= 0.02 * 600


def test_shards_split_a_group_larger_than_a_shard(spark):
    rows = [(i, "same" if i % 3 == 0 else f"t{i}") for i in range(4800)]
    got = _shards(spark.createDataFrame(rows, "doc_id long, text string"), rows=200)
    _even(got, 4800)
    parts, size = _parts(got)
    assert size["same"] == 1600 and parts["same"] <= 7  # 300 rows a shard: 6 is the least


def test_quotas_keep_shards_within_capacity():
    rng = np.random.default_rng(5)
    for _ in range(200):
        d = rng.integers(0, 50, (6, 6))
        np.fill_diagonal(d, 0)
        free = rng.integers(0, 20, 6)
        x = o12.quotas(d, free)
        assert (x >= 0).all() and (x <= d).all() and (x.sum(0) - x.sum(1) <= free).all()
    three = np.array([[0, 9, 0], [0, 0, 7], [8, 0, 0]])
    assert o12.quotas(three, np.zeros(3, int)).sum() == 21  # the cycle of seven
    swap = np.array([[0, 5], [5, 0]])
    assert (o12.quotas(swap, np.zeros(2, int)) == swap).all()


def test_shards_odd_rows(spark):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "é" * 90_000), (2, "é" * 90_000), (3, "x")]
    wide = [(i, t, "en", None, 1, 1, "k", "h", 1, "u", "r", 1, 1.0, 1, 1, 1, 1, 1, 1) for i, t in rows]
    got = _shards(spark.createDataFrame(wide, DOC + EXTRA))
    _even(got, 7)
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    assert _shards(C.empty_like(spark, DOC)) == []


# --- hard negatives ---------------------------------------------------------------------


def _mined(rows, low=50, high=95):
    use = [(i, v, y, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v, y in rows
           if y is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    last = 2**63 - 1
    out = []
    for k, (i, _, y, a) in enumerate(use):
        if i is None or i % 50:
            continue
        s = [(-sum(p * q for p, q in zip(a, b)), last if j is None else j, z, n) for n, (j, _, z, b) in enumerate(use) if n != k and len(b) == len(a)]
        for ps, pid, _, _ in sorted(x for x in s if x[2] == y)[:5]:
            hits = sorted(x for x in s if x[2] != y and low * -ps <= 100 * -x[0] <= high * -ps)[:3]
            out += [(i, None if pid == last else pid, r + 1, None if n[1] == last else n[1], -ps, -n[0]) for r, n in enumerate(hits)]
    return Counter(out)


def _negatives(df, **kw):
    return Counter(map(tuple, o13.hard_negatives(df, F.col("vec_id") % 50 == 0, **kw).collect()))


@pytest.mark.parametrize("dim", [1, 3, 16, 64])
def test_hard_negatives_equal_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(4, dim))
    rows = [(int(i), (centre[i % 4] + 0.7 * rng.normal(size=dim)).astype(np.float32).tolist(), int(i % 5)) for i in rng.permutation(600)]
    df = spark.createDataFrame(rows, VEC).repartition(4)
    assert _negatives(df, block=128) == _negatives(df) == _mined(rows)


def test_hard_negatives_ties(spark):
    # few distinct scores: ids decide
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-1, 2, 4)], int(i % 3)) for i in range(400)]
    assert _negatives(spark.createDataFrame(rows, VEC), block=64) == _mined(rows)


def test_hard_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [0.5, 1.0], 2), (None, [0.5, 1.1], 2), (3, None, 1), (4, [1.0, nan], 1),
            (5, [inf, 1.0], 2), (6, [1.0, None], 2), (7, [1.0, 1.0], None), (50, [], 1), (51, [], 1), (52, [], 2), (100, [0.0, 0.0], 1), (101, [1.0, 1.0, 1.0], 3),
            (150, [-1.0, -1.0], 9), (151, [1.0, 1.0], 9), (200, [1.0, 2.0], None), (102, [0.4, 1.2], 2), (103, [0.45, 1.2], 2), (104, [0.45, 1.2], 2)]
    wide = [(*r, 1, "k", "h", 1, "u", "r", 1, 1.0, 1, 1, 1, 1, 1, 1) for r in rows]
    assert _negatives(spark.createDataFrame(wide, VEC + EXTRA)) == _mined(rows)
    assert _negatives(C.empty_like(spark, VEC)) == Counter()


def test_hard_negatives_with_huge_components(spark):
    big = float(np.float32(1e6))  # products beyond 2**53
    rows = [(i * 10, [big * (1 + (i % 7)), -big / (1 + i % 3)], i % 2) for i in range(40)]
    assert _negatives(spark.createDataFrame(rows, VEC)) == _mined(rows)


def test_threshold_ends_the_scan_early():
    # one strong direction: the threshold falls below the kth score after a few rows
    rng = np.random.default_rng(1)
    v = np.zeros((4096, 8))
    v[:, 0] = rng.permutation(4096)
    lists = o13.Lists(np.arange(4096), np.arange(4096), v)
    seen = []

    def stop(rows, scores, t):
        seen.append(len(rows))
        kth = o13._kth(scores, 5)
        return kth is not None and kth > t

    a = np.zeros(8)
    a[0] = 3
    rows, score = lists.scan(a, stop, np.zeros(4096, bool))
    assert seen[-1] == o13.FIRST_DEPTH
    assert sorted(score)[-5:] == [3.0 * x for x in range(4091, 4096)]


# --- edge cases of earlier operators ----------------------------------------------------


def test_ngram_join_of_nothing(spark):
    from rewardframe.llm import op6_ngram_join as o6

    assert o6.ngram_join(C.empty_like(spark, DOC)).count() == 0


def test_pipeline_stages_of_nothing(spark):
    import corpus_pipeline

    none = C.empty_like(spark, DOC)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0, name


def test_near_vectors_without_ids(spark):
    from rewardframe.llm import op1_itq_neardup as o1

    rows = [(None, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (7, [-3.0, 1.0, 0.0])]
    got = o1.itq_neardup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.id or -1, r.n_links) for r in got) == [(-1, 2), (-1, 2), (5, 2), (7, 0)]
