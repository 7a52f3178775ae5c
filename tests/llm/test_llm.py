"""Training-data operators against brute force on small fixtures, and their edge cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rewardframe.llm import common as C
from rewardframe.llm import op1_itq_neardup as o1
from rewardframe.llm import op2_url_filter as o2
from rewardframe.llm import op3_mixing as o3
from rewardframe.llm import op4_adaptive_scan as o4
from rewardframe.llm import op5_warc_zstd as o5
from rewardframe.llm import op6_ngram_join as o6
from rewardframe.llm import op7_packing as o7
from rewardframe.llm import op8_quality_rff as o8
from rewardframe.llm import op9_suffix_dedup as o9
from rewardframe.llm import op10_html_template as o10
from rewardframe.llm import queries

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns named like the operators' own.
EXTRA = ", id long, dg long, ck long, key string, `rank` int, host string, size int, removed string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _text(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("w%d" % x for x in r.integers(0, 4000, n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, copies, repeated rows, clashing columns."""
    long = _text(1, 30_000)
    near = _text(2, 300)
    texts = [None, "", " \n ", "a b", "a b", long, near, near + " tail", "x" * 3000, "line again and again here\n" * 60, long[:5000] + _text(3, 50), "é" * 500]
    rows = [(i, t, "en", ["s", None, "t"][i % 3], None if t is None else len(t), i, 1, None, "k", 3, "h", 9, "r") for i, t in enumerate(texts)]
    rows += [rows[6], (None, near, None, None, None, None, None, None, None, None, None, None, None), (None, None, None, None, None, 1, 1, 1, "", 1, "", 1, "")]
    return spark.createDataFrame(rows, DOC + EXTRA)


@pytest.fixture(scope="module")
def none(spark):
    return C.empty_like(spark, DOC)


def _links(texts, k=5, t=0.8):
    sets = []
    for x in texts:
        w = WORDS.findall(x or "")
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    n = len(sets)
    return [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j])] for i in range(n)]


def _reach(links, i):
    seen, todo = {i}, [i]
    while todo:
        for j in links[todo.pop()]:
            if j not in seen:
                seen.add(j)
                todo.append(j)
    return seen


def test_ngram_join_matches_brute_force(spark, odd):
    docs = C.read(spark, SF, "documents").select("doc_id", "text").unionByName(odd.where("doc_id is not null").select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    rows = docs.collect()
    links = _links([r.text for r in rows])
    want = Counter((r.doc_id, len(links[i]), min(rows[j].doc_id for j in _reach(links, i))) for i, r in enumerate(rows))
    got = Counter((r.id, r.n_links, r.class_id) for r in o6.ngram_join(docs, block_rows=2).collect())
    assert got == want


def test_ngram_join_large_group_and_null_ids(spark, odd):
    base = _text(9, 400).split()
    docs = [(i, " ".join(base[:i] + ["z%d" % i] + base[i:])) for i in range(60)]
    got = o6.ngram_join(spark.createDataFrame(docs, "doc_id long, text string"), block_rows=16).collect()
    links = _links([t for _, t in docs])
    assert {r.id: r.n_links for r in got} == {i: len(links[i]) for i in range(60)} and {r.class_id for r in got} == {0}
    out = o6.ngram_join(odd).collect()
    assert len(out) == odd.count() and sum(r.id is None for r in out) == 2


def _cosine_links(x, t=0.95):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    m = u @ u.T >= t
    np.fill_diagonal(m, False)
    return m


def test_itq_neardup_matches_brute_force(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((300, 64))
    x = np.vstack([x, x[:80] + 0.15 * r.standard_normal((80, 64)), x[0] + 0.1 * r.standard_normal((60, 64)), x[:5], 3 * x[5:8]])
    rows = [(i, [float(y) for y in v], 0) for i, v in enumerate(x)]
    bad = [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] + [1.0] * 63, 1), (903, [None] + [1.0] * 63, 1), (904, [1.0, 2.0], 1), (905, [float("inf")] * 64, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, ck int")
    got = {r.id: r for r in o1.itq_neardup(df, block_rows=16).collect()}
    m = _cosine_links(x)
    links = [list(np.flatnonzero(v)) for v in m]
    assert [got[i].n_links for i in range(len(x))] == m.sum(1).tolist()
    assert [got[i].component_id for i in range(len(x))] == [int(min(_reach(links, i))) for i in range(len(x))]
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906))
    assert o1.itq_neardup(df.limit(0)).count() == 0 and o1.itq_neardup(df.where("vec_id > 899")).count() == 6


@pytest.mark.parametrize("dim", [2, 16, 32, 100])
def test_itq_neardup_finds_all_pairs_at_the_threshold(spark, dim):
    r = np.random.default_rng(dim)
    x = r.standard_normal((150 if dim > 2 else 12, dim))
    y = r.standard_normal(x.shape)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    y -= (y * u).sum(1)[:, None] * u
    v = 0.9501 * u + np.sqrt(1 - 0.9501 ** 2) * y / np.linalg.norm(y, axis=1)[:, None]
    x = np.vstack([u, v])
    df = spark.createDataFrame([(i, [float(a) for a in z]) for i, z in enumerate(x)], "vec_id long, embedding array<double>")
    m = _cosine_links(x)
    got = {z.id: z.n_links for z in o1.itq_neardup(df, block_rows=64).collect()}
    assert [got[i] for i in range(len(x))] == m.sum(1).tolist()


def test_adaptive_scan(spark):
    df = C.read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = o4.adaptive_scan(df, F.col("id") % 20 == 0, sample_rows=1000, list_rows=400, block_rows=150).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = (x * x[np.searchsorted(ids, q)]).sum(1)
        s[ids == q] = -np.inf
        assert len(g) == 20 and sorted(g["rank"]) == list(range(1, 21))
        assert np.allclose(g.sort_values("rank").score, s[np.searchsorted(ids, g.sort_values("rank").vec_id)], rtol=0, atol=1e-12)
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id))
    assert hit / len(got) >= 0.9 and got.query_id.nunique() == 100


def test_adaptive_scan_edges(spark):
    rows = [(i, [float(i % 3), 1.0, 2.0]) for i in range(45)] + [(46, None), (60, [0.0] * 3), (80, [1.0]), (20, [2.0, 1.0, 2.0]), (None, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    got = o4.adaptive_scan(df, F.col("id") % 20 == 0, k=5).toPandas()
    assert set(got.query_id) == {0, 20, 40} and len(got) == 15
    top = got[got.query_id == 0].sort_values("rank")
    assert top.vec_id.isna().iloc[0] and top.vec_id.iloc[1:].tolist() == [1, 2, 3, 4]
    few = o4.adaptive_scan(df.where("vec_id < 3"), F.col("id") % 20 == 0).collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 1), (2, 2)]
    assert o4.adaptive_scan(df.limit(0), F.col("id") == 0).count() == 0


def test_vectors_of_every_length(spark):
    rows = [(i, [1.0 + i, 2.0, 5.0 - i]) for i in range(6)] + [(20, [3.0, 4.0]), (21, [3.0, 4.0]), (22, [-4.0, 3.0]), (40, [7.0]), (60, [2.0, 1.0]), (60, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: r for r in o1.itq_neardup(df.where("vec_id < 60")).collect()}
    assert [got[i].n_links for i in (20, 21, 22, 40)] == [1, 1, 0, 0] and got[21].component_id == 20 and got[0].n_links > 0
    top = o4.adaptive_scan(df, F.col("id") % 20 == 0, k=5).toPandas()
    one = top[top.query_id == 20].sort_values("rank")
    assert one.vec_id.tolist() == [21, 60, 22] and one.score.tolist() == [25.0, 10.0, 0.0] and top[top.query_id == 40].empty
    assert top[top.query_id == 0]["rank"].tolist() == [1, 2, 3, 4, 5] and sorted(top[top.query_id == 60]["rank"]) == [1, 2, 3, 4, 5]


def _brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    n = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        m = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if n[b[i:i + length]] > 1:
                m[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~m])
        out.append((len(b), int(m.sum()), int((m & ~np.append(False, m[:-1])).sum()) if len(m) else 0, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [50_000, 2])
def test_suffix_dedup_matches_brute_force(spark, odd, hot):
    docs = C.read(spark, SF, "documents").limit(80).select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = docs.collect()
    want = Counter(zip([r.doc_id for r in rows], _brute_removed([r.text for r in rows], 400)))
    got = Counter((r.id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in o9.suffix_dedup(docs, hot_rows=hot).collect())
    assert got == want


def test_suffix_dedup_small_alphabet(spark, none):
    r = np.random.default_rng(8)
    texts = ["".join(r.choice(list("ab"), 900)) for _ in range(3)] + ["ab" * 700, "a" * 450, "a" * 400]
    texts.append(texts[0][100:520] + texts[1][:410] + "ab" * 230)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in o9.suffix_dedup(df).collect()}
    assert [got[i] for i in range(len(texts))] == _brute_removed(texts, 400)
    assert o9.suffix_dedup(none).count() == 0


def test_repeated_passages_of_over_50_words(spark, odd, none):
    """Passages of 51 words go however short they are; 50 words and under 400 bytes stay."""
    r = np.random.default_rng(3)
    short, six = (" ".join("".join(r.choice(list("abcdefgh"), n)) for _ in range(60)) for n in (1, 5))
    w, v = short.split(), six.split()
    own = [_text(70 + i, 90) for i in range(9)]
    texts = [own[0] + " " + " ".join(w[:51]) + " " + own[1], own[2] + "\n" + "  ".join(w[:51]), " ".join(v[:54]) + " " + own[3], own[4] + " " + " ".join(v[:54]),
             own[5] + " " + " ".join(v[:50]) + " q", "y " + " ".join(v[:50]) + " " + own[6], own[7], own[7], " ".join(["z"] * 70), "é" * 300, own[8] + " " + "é" * 300]
    texts += [t.text for t in odd.collect()] + [t.text for t in C.read(spark, SF, "documents").limit(60).collect()]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOC)
    raw = [(t or "").encode() for t in texts]
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)] for b in raw]
    grams = [[tuple(b[x:y] for x, y in s[i:i + 51]) for i in range(len(s) - 50)] for b, s in zip(raw, spans)]
    n = Counter(g for x in grams for g in x)
    n400 = Counter(b[i:i + 400] for b in raw for i in range(len(b) - 399))
    want = []
    for b, s, x in zip(raw, spans, grams):
        m = np.zeros(len(b), bool)
        for i, g in enumerate(x):
            if n[g] > 1:
                m[s[i][0]: s[i + 50][1]] = True
        for i in range(len(b) - 399):
            if n400[b[i:i + 400]] > 1:
                m[i:i + 400] = True
        want.append(bytes(np.frombuffer(b, np.uint8)[~m]).decode("utf-8", "ignore"))
    assert want[:4] == [own[0] + "  " + own[1], own[2] + "\n", " " + own[3], own[4] + " "] and want[4] == texts[4] and want[5] == texts[5]
    got = {x.doc_id: x.text for x in corpus_pipeline.repeated_strings(spark, docs, SF).collect()}
    assert [got[i] for i in range(len(texts))] == want
    hot = {x.id: x.kept_text for x in o9.suffix_dedup(docs, carry=[], words=51, hot_rows=2).collect()}
    assert [hot[i] for i in range(len(texts))] == want
    assert corpus_pipeline.repeated_strings(spark, none, SF).count() == 0


def test_url_filter(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org/en/12#t", "http://example.org/en/2", "http://b.com/fr/", "http://b.com/de/1", "http://b.com?x", "nourl", None,
            "x://org/", "http://exampleorg/es/", "http://a.com/fr", ""]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.id: r for r in o2.url_filter(df).collect()}
    assert [(got[i].host, got[i].path) for i in (0, 1, 5, 6, 7)] == [("a.example.org", "/es/x"), ("example.org", "/en/12"), ("b.com", ""), ("", ""), ("", "")]
    assert [got[i].rule for i in range(12)] == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, "org/", None, None, None]
    assert all(r.verdict in ("allow", "block") for r in got.values()) and got[0].verdict == "block"
    one = spark.createDataFrame([("http://a.com/", "block")], "url string, verdict string")
    assert {r.verdict for r in o2.url_filter(df, one, rules=[]).collect()} == {"block"}
    assert {r.verdict for r in o2.url_filter(df, one.limit(0), rules=[]).collect()} == {"allow"}
    assert o2.url_filter(df.limit(0)).count() == 0


def test_url_model_held_out(spark):
    """Names of the label table that the model never saw; the rules' rows are no labels, so
    plain names stay allowed in every language and domain."""
    lab = o2.label_table(spark)
    fold = F.crc32("name") % 5 == 0
    test = lab.where(fold).withColumn("page_id", F.monotonically_increasing_id())
    got = o2.url_filter(test, lab.where(~fold), rules=[]).join(test.select(F.col("page_id").alias("id"), F.col("verdict").alias("want")), "id")
    right = {r.want: r.right for r in got.groupBy("want").agg(F.avg((F.col("verdict") == F.col("want")).cast("int")).alias("right")).collect()}
    assert right["allow"] > 0.95 and right["block"] > 0.85, right
    names = ["quorvel", "ananda", "spring-library", "rivermarket"]
    plain = [f"https://{s}{n}.{d}/{g}/7" for n in names for s in o2.SUBDOMAINS for d in o2.DOMAINS for g in o2.LANGUAGES]
    one = o2.url_filter(spark.createDataFrame(list(enumerate(plain)), "page_id long, url string"), rules=[])
    assert one.where("verdict = 'block'").count() <= 0.02 * len(plain)


def test_url_parts_and_rules_match_sql(spark):
    """Host, path and rule on the given pages and odd urls, against a DuckDB statement."""
    import duckdb
    odd = ["http://A.Example.ORG/es/x?q", "x://org/", "://?", "a://b#c/d", "HTTP://COM/de/", "http://É.com/fr/", "no", None, "http://x.com/fr?/de/", "a://" + "x" * 100_000 + ".com/de/" + "y" * 100_000]
    urls = [r.url for r in C.read(spark, "/root/testdata/sf0.01", "pages").select("url").collect()] + odd
    got = o2.url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    con = duckdb.connect()
    con.execute("CREATE TABLE u (id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO u VALUES (?, ?)", list(enumerate(urls)))
    want = con.execute("""
        WITH r AS (SELECT id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
             h AS (SELECT id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
             t(v, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
        SELECT h.id, host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS verdict
        FROM h LEFT JOIN t ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL""").fetchall()
    got = {r.id: r for r in got.collect()}
    assert len(got) == len(want) == len(urls)
    for i, host, path, rule, verdict in want:
        assert (got[i].host, got[i].path, got[i].rule) == (host or "", path or "", rule)
        assert verdict is None or got[i].verdict == verdict


def test_mixing(spark, odd, none):
    got = o3.mix(odd, rows=2).collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    size = {s: sum(r.size for r in v) for s, v in by.items()}
    order = sorted((s for s in size if s is not None)) + [None]
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = dict.fromkeys(order, 0.0), 1.5 * sum(size.values()), set(order)
    while left > 1e-6 and free:
        total = sum(w[s] for s in free)
        add, left = {s: left * w[s] / total for s in free}, 0.0
        for s, a in add.items():
            target[s] += a
            left += max(0.0, target[s] - 2 * size[s])
            target[s] = min(target[s], 2 * size[s])
        free = {s for s in free if target[s] < 2 * size[s]}
    for s, v in by.items():
        assert all(r.source_size == size[s] and abs(r.target - target[s]) < 1e-3 and r.taken <= 2 * r.size for r in v)
        assert abs(sum(r.taken for r in v) - target[s]) <= 0.5 + 1e-3
    assert sorted(map(str, got)) == sorted(map(str, o3.mix(odd, rows=5).collect()))
    out = o3.mixed_documents(odd)
    words = sum(len(WORDS.findall(r.text or "")) for r in out.collect())
    assert words == sum(r.taken for r in got) and out.schema == odd.schema
    assert o3.mix(none).count() == 0 and o3.mixed_documents(none).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a/\r\n%", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (5, "ü", "é" * 200_000), (None, "n", "<p>x</p>"), (1, "again", "<p>x</p>")]
    rows += [(10 + i, "u", "page %d " % i * 50) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sum", F.lit(1)).coalesce(2)
    folder = o5.write_archives(df, archive_bytes=400, folder=f"{tmp_path}/a b")
    names = sorted(x.name for x in (tmp_path / "a b").iterdir() if not x.name.startswith("."))
    assert len(names) > 2 and all(n.endswith(".warc.zst") and not n.startswith("_") for n in names)
    got = o5.open_archives(spark, folder).collect()
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.url) for r in got) == Counter((r[0], r[1]) for r in rows)
    full = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        body = full[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), o5.digest(body))
        assert r.payload == (body if r.record_type == "response" else b"")
    kind = {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id not in (1, None)}
    assert kind[2] == ("revisit", 1) and kind[3] == ("response", None) and kind[4] == ("revisit", 3)
    (tmp_path / "a b" / "_left-by-a-lost-task.warc.zst").write_bytes(b"half a frame")
    assert o5.open_archives(spark, folder, with_payload=False).count() == len(rows)
    again = o5.write_archives(df)
    assert again.startswith(spark.conf.get("spark.checkpoint.dir")) and o5.open_archives(spark, again).count() == len(rows)
    assert o5.open_archives(spark, o5.write_archives(df.limit(0))).count() == 0


def test_warc_reader_rejects_broken_records(spark, tmp_path):
    ok = o5.record_bytes(1, "u", b"body", "response", None)
    assert o5.parse_record(ok)[1] == b"body"
    for bad in (ok[:-1], ok.replace(b"WARC/1.1", b"HTTP/1.1"), ok.replace(b"Length: 4", b"Length: 5"), ok.replace(b"WARC-Date", b"X"), ok.replace(b"WARC-Type: ", b"WARC-Type "), b"x"):
        with pytest.raises(ValueError):
            o5.parse_record(bad)
    with pytest.raises(ValueError):
        list(o5.frames(b"\x28\xb5\x2f\xfd1234"))
    o5.write_archives(spark.createDataFrame([(1, "u", "abc" * 99)], "page_id long, url string, html string"), folder=str(tmp_path))
    arch = next(tmp_path.glob("*.warc.zst")).read_bytes()
    with pytest.raises(ValueError):
        list(o5.frames(bytes(arch[:-3])))


def test_packing(spark, odd, none):
    docs = odd.select("doc_id", "text").unionByName(C.read(spark, SF, "documents").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(99, "a<|endoftext|>b \n\n c")], "doc_id long, text string"))
    got = o7.pack(docs, rows=50).toPandas()
    tok = o7.encoder(o7.default_tokenizer()).tok
    want = Counter()
    for r in docs.collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.update((r.doc_id, s, min(2048, len(ids) - s), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048))
    have = Counter((None if d != d else int(d), *map(int, x)) for d, *x in got[["id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False))
    assert have == want
    g = got.sort_values(["sequence_id", "offset"])
    assert ((g.groupby("sequence_id").length.cumsum() - g.length) == g.offset).all() and g.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= got.length.sum() / 2048 * 1.02 + 2
    assert o7.pack(none).count() == 0


def test_encoder_equals_tokenizers():
    e = o7.encoder(o7.default_tokenizer())
    r = np.random.default_rng(3)
    part = ["a", "Ab", " ", "  ", "\n", "\n\n", "'s", "'", "!!", "1", "\t", "\xa0", "é", "中", "<|endoftext|>", "\r\n", "_", "\x85", "\x1c", "don't", "\u0301", "\U0001f600", "\x00"]
    for _ in range(3000):
        s = "".join(r.choice(part, r.integers(0, 14)))
        assert e.encode(s) == np.array(e.tok.encode(s, add_special_tokens=False).ids, "<u4").tobytes()


def test_pack_histogram_places_every_length():
    counts = {2048: 3, 2000: 5, 1024: 7, 100: 50, 48: 9, 1: 4}
    packs = o7.pack_histogram(counts, 2048)
    placed = Counter()
    for n, lengths in packs:
        assert sum(lengths) <= 2048
        for x in lengths:
            placed[x] += n
    assert placed == counts


def test_quality_held_out_and_edges(spark, odd, none):
    sf = "/root/testdata/sf0.1"
    labels = C.read(spark, sf, "labels")
    got = o8.quality(C.read(spark, sf, "documents"), labels).join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out")
    n, right = got.agg(F.count("*"), F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert n > 1000 and right > 0.97
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = o8.quality(C.read(spark, SF, "documents"), labels).collect()
    assert a == o8.quality(C.read(spark, SF, "documents"), flipped).collect()  # held-out labels play no part
    bare = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    out = o8.quality(odd, bare).collect()
    assert len(out) == odd.count() and {r.score for r in out} == {0.5}
    assert {r.score for r in o8.quality(odd, spark.createDataFrame([(i, 0) for i in range(12)], "doc_id long, quality int")).collect()} == {0.0}
    assert all(0 <= r.score <= 1 for r in o8.quality(odd, labels).collect())
    assert o8.quality(none, labels).count() == 0


def test_quality_fit_matches_direct_solve(spark):
    """Weights against numpy's least squares on the whole matrix, calibration against the min-max
    form of isotonic regression, scores against both."""
    labels = C.read(spark, "/root/testdata/sf0.01", "labels")
    f = o8.features_of(C.read(spark, "/root/testdata/sf0.01", "documents"))
    model = o8.fit(f, labels)
    y = {r.doc_id: r.quality for r in labels.where("quality in (0, 1)").collect()}
    rows = [(r.id, np.frombuffer(bytes(r.f), dtype=np.float64), r.cal) for r in
            f.withColumn("cal", F.pmod(F.xxhash64("id"), F.lit(4)) == 0).collect() if r.id in y and zlib.crc32(str(r.id).encode()) % 3 != 1]
    x, t, cal = np.stack([r[1] for r in rows]), np.array([y[r[0]] for r in rows], float), np.array([r[2] for r in rows])
    main = x[~cal]
    scale = main.std(0)
    scale[scale < 1e-9] = 1.0
    assert np.allclose(model.mean, main.mean(0)) and np.allclose(model.scale, scale)
    z, n = o8.rff((main - main.mean(0)) / scale), len(main)
    ridge = np.diag(np.sqrt(np.append(np.full(o8.RFF, o8.RIDGE * n), 0.0) + 1e-9))
    w = np.linalg.lstsq(np.vstack([z, ridge]), np.append(t[~cal], np.zeros(o8.RFF + 1)), rcond=None)[0]
    raw = z @ w
    assert np.allclose(model.raw(main), raw, atol=1e-5)
    k = np.floor((model.raw(x[cal]).clip(o8.LOW, o8.HIGH) - o8.LOW) / (o8.HIGH - o8.LOW) * (o8.BINS - 1)).astype(int)
    bins = sorted(set(k))
    m, ones = np.array([(k == b).sum() for b in bins], float), np.array([t[cal][k == b].sum() for b in bins])
    direct = [max(min(ones[a:b + 1].sum() / m[a:b + 1].sum() for b in range(i, len(bins))) for a in range(i + 1)) for i in range(len(bins))]
    assert np.allclose(model.values, direct)
    want = np.interp(raw, o8.LOW + (np.array(bins) + 0.5) / (o8.BINS - 1) * (o8.HIGH - o8.LOW), direct)
    assert np.allclose(model.score(main), want, atol=1e-2)


def test_isotonic_rises():
    v = o8.isotonic(np.array([1.0, 2, 1, 4]), np.array([1.0, 0, 1, 3]))
    assert (np.diff(v) >= 0).all() and np.allclose(v[:2], 1 / 3)


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/x">menu</a></nav><!-- c -->
<div class="ad">buy</div><article><h1>Head  &amp; line</h1><p><b>Bold<br><p>one\n two&nbsp;x</p><form><input>send</form><div class="comments">me too</div></article>
<aside>side</aside><footer>foot</footer></body></html>"""


def test_html_main_text(spark):
    want = "Head & line\nBold\none two x"
    plain = "<body><div id=nav>m</div><div class='body'><p>long text of the page</p><p>and more</p></div><div>short</div>"
    rows = [(1, "http://a/1", PAGE), (2, "http://a/2", PAGE.replace("one", "uno")), (3, None, None), (4, "", ""), (5, "http://b/", plain), (5, "http://b/", plain),
            (6, "http://c/", "just <i>text"), (7, "http://a/3", "<article>" + "<p>w" * 30_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"id": F.lit(0), "host": F.lit("q")})
    got = {r.id: r for r in o10.extract(df).collect()}
    assert [got[i].text for i in (1, 2, 3, 4, 5, 6)] == [want, want.replace("one", "uno"), "", "", "long text of the page\nand more\nshort", "just text"]
    assert got[7].n_chars == 59_999 and got[1].n_chars == len(want)
    assert o10.extract(df).count() == 8 and o10.extract(df.limit(0)).count() == 0


def test_html_template_classes(spark):
    df = spark.createDataFrame([(i, "http://a/%d" % i, PAGE.replace("</h1>", "</h1>" + "<p>x</p>" * i)) for i in range(5)], "id long, url string, html string")
    src = o2.with_parts(df).withColumn("key", F.xxhash64("id"))
    t = o10.deduce_templates(src).first().template
    once = {x["token"] for x in t if x["once"]}
    assert {"article|/html/body/article", "/article|/html/body/article"} <= once and not any(x["token"].startswith("p|") and x["once"] for x in t)


def test_html_template_decides(spark):
    """Constant texts without a listed class go, in blocks and at block ends; order counts."""
    page = ("<body><div class=x><p>Seen on paper</p></div><div class=y><article><h1>T{0}</h1><p>Story {0} of the day and <i>on</i> it goes <a href=/{0}>read more</a></p>"
            "<p>Next {0}, as <a href=/w>W</a> says</p><p>Read on</p></article></div></body>")
    df = spark.createDataFrame([(i, "http://a/%d" % i, page.format("n%d" % i)) for i in range(6)], "page_id long, url string, html string")
    got = {r.id: r.text for r in o10.extract(df).collect()}
    assert got == {i: "Tn{0}\nStory n{0} of the day and on it goes\nNext n{0}, as W says".format(i) for i in range(6)}
    copies = df.withColumn("html", F.concat(F.lit("<article><p>one and the same long story</p></article>"), F.col("page_id").cast("string")))
    assert {r.text for r in o10.extract(copies).collect()} == {"one and the same long story"}
    assert o10.in_order([0, 5, 1, 2, 4, 3, 6]) in ([0, 2, 3, 4, 6], [0, 2, 3, 5, 6])
    order = {"div|/body/div": 1, "/div|/body/div": 2}
    links = "<body><div><a>one</a> <a>two</a></div><p>words of the page itself</p></body>"
    assert o10.main_text(links, order) == "words of the page itself"


def test_html_slots_are_judged_by_host_figures(spark):
    """No listed word, no article element: the footer and the notices vary by page and go by their
    slot's figures, texts of few kinds by their variation, and a sub-slot of the main one stays."""
    page = ("<body><div class=q1><a href=/{0}>go {0}</a> <a href=/b{0}>b{0}</a></div><div class=q2><p>Today {0} of note</p></div>"
            "<div class=q3><h1>Head {0}</h1><div class=q4><p>Lead {0}</p></div>{1}</div><div class=q5><p>{2}</p></div><div class=q6>Made {0} by hand</div></body>")
    words = [("<p>%s</p>" % ("story%d goes on " % i * 60).strip()) for i in range(8)]
    rotating = ["kind %s " % "ab"[i % 2] * 40 for i in range(8)]
    df = spark.createDataFrame([(i, "http://a/%d" % i, page.format("n%d" % i, words[i], rotating[i])) for i in range(8)], "page_id long, url string, html string")
    want = {i: f"Head n{i}\nLead n{i}\n{words[i][3:-4]}" for i in range(8)}
    for lists in (True, False):
        assert {r.id: r.text for r in o10.extract(df, lists=lists).collect()} == want
    assert all("by hand" in r.text for r in o10.extract(df, template=False).collect())
    few = df.where(f"page_id < {o10.SLOT_PAGES - 1}")
    assert all("by hand" in r.text for r in o10.extract(few).collect())
    assert o10.extract(df.withColumn("html", F.lit("<p>" + "t" * 2_000_000))).first().n_chars == 2_000_000


def test_html_classes_match_direct_count(spark):
    """Vectors, supports and order of the template's tokens against a count page by page."""
    pages = C.read(spark, "/root/testdata/sf0.001", "pages")
    src = o2.with_parts(pages).withColumn("key", F.xxhash64("html"))
    got = {r.host: {(x.token, x.once) for x in r.template} for r in o10.deduce_templates(src).collect()}
    per = defaultdict(dict)
    for r in src.select("host", "key", "html").collect():
        per[r.host][r.key] = {t: n for t, (n, _) in o10.page_tokens(r.html or "").items()}
    want = {}
    for host, by_page in per.items():
        vectors = defaultdict(set)
        for t in {t for p in by_page.values() for t in p}:
            vectors[tuple((k, p[t]) for k, p in sorted(by_page.items()) if t in p)].add(t)
        keep = set()
        for v, ts in vectors.items():
            if len(v) >= max(2, o10.SHARE * len(by_page)) and sum(2 if t.startswith("#") else 1 for t in ts) > 1:
                keep |= {(t, max(n for _, n in v) == 1) for t in ts if not t.startswith("#") or len(v) >= o10.TEXT_PAGES}
        if keep:
            want[host] = keep
    assert got == want and len(want) > 1


def test_html_keeps_every_depth(spark):
    """Pages of other shapes: article elements that hold little, titles and introductions above the longest slot."""
    long = "<p>%s</p>" % ("long words " * 20).strip()
    body = [
        ("<body><h1>Title</h1><div><p>text</p></div></body>", "Title\ntext"),
        ("<body><div><p>An introduction</p><div>%s</div><p>The end</p></div></body>" % long, "An introduction\n%s\nThe end" % ("long words " * 20).strip()),
        ("<body><article></article><div>%s</div></body>" % long, ("long words " * 20).strip()),
        ("<body><article><p>Teaser</p></article><div>%s</div></body>" % long, "Teaser\n" + ("long words " * 20).strip()),
        ("<body><p>odd</p><main>%s</main></body>" % long, ("long words " * 20).strip()),
        ("<body><nav>menu</nav><main></main></body>", "")]
    df = spark.createDataFrame([(i, "http://h%d/" % i, h) for i, (h, _) in enumerate(body)], "page_id long, url string, html string")
    assert {r.id: r.text for r in o10.extract(df).collect()} == {i: t for i, (_, t) in enumerate(body)}
    same = spark.createDataFrame([(10 * i + j, "http://h%d/%d" % (i, j), h.replace("text", "text %d" % j).replace("long", "long%d" % j))
                                  for i, (h, _) in enumerate(body[:3]) for j in range(2)], "page_id long, url string, html string")
    got = {r.id: r.text for r in o10.extract(same).collect()}
    assert got == {10 * i + j: t.replace("text", "text %d" % j).replace("long", "long%d" % j) for i, (_, t) in enumerate(body[:3]) for j in range(2)}


def test_components_and_ranks(spark):
    r = np.random.default_rng(1)
    e = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(500, 560)]
    got = {x.id: x.component for x in C.components(spark.createDataFrame(e, "a long, b long")).collect()}
    links = defaultdict(list)
    for a, b in e:
        links[a].append(b)
        links[b].append(a)
    assert got == {i: min(_reach(links, i)) for i in links if _reach(links, i) != {i}}
    df = C.stored(spark.createDataFrame([(None if i % 3 else 1, i) for i in range(100)], "k int, v int"), "t")
    out = C.rank_within(df, ["k"], F.col("v") / F.lit(100.0), [F.col("v")], rows=7).toPandas()
    assert all(sorted(g["rank"]) == list(range(len(g))) and g.sort_values("v")["rank"].is_monotonic_increasing for _, g in out.groupby("k", dropna=False))


def test_pipeline(spark, odd):
    docs = C.read(spark, SF, "documents")
    cols, out = docs.columns, docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = C.stored(stage(spark, out, SF), "t-pipe")
        assert out.columns == cols or i == 4
    assert out.count() > 0 and "pipeline" in queries.queries()
    # stages keep columns and rows on odd documents
    kept = corpus_pipeline.near_duplicates(spark, odd, SF)
    links = _links([r.text for r in odd.collect()])
    rows = odd.collect()
    groups = {frozenset(_reach(links, i)) for i in range(len(rows)) if WORDS.findall(rows[i].text or "")}
    assert kept.where("length(trim(text)) > 0 and text rlike '[^\\\\s]'").count() == len(groups) and kept.columns == odd.columns
    cut = corpus_pipeline.repeated_strings(spark, odd, SF)
    assert cut.count() == odd.count() and cut.columns == odd.columns
    assert corpus_pipeline.source_mix(spark, odd, SF).columns == odd.columns and corpus_pipeline.packing(spark, odd, SF).count() > 0
    assert corpus_pipeline.quality(spark, odd, SF).columns == odd.columns
