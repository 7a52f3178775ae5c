"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
then up to ``?``, ``#`` or the end.  A rule (verdict, host, path) fits its host and all
subdomains if the url's path starts with the rule's; the longest rule wins.  A url no
rule fits gets the verdict of a model: n-grams of 3 and 4 characters of host and path,
hashed to 2**14 counts, logistic regression with an L2 penalty.  It is trained from a
small labelled url table, at most ``label_rows`` rows of it (those of smallest hash).

Everything is DataFrame and Spark ML operations; scoring needs no shuffle.
Defined cases: a null url, or one without ``://``, has an empty host and path (the model
judges it); an empty path fits no rule path that begins with ``/``; repeated rows are
judged alike; a labelled table of one verdict gives that verdict, an empty one
``allow``; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: The contract's rules: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Fixed values of the labelled url table: parts of host names and page names.
SPAM_PARTS = ("casino bets bet poker slots jackpot bingo lottery pills viagra pharma rx porn xxx cams escort payday loans cash "
              "crack serial keygen warez torrent replica spam farm prize win winner bonus hack cheat dating miracle ads adult tracker clickbait popup").split()
PLAIN_PARTS = ("library school college museum journal garden weather recipes council health travel music history science sport books "
               "theatre archive market city village bank church doctor kitchen letters maths nature ocean paper radio river "
               "street studio village water window writing").split()
#: Parts that stand in names of both kinds.
SHARED_PARTS = "best free online top new my the easy live daily world central home zone hub 24".split()
#: Sounds of invented names.
SOUNDS = "th he an re er in on at nd st es en ti ha or tion ing ble ly ther sh wh ed ou la ne mi ro ka su".split()
SUBDOMAINS, DOMAINS, LANGUAGES = ("", "www.", "m.", "blog."), ("example.com", "example.net", "example.org"), ("en", "es", "fr", "de")
TAILS = (".html", "/", "", "?page=2&ref=x", "#top")
FEATURES = 1 << 14
LABEL_ROWS = 20_000


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    rest = F.coalesce(F.expr(f"CASE WHEN locate('://', `{url_col}`) > 0 THEN substring(`{url_col}`, locate('://', `{url_col}`) + 3) ELSE '' END"), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1))


def with_rule(df: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add ``rule`` and ``by_rule`` (its verdict) of the longest rule that fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("by_rule", verdict)


def grams(col: str, mark: str, sizes: tuple[int, ...] = (3, 4)) -> F.Column:
    """Character n-grams of a column with its ends marked."""
    s = F.concat(F.lit("^"), F.col(col), F.lit("$"))
    c = F.split(s, "")
    parts = []
    for n in sizes:
        g = F.transform(F.slice(c, F.lit(1), F.greatest(F.size(c) - (n - 1), F.lit(0))), lambda x: F.concat(F.lit(mark), x))
        for k in range(1, n):  # linear in the text: neighbours are zipped, not cut out again
            g = F.zip_with(g, F.slice(c, F.lit(k + 1), F.greatest(F.size(c) - (n - 1), F.lit(0))), lambda x, y: F.concat(x, y))
        parts.append(F.when(F.size(c) >= n, g).otherwise(F.array(F.concat(F.lit(mark), s))))
    return F.concat(*parts)


def _features(df: DataFrame) -> DataFrame:
    df = df.withColumn("_grams", F.concat(grams("host", "h"), grams("path", "p")))
    return HashingTF(inputCol="_grams", outputCol="_x", numFeatures=FEATURES).transform(df).drop("_grams")


def _names() -> list[tuple[str, str]]:
    """(name, verdict): two parts of one kind, a part of one kind beside a shared one, and
    invented names, which are plain."""
    out = []
    for verdict, parts in (("block", SPAM_PARTS), ("allow", PLAIN_PARTS)):
        for i, a in enumerate(parts):
            out += [(a + ("-" if k % 2 else "") + parts[(i + k) % len(parts)], verdict) for k in range(1, 15)]
            for k in range(8):
                b = SHARED_PARTS[(5 * i + 3 * k) % len(SHARED_PARTS)]
                out.append((f"{b}-{a}" if k % 2 else a + b, verdict))
    n = len(SOUNDS)
    out += [(SOUNDS[i % n] + SOUNDS[(7 * i + i // n) % n] + (SOUNDS[(3 * i + i // 7) % n] if i % 2 else ""), "allow") for i in range(24 * n)]
    return list(dict(out).items())


def label_table(spark: SparkSession, per_name: int = 4) -> DataFrame:
    """The labelled urls: url, verdict, name.  No rule is asked.  Names of both kinds get the
    same subdomains, domains, languages, numbers and tails, so only the name tells; each
    fourth url bears it in its path, on a host of an invented name."""
    rows = []
    for i, (name, verdict) in enumerate(_names()):
        for k in range(per_name):
            j = i * 31 + k * 17
            host, page = (name, str(1 + j * 7919 % 9973)) if k % 4 != 3 else (SOUNDS[j % len(SOUNDS)] + SOUNDS[j // 5 % len(SOUNDS)], name)
            rows.append((f"{('https', 'http')[j // 2 % 2]}://{SUBDOMAINS[j % 4]}{host}.{DOMAINS[j // 3 % 3]}/{LANGUAGES[j // 7 % 4]}/{page}{TAILS[j // 11 % 5]}", verdict, name))
    return spark.createDataFrame(rows, "url string, verdict string, name string")


def fit(labelled: DataFrame, label_rows: int = LABEL_ROWS):
    """Model from (host, path, verdict), or the one verdict there is (``allow`` if none)."""
    few = labelled.select("host", "path", "verdict").orderBy(F.xxhash64("host", "path"), "host", "path", "verdict").limit(label_rows)
    few = C.stored(few, "op2-labels")
    seen = [r.verdict for r in few.select("verdict").distinct().collect()]
    if len(seen) < 2:
        return seen[0] if seen else "allow"
    train = _features(few.withColumn("_y", (F.col("verdict") == "block").cast("double"))).select("_x", "_y")
    return LogisticRegression(featuresCol="_x", labelCol="_y", regParam=1e-3, maxIter=60, standardization=False, probabilityCol="_p",
                              rawPredictionCol="_raw", predictionCol="_yes").fit(train)


def url_filter(pages: DataFrame, labelled: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES,
               id_col: str = "page_id", url_col: str = "url", label_rows: int = LABEL_ROWS) -> DataFrame:
    """id, host, path, rule, verdict, block_probability (null where a rule decides).
    ``labelled`` has url and verdict; by default ``label_table``."""
    src = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    judged = with_rule(with_parts(src), rules)
    if labelled is None:
        labelled = label_table(pages.sparkSession)
    table = with_parts(labelled.select("url", "verdict")).where("verdict in ('allow', 'block')")
    model = fit(table, label_rows)
    if isinstance(model, str):
        p = F.lit(1.0 if model == "block" else 0.0)
        scored = judged
    else:
        scored = model.transform(_features(judged))
        p = vector_to_array(F.col("_p"))[1]
    return scored.withColumn("block_probability", F.when(F.col("rule").isNull(), p)).select(
        "id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_probability")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: verdict on the url of every page."""
    return url_filter(C.read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
