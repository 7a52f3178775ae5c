"""Mixing sources to target weights.

Sizes are counts of ``[^\\x20\\x09-\\x0D]+``.  Sources in code-point order (null last) weigh
3, 1, 2, repeating, and share 1.5 times all words; no target exceeds twice its source, the
excess going to the others by weight.  That level has a closed form: in order of limit
/ weight the capped sources are a prefix, and the largest level over all prefixes is it.

Each document gets a hash-random key (md5 of its id and its text's md5).  Within its source the mix takes
documents in key order up to the target, epoch after epoch; the running word count is a
distributed prefix sum (key ranges are summed first, then each range by itself), so a
source with most rows is never sorted in one task.  The last document is cut at the
exact word, so a source's taken words are its target rounded.

Defined cases: null text has size 0 and is taken with 0 words; a source without words has
target 0; null ids hash as the empty string, so rows without an id spread by their texts; repeated rows are taken one after the
other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import common as C

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target from (source, source_size); one row per source, so the
    windows over all sources stay small."""
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (place % len(weights) + 1).cast("int"))
    t = sources.withColumn("w", w).withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("w"))
    by = W.orderBy("ratio", F.asc_nulls_last("source"))
    t = t.withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("rest", F.sum("w").over(by.rowsBetween(0, W.unboundedFollowing))) \
        .withColumn("total", F.sum("source_size").over(W.partitionBy()) * F.lit(share))
    t = t.withColumn("level", (F.col("total") - F.col("before")) / F.col("rest"))
    # words given out as a function of the level are concave, so each guess is at most right
    level = F.max("level").over(W.partitionBy())
    return t.withColumn("level", F.coalesce(level, F.lit(0.0))).select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: float = SHARE, most: int = MOST, rows: int = 20_000, extra: dict[str, F.Column] | None = None) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken."""
    # the text's digest spreads rows whose ids are null or repeat
    key = F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")),
                            F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))))
    sized = C.stored(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                                 word_count(F.col(f"`{text_col}`").cast("string")).alias("size"), key.alias("key"),
                                 *[c.alias(n) for n, c in (extra or {}).items()]), "op3-sizes")
    plan = C.stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "op3-targets")
    u = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    ranked = C.rank_within(sized, ["source"], u, [F.col("key"), F.col("id"), F.col("size")], rows, "size", "before")
    out = ranked.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select("d.*", "p.source_size", "p.target")
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(rest - F.col("before"), F.col("size")))
    return out.withColumn("taken", (epochs * F.col("size") + part).cast("long")).drop("before", "key")


def _cut_fn(text_col: str):
    def fn(batches):
        for b in batches:
            take = b.column("__take").to_pylist()
            col = b.column(text_col)
            if any(t is not None for t in take):
                out = []
                for s, t in zip(col.to_pylist(), take):
                    if t is not None:
                        data, off = C.text_buffer(pa.array([s]))
                        end = C.word_spans(data[off[0]: off[1]], off - off[0])[1][t - 1]
                        s = data[off[0]: off[0] + end].tobytes().decode()
                    out.append(s)
                col = pa.array(out, pa.string())
            names = [n for n in b.schema.names if n != "__take"]
            yield pa.RecordBatch.from_arrays([col if n == text_col else b.column(n) for n in names], names=names)
    return fn


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is
    taken, its text cut where its source's budget ends."""
    text_key = F.xxhash64(F.col(f"`{text_col}`"))
    taken = mix(docs, id_col, text_col, extra={"text_key": text_key}, **kw).where("taken > 0")
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = taken.withColumn("_n", F.explode(F.sequence(F.lit(1), times)))
    taken = taken.withColumn("__take", F.when((F.col("_n") == times) & (F.col("taken") % F.col("size") > 0), (F.col("taken") % F.col("size")).cast("int")))
    rid = F.coalesce(F.col(f"`{id_col}`").cast("long"), text_key)
    # repeated rows are one text here: each use is a row of ``taken``
    one = docs.withColumns({"__rid": rid, "__key": text_key}).dropDuplicates(["__rid", "__key"])
    use = taken.select(F.coalesce("id", "text_key").alias("__rid"), F.col("text_key").alias("__key"), "__take")
    names = docs.columns
    return one.join(use, ["__rid", "__key"]).select(*[F.col(f"`{c}`") for c in names], "__take").mapInArrow(_cut_fn(text_col), docs.schema)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents mixed to the contract's targets."""
    return mix(C.read(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT), 0) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS k FROM documents),
     s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
     w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM s),
     r AS (SELECT *, 2 * source_size AS cap, CAST(2 * source_size AS DOUBLE) / w AS ratio, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS total FROM w),
     l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
     t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * coalesce((SELECT max(level) FROM l), 0)) AS target FROM l),
     b AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM t),
     p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
                  CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS epochs,
                  CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS seen
           FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(budget - epochs * source_size - seen, size)) AS BIGINT) AS taken
FROM p"""
