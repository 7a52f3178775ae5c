"""Corpus pipeline: quality classifier, near duplicates, repeated strings, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns documents with the same columns (the last one the packed pieces).  For every stage an
empty table gives no rows, and columns beyond those it names are carried along; columns whose
names begin with two underscores are the stages' own and may not be in ``docs``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rewardframe.llm import common as C  # noqa: E402
from rewardframe.llm import op3_mixing, op6_ngram_join, op7_packing, op8_quality_rff, op9_suffix_dedup  # noqa: E402


#: Fewest words of a repeated passage that goes.
PASSAGE_WORDS = 51


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5 go.  Null and empty texts are scored like others;
    repeated rows and null ids are judged each by its text."""
    return op8_quality_rff.good_documents(docs, C.read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id stays.  Of repeated rows (one
    id, one text) one stays; a null id stands for its text's hash; null and empty texts have
    no shingles, link with nothing and stay."""
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    kept = op6_ngram_join.ngram_join(docs).where("kept")
    one = kept.groupBy("id", "class_key").agg(F.min("text_key").alias("text_key"))
    one = one.select(F.coalesce("id", "text_key").alias("__rid"), F.col("text_key").alias("__key"))
    rows = docs.withColumns({"__rid": F.coalesce(F.col("doc_id").cast("long"), key), "__key": key})
    return rows.join(one, ["__rid", "__key"], "left_semi").dropDuplicates(["__rid", "__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes and passages of over 50 words (of any length) that repeat are
    cut out of the texts.  Every row stays, with what is left of its text (null becomes empty);
    characters cut in two go; repeated rows are different documents, so long ones empty."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = op9_suffix_dedup.suffix_dedup(docs, carry=rest, words=PASSAGE_WORDS)
    new = {"doc_id": F.col("id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text"),
           "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    return out.select(*[new.get(c, F.col(f"`x_{c}`")).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their targets: a row each time a document is taken.  A null source
    is a source; texts without words are never taken; the last text of a source is cut."""
    out = op3_mixing.mixed_documents(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces packed into sequences.  Null and empty texts are one end token; repeated rows
    are packed each."""
    return op7_packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings),
    ("source_mix", source_mix), ("packing", packing)]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written and read again."""
    docs = C.read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = C.stored(docs, f"pipeline-{name}")
    return docs
