"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_itq_neardup, op2_url_filter, op3_mixing, op4_adaptive_scan, op5_warc_zstd, op6_ngram_join, op7_packing,
    op8_quality_rff, op9_suffix_dedup, op10_html_template, op11_merkle,
    op12_label_shards, op13_hard_negatives,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_itq_neardup": op1_itq_neardup.op1_itq_neardup,
        "op2_url_filter": op2_url_filter.op2_url_filter,
        "op3_mixing": op3_mixing.op3_mixing,
        "op4_adaptive_scan": op4_adaptive_scan.op4_adaptive_scan,
        "op5_warc_zstd": op5_warc_zstd.op5_warc_zstd,
        "op6_ngram_join": op6_ngram_join.op6_ngram_join,
        "op7_packing": op7_packing.op7_packing,
        "op8_quality_rff": op8_quality_rff.op8_quality_rff,
        "op9_suffix_dedup": op9_suffix_dedup.op9_suffix_dedup,
        "op10_html_template": op10_html_template.op10_html_template,
        "op11_merkle": op11_merkle.op11_merkle,
        "op12_label_shards": op12_label_shards.op12_label_shards,
        "op13_hard_negatives": op13_hard_negatives.op13_hard_negatives,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = {"op3_mixing": op3_mixing.SQL, "op5_warc_zstd": op5_warc_zstd.SQL, "op11_merkle": op11_merkle.SQL, "op13_hard_negatives": op13_hard_negatives.SQL,
           "pipeline": corpus_pipeline.ORACLE_SQL}
    return {k: v for k, v in out.items() if v}
