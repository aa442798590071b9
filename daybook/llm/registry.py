"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from daybook.llm import bpe, decontaminate, divergence, extract, katz, langid, license_scan, merkle, perplexity, quality_rules, simhash, suffix_dedup, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_extract": extract.op1,
        "op2_katz": katz.op2,
        "op3_quality_rules": quality_rules.op3,
        "op4_decontaminate": decontaminate.op4,
        "op5_perplexity": perplexity.op5,
        "op6_url_filter": url_filter.op6,
        "op7_simhash": simhash.op7,
        "op8_bpe": bpe.op8,
        "op9_langid": langid.op9,
        "op10_license_scan": license_scan.op10,
        "op11_merkle": merkle.op11,
        "op12_divergence": divergence.op12,
        "op13_suffix_dedup": suffix_dedup.op13,
    }


def oracle_sql() -> dict[str, str]:
    sql = {
        "pipeline": corpus_pipeline.ORACLE_SQL,
        "op6_url_filter": url_filter.OP6_SQL,
        "op11_merkle": merkle.OP11_SQL,
        "op12_divergence": divergence.OP12_SQL,
        "op13_suffix_dedup": suffix_dedup.OP13_SQL,
    }
    return {k: v for k, v in sql.items() if v is not None}
