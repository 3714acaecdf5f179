"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import bpe, embedding_dedup, exact_dedup, html_extract, importance, packing, pii, quality, simhash, substring_dedup, suffix_dedup, toxicity, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [suffix_dedup.op1_suffix_dedup, toxicity.op2_toxicity, packing.op3_packing,
             embedding_dedup.op4_embedding_dedup, exact_dedup.op5_exact_dedup, quality.op6_quality,
             html_extract.op7_html_extract, simhash.op8_simhash_dedup, bpe.op9_bpe,
             substring_dedup.op10_substring_dedup, pii.op11_pii, importance.op12_importance_resampling,
             vector_codes.op13_vector_codes]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": exact_dedup.ORACLE_SQL, "op12_importance_resampling": importance.ORACLE_SQL,
            "op13_vector_codes": vector_codes.ORACLE_SQL}
