"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lexflume.llm import exact_topk, html_text, line_dedup, lm_score, minhash, mixing, packing, quality_classifier, quality_rules, secret_scan


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": quality_classifier.op1_quality_classifier,
        "op2_exact_topk": exact_topk.op2_exact_topk,
        "op3_secret_scan": secret_scan.op3_secret_scan,
        "op4_mixing": mixing.op4_mixing,
        "op5_quality_rules": quality_rules.op5_quality_rules,
        "op6_lm_score": lm_score.op6_lm_score,
        "op7_packing": packing.op7_packing,
        "op8_minhash": minhash.op8_minhash,
        "op9_html": html_text.op9_html,
        "op10_line_dedup": line_dedup.op10_line_dedup,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op2_exact_topk": exact_topk.OP2_SQL}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
