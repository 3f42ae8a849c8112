"""The queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import bpe, decontaminate, exact_dedup, html_text, near_dedup, pii, quality, token_counts, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": bpe.op1_bpe,
        "op2_page_text": html_text.op2_page_text,
        "op3_warc": warc.op3_warc,
        "op4_token_counts": token_counts.op4_token_counts,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_pii": pii.op6_pii,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_quality": quality.op9_quality,
        "op10_near_dedup": near_dedup.op10_near_dedup,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": exact_dedup.ORACLE_SQL}
