"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from landfall.llm import alignment, exact, near, packing, passages, pieces, prefixes, quality, sketches, toxicity, tries, urls, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_packing": packing.op1,
        "op2_warc": warc.op2,
        "op3_quality": quality.op3,
        "op4_bottom_k": sketches.op4,
        "op5_prefix_counts": prefixes.op5,
        "op6_sentencepiece": pieces.op6,
        "op7_near_dedup": near.op7,
        "op8_exact_dedup": exact.op8,
        "op9_passages": passages.op9,
        "op10_url_filters": urls.op10,
        "op11_toxicity": toxicity.op11,
        "op12_alignment": alignment.op12,
        "op13_tries": tries.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.OP2_SQL,
        "op8_exact_dedup": exact.OP8_SQL,
        "op13_tries": tries.OP13_SQL,
    }
