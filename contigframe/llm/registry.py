"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from contigframe.llm import exact_dedup, html_extract, jaccard_join, language_id, licenses, media, mixing, packing, pii, source_divergence, token_store, toxicity, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack": packing.op1_pack,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_licenses": licenses.op3_licenses,
        "op4_language": language_id.op4_language,
        "op5_near_duplicates": jaccard_join.op5_near_duplicates,
        "op6_token_store": token_store.op6_token_store,
        "op7_pii": pii.op7_pii,
        "op8_media": media.op8_media,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_mix": mixing.op10_mix,
        "op11_source_divergence": source_divergence.op11_source_divergence,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_main_text": html_extract.op13_main_text,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, "op11_source_divergence": source_divergence.ORACLE, "op12_vector_codes": vector_codes.ORACLE} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
