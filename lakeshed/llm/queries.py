"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshed.llm import decontamination, kneser_ney, language_id, media, merkle, mixing, ngram_join, quality, ranked_search, secrets, sharding, token_counts, url_filters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_mixing": mixing.op2_mixing,
        "op3_lm_scoring": kneser_ney.op3_lm_scoring,
        "op4_decontamination": decontamination.op4_decontamination,
        "op5_secret_scan": secrets.op5_secret_scan,
        "op6_sharding": sharding.op6_sharding,
        "op7_language_id": language_id.op7_language_id,
        "op8_media_columns": media.op8_media_columns,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_token_counts": token_counts.op10_token_counts,
        "op11_ranked_search": ranked_search.op11_ranked_search,
        "op12_url_filters": url_filters.op12_url_filters,
        "op13_merkle_manifest": merkle.op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": mixing.ORACLE, "op5_secret_scan": secrets.ORACLE, "op11_ranked_search": ranked_search.ORACLE, "op12_url_filters": url_filters.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
