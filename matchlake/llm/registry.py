"""Queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from matchlake.llm import (
    cover_search,
    decontamination,
    hard_negatives,
    jaccard_join,
    language,
    licenses,
    mixing,
    ngram_model,
    periodic_runs,
    pseudonyms,
    quality_rules,
    secret_scan,
    substring_dedup,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_identify_language": language.op1_identify_language,
        "op2_remove_repeats": substring_dedup.op2_remove_repeats,
        "op3_scan_secrets": secret_scan.op3_scan_secrets,
        "op4_score_texts": ngram_model.op4_score_texts,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_decontaminate": decontamination.op6_decontaminate,
        "op7_near_duplicates": jaccard_join.op7_near_duplicates,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_scan_licences": licenses.op9_scan_licences,
        "op10_pseudonymise": pseudonyms.op10_pseudonymise,
        "op11_find_runs": periodic_runs.op11_find_runs,
        "op12_mine_negatives": hard_negatives.op12_mine_negatives,
        "op13_search_vectors": cover_search.op13_search_vectors,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": mixing.OP5_SQL, "op12_mine_negatives": hard_negatives.OP12_SQL, "op13_search_vectors": cover_search.OP13_SQL}
