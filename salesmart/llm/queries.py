"""Registered queries of the subpackage: opN_<name> -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where there is any."""

from __future__ import annotations

from salesmart.llm import (best_fit_packing, exact_dedup, filter_audit, fingerprints, jaccard_join, language_crf, lattice_lm, license_scan,
                           line_dedup, mixing, ns_kmeans, pii, quality_fm)

_MODULES = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_line_dedup": line_dedup,
    "op3_language_id": language_crf,
    "op4_pii": pii,
    "op5_fingerprints": fingerprints,
    "op6_ngram_jaccard_join": jaccard_join,
    "op7_lm_scoring": lattice_lm,
    "op8_quality_classifier": quality_fm,
    "op9_mixing": mixing,
    "op10_exact_dedup": exact_dedup,
    "op11_centroid_clustering": ns_kmeans,
    "op12_license_scan": license_scan,
    "op13_filter_audit": filter_audit,
}


def queries():
    return {name: module.query for name, module in _MODULES.items()}


def oracle_sql():
    return {name: module.ORACLE for name, module in _MODULES.items() if module.ORACLE}
