"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quarrylight.llm import (
    decontaminate, jaccard_join, licences, line_dedup, packing, periodic_runs, pseudonyms, quality, repeated_bytes,
    secret_scan, simplex_clusters, suffix_tree_lm, warc_store,
)

QUERIES = {
    "op1_licence_scan": licences.query,
    "op2_secret_scan": secret_scan.query,
    "op3_quality_rules": quality.query,
    "op4_repeated_bytes": repeated_bytes.query,
    "op5_line_dedup": line_dedup.query,
    "op6_benchmark_decontamination": decontaminate.query,
    "op7_jaccard_join": jaccard_join.query,
    "op8_warc_store": warc_store.query,
    "op9_pseudonyms": pseudonyms.query,
    "op10_best_fit_packing": packing.query,
    "op11_simplex_clusters": simplex_clusters.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_suffix_tree_lm": suffix_tree_lm.query,
}

SQL = {
    "op1_licence_scan": licences.SQL,
    "op2_secret_scan": secret_scan.SQL,
    "op3_quality_rules": quality.SQL,
    "op6_benchmark_decontamination": decontaminate.SQL,
    "op8_warc_store": warc_store.SQL,
    "op11_simplex_clusters": simplex_clusters.SQL,
}
