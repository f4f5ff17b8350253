"""The training-data queries, by name, and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import audit, decontam, langid, licenses, linededup, lm, neardup, packing, periodic, quality, suffix, tokencount, warc

QUERIES = {
    "op1_warc": warc.query,
    "op2_benchmark_decontamination": decontam.query,
    "op3_token_counts": tokencount.query,
    "op4_suffix_array_dedup": suffix.query,
    "op5_packing": packing.query,
    "op6_minhash_near_dedup": neardup.query,
    "op7_language_id": langid.query,
    "op8_lm_scoring": lm.query,
    "op9_quality_rules": quality.query,
    "op10_license_scan": licenses.query,
    "op11_periodic_runs": periodic.query,
    "op12_filter_audit": audit.query,
    "op13_line_dedup": linededup.query,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_warc": warc.SQL,
    "op9_quality_rules": quality.SQL,
    "op12_filter_audit": audit.SQL,
    "op13_line_dedup": linededup.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
