"""The corpus queries by name, and their SQL where there is one."""

from __future__ import annotations

from tessera.llm import fingerprints, langid, licenses, line_dedup, media, mixing, ngram_join, packing, substring_dedup, wavelet

QUERIES = {
    "op1_media_columns": media.op1_media_columns,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_wavelet_tokens": wavelet.op4_wavelet_tokens,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_ngram_jaccard_join": ngram_join.op7_ngram_jaccard_join,
    "op8_document_fingerprints": fingerprints.op8_document_fingerprints,
    "op9_source_mixing": mixing.op9_source_mixing,
    "op10_license_scan": licenses.op10_license_scan,
}

ORACLE_SQL = {
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op10_license_scan": licenses.OP10_SQL,
}
