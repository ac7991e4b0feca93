"""Registered queries of the operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from . import (decontamination, embeddings, language, layout, licenses, lines, manifest, mixing, negatives, quality, secrets,
               simhash, warc)

QUERIES = {
    "op1_quality_classifier": quality.query,
    "op2_license_scan": licenses.query,
    "op3_warc_revisits": warc.query,
    "op4_html_layout": layout.query,
    "op5_secret_scan": secrets.query,
    "op6_benchmark_decontamination": decontamination.query,
    "op7_line_dedup": lines.query,
    "op8_source_mixing": mixing.query,
    "op9_simhash_near_dedup": simhash.query,
    "op10_embedding_near_dedup": embeddings.query,
    "op11_hard_negatives": negatives.query,
    "op12_language_id": language.query,
    "op13_merkle_manifest": manifest.query,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": licenses.ORACLE_SQL,
    "op3_warc_revisits": warc.ORACLE_SQL,
    "op7_line_dedup": lines.ORACLE_SQL,
    "op11_hard_negatives": negatives.ORACLE_SQL,
    "op13_merkle_manifest": manifest.ORACLE_SQL,
}
