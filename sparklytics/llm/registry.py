"""Registered queries of this subpackage and the pipeline, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import (
    op1_ppm,
    op2_packing,
    op3_toxicity,
    op4_line_dedup,
    op5_exact_dedup,
    op6_pieces,
    op7_fingerprints,
    op8_substrings,
    op9_quality,
    op10_jaccard,
    op11_ranked,
    op12_alignment,
    op13_simhash,
)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_ppm": op1_ppm.op1_ppm,
    "op2_packing": op2_packing.op2_packing,
    "op3_toxicity": op3_toxicity.op3_toxicity,
    "op4_line_dedup": op4_line_dedup.op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup.op5_exact_dedup,
    "op6_pieces": op6_pieces.op6_pieces,
    "op7_fingerprints": op7_fingerprints.op7_fingerprints,
    "op8_substrings": op8_substrings.op8_substrings,
    "op9_quality": op9_quality.op9_quality,
    "op10_jaccard": op10_jaccard.op10_jaccard,
    "op11_ranked": op11_ranked.op11_ranked,
    "op12_alignment": op12_alignment.op12_alignment,
    "op13_simhash": op13_simhash.op13_simhash,
}

ORACLE = {
    "op4_line_dedup": op4_line_dedup.ORACLE_SQL,
    "op5_exact_dedup": op5_exact_dedup.ORACLE_SQL,
    "op8_substrings": op8_substrings.ORACLE_SQL,
    "op10_jaccard": op10_jaccard.ORACLE_SQL,
    "op11_ranked": op11_ranked.ORACLE_SQL,
}
