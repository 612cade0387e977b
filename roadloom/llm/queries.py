"""The operators applied to their whole tables, by query name, and their SQL where there is one."""

from __future__ import annotations

from roadloom.llm import exact_dedup, html_extract, language_id, language_model, lattice, line_dedup, merkle, mixing, packing, quality, secret_scan, simhash, token_alignment

QUERIES = {
    "op1_pfair_mixing": mixing.query,
    "op2_kneser_ney": language_model.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_line_dedup": line_dedup.query,
    "op5_quality_vote": quality.query,
    "op6_simhash": simhash.query,
    "op7_packing": packing.query,
    "op8_secret_scan": secret_scan.query,
    "op9_html_extract": html_extract.query,
    "op10_lattice_dedup": lattice.query,
    "op11_merkle_manifest": merkle.query,
    "op12_token_alignment": token_alignment.query,
    "op13_language_id": language_id.query,
}

SQL = {
    "op1_pfair_mixing": mixing.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op11_merkle_manifest": merkle.SQL,
}
