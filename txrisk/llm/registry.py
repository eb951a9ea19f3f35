"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from txrisk.llm import decontaminate, html_text, language, line_dedup, minhash, passages, quality, runs, spelling, token_counts, toxicity
from txrisk.llm.packing import op10_best_fit_packing
from txrisk.llm.token_files import op8_token_files

QUERIES = {
    "op1_html_extraction": html_text.op1_html_extraction,
    "op2_benchmark_decontamination": decontaminate.op2_benchmark_decontamination,
    "op3_minhash_near_dedup": minhash.op3_minhash_near_dedup,
    "op8_token_files": op8_token_files,
    "op4_language_id": language.op4_language_id,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_repeated_passages": passages.op7_repeated_passages,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_periodic_runs": runs.op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op3_minhash_near_dedup": minhash.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
}
