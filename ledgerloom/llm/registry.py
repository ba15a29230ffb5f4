"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from ledgerloom.llm.decontaminate import OP10_SQL, op10_benchmark_decontamination
from ledgerloom.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from ledgerloom.llm.extraction import op6_html_extraction
from ledgerloom.llm.language import op8_language_id
from ledgerloom.llm.licenses import op5_license_scan
from ledgerloom.llm.line_dedup import OP11_SQL, op11_line_dedup
from ledgerloom.llm.near_dedup import op1_minhash_near_dedup
from ledgerloom.llm.packing import op2_best_fit_packing
from ledgerloom.llm.periodic_runs import op13_periodic_runs
from ledgerloom.llm.preferences import OP9_SQL, op9_preference_formatting
from ledgerloom.llm.quality import op3_quality_classifier
from ledgerloom.llm.suffix_dedup import op7_suffix_array_dedup
from ledgerloom.llm.token_alignment import op12_cross_tokenizer_alignment

QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_html_extraction": op6_html_extraction,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_language_id": op8_language_id,
    "op9_preference_formatting": op9_preference_formatting,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_line_dedup": op11_line_dedup,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL = {
    "op4_exact_dedup": OP4_SQL,
    "op9_preference_formatting": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_line_dedup": OP11_SQL,
}
