"""The queries of this subpackage and their SQL."""

from . import bagminhash, bpe_count, contamination, exact_stream, language, line_runs, mincut_html, mixing, suffix_runs, token_orc

QUERIES = {
    "op1_line_dedup": line_runs.op1_line_dedup,
    "op2_token_counts": bpe_count.op2_token_counts,
    "op3_token_orc": token_orc.op3_token_orc,
    "op4_suffix_dedup": suffix_runs.op4_suffix_dedup,
    "op4_suffix_removal": suffix_runs.op4_suffix_removal,
    "op5_exact_dedup": exact_stream.op5_exact_dedup,
    "op6_mixing_rates": mixing.op6_mixing_rates,
    "op7_language_id": language.op7_language_id,
    "op8_html_mincut": mincut_html.op8_html_mincut,
    "op9_decontamination": contamination.op9_decontamination,
    "op10_minhash_near_dedup": bagminhash.op10_minhash_near_dedup,
}
SQL = line_runs.SQL | exact_stream.SQL | contamination.SQL | suffix_runs.SQL
