"""The queries of this subpackage and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from polyscribe.llm import op1_lines, op2_lm, op3_fingerprints, op4_tokens, op5_mixing, op6_substring, op7_warc, op8_neardup, op9_decontamination, op10_quality

QUERIES = {
    "op1_lines": op1_lines.op1_lines,
    "op2_lm": op2_lm.op2_lm,
    "op3_fingerprints": op3_fingerprints.op3_fingerprints,
    "op4_tokens": op4_tokens.op4_tokens,
    "op5_mixing": op5_mixing.op5_mixing,
    "op6_substring": op6_substring.op6_substring,
    "op7_warc": op7_warc.op7_warc,
    "op8_neardup": op8_neardup.op8_neardup,
    "op9_decontamination": op9_decontamination.op9_decontamination,
    "op10_quality": op10_quality.op10_quality,
}
SQL = {
    "op1_lines": op1_lines.SQL,
    "op2_lm": op2_lm.SQL,
    "op5_mixing": op5_mixing.SQL,
    "op6_substring": op6_substring.SQL,
    "op7_warc": op7_warc.SQL,
    "op8_neardup": op8_neardup.SQL,
    "op9_decontamination": op9_decontamination.SQL,
}
