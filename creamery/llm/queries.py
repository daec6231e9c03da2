"""Registered queries of the numbered operators, and the pipeline."""

from __future__ import annotations

from creamery.llm.bpe import op5_bpe
from creamery.llm.codebooks import ORACLE as CODEBOOKS_ORACLE
from creamery.llm.codebooks import op12_codebooks
from creamery.llm.exact import ORACLE as EXACT_ORACLE
from creamery.llm.exact import op13_exact
from creamery.llm.hyperplanes import ORACLE as HYPERPLANES_ORACLE
from creamery.llm.hyperplanes import op8_hyperplanes
from creamery.llm.line_frequency import ORACLE as LINE_FREQUENCY_ORACLE
from creamery.llm.line_frequency import op3_line_frequency
from creamery.llm.line_windows import ORACLE as LINE_WINDOWS_ORACLE
from creamery.llm.line_windows import op6_line_windows
from creamery.llm.mixing import op9_mixing
from creamery.llm.periodic import op11_periodic
from creamery.llm.phrases import ORACLE as PHRASES_ORACLE
from creamery.llm.phrases import op1_phrases
from creamery.llm.ppm import op2_ppm
from creamery.llm.simhash import op4_simhash
from creamery.llm.token_files import op7_token_files
from creamery.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_phrases": op1_phrases,
    "op2_ppm": op2_ppm,
    "op3_line_frequency": op3_line_frequency,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_line_windows": op6_line_windows,
    "op7_token_files": op7_token_files,
    "op8_hyperplanes": op8_hyperplanes,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_periodic": op11_periodic,
    "op12_codebooks": op12_codebooks,
    "op13_exact": op13_exact,
}
ORACLE = {
    "op1_phrases": PHRASES_ORACLE,
    "op3_line_frequency": LINE_FREQUENCY_ORACLE,
    "op6_line_windows": LINE_WINDOWS_ORACLE,
    "op8_hyperplanes": HYPERPLANES_ORACLE,
    "op12_codebooks": CODEBOOKS_ORACLE,
    "op13_exact": EXACT_ORACLE,
}
