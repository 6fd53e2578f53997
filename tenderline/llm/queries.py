"""The registered queries of the operators and, where SQL can say the same, their statements."""

from __future__ import annotations

from tenderline.llm.alignment import op13_alignment
from tenderline.llm.bpe import op8_bpe
from tenderline.llm.chat import OP1_SQL, op1_chat_format
from tenderline.llm.decontaminate import op2_decontamination
from tenderline.llm.exact import OP9_SQL, op9_exact_dedup
from tenderline.llm.jaccard import op5_jaccard_join
from tenderline.llm.lines import OP10_SQL, op10_line_dedup
from tenderline.llm.packing import op11_packing
from tenderline.llm.passages import op4_substring_dedup
from tenderline.llm.periods import op12_periodic_runs
from tenderline.llm.quality import op3_quality
from tenderline.llm.toxicity import op6_toxicity
from tenderline.llm.urls import op7_url_filter

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_bpe": op8_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_packing": op11_packing,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_alignment": op13_alignment,
}

SQL = {
    "op1_chat_format": OP1_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
}
