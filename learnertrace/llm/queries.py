"""The operators as queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from learnertrace.llm import decontaminate, exact_dedup, hard_negatives, jaccard_join, mixing, top_k
from learnertrace.llm.conversations import op11_conversation_repair
from learnertrace.llm.html_text import op4_html_text
from learnertrace.llm.licenses import op3_license_scan
from learnertrace.llm.quality import op10_quality
from learnertrace.llm.token_counts import op6_token_counts
from learnertrace.llm.token_records import op5_token_records
from learnertrace.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_html_text": op4_html_text,
    "op5_token_records": op5_token_records,
    "op6_token_counts": op6_token_counts,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_mixing": mixing.op9_mixing,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_top_k": top_k.op12_top_k,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op7_jaccard_join": jaccard_join.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op9_mixing": mixing.SQL,
    "op12_top_k": top_k.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
