"""The queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from tablefit.llm.ann import op3_ann
from tablefit.llm.byte_bpe import op4_byte_bpe
from tablefit.llm.decontaminate import OP1_SQL, op1_decontaminate
from tablefit.llm.html_text import op10_html_text
from tablefit.llm.lm_score import op2_lm_score
from tablefit.llm.near_dedup import op8_near_dedup
from tablefit.llm.periodic_runs import OP11_SQL, op11_periodic_runs
from tablefit.llm.pii import op6_pii
from tablefit.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from tablefit.llm.quality import op9_quality
from tablefit.llm.token_counts import op12_token_counts
from tablefit.llm.toxicity import op7_toxicity
from tablefit.llm.url_filter import OP5_SQL, op5_url_filter

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_lm_score": op2_lm_score,
    "op3_ann": op3_ann,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_url_filter": op5_url_filter,
    "op6_pii": op6_pii,
    "op7_toxicity": op7_toxicity,
    "op8_near_dedup": op8_near_dedup,
    "op9_quality": op9_quality,
    "op10_html_text": op10_html_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op5_url_filter": OP5_SQL,
    "op11_periodic_runs": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
