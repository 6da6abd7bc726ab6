"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from postlens.llm import op3_mixing as op3
from postlens.llm import op5_secrets as op5
from postlens.llm import op6_quality_rules as op6
from postlens.llm import op10_warc as op10
from postlens.llm import op11_importance as op11
from postlens.llm import op13_prefix_trie as op13
from postlens.llm.op1_lm_scoring import op1_lm_scoring
from postlens.llm.op12_simhash import op12_simhash
from postlens.llm.op2_language_ppm import op2_language_ppm
from postlens.llm.op4_probminhash import op4_probminhash
from postlens.llm.op7_suffix_dedup import op7_suffix_dedup
from postlens.llm.op8_toxicity_crf import op8_toxicity_crf
from postlens.llm.op9_decontaminate import op9_decontaminate

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_ppm": op2_language_ppm,
    "op3_mixing": op3.op3_mixing,
    "op4_probminhash": op4_probminhash,
    "op5_secrets": op5.op5_secrets,
    "op6_quality_rules": op6.op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity_crf": op8_toxicity_crf,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10.op10_warc,
    "op11_importance": op11.op11_importance,
    "op12_simhash": op12_simhash,
    "op13_prefix_trie": op13.op13_prefix_trie,
}

# The others are tested against brute force, an exact round trip or held-out
# accuracy (tests/llm).
ORACLE_SQL: dict[str, str] = {
    "op3_mixing": op3.ORACLE_SQL,
    "op5_secrets": op5.ORACLE_SQL,
    "op6_quality_rules": op6.ORACLE_SQL,
    "op10_warc": op10.ORACLE_SQL,
    "op11_importance": op11.ORACLE_SQL,
    "op13_prefix_trie": op13.ORACLE_SQL,
}
