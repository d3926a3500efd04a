"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from .op1_pii import op1_pii
from .op10_langid import op10_language_id
from .op11_codes import ORACLE_OP11, op11_codes
from .op12_negatives import ORACLE_OP12, op12_hard_negatives
from .op13_simhash import op13_simhash
from .op2_mixing import op2_mixing
from .op3_quality import op3_quality_rules
from .op4_warc import ORACLE_OP4, op4_warc
from .op5_decontam import op5_decontamination
from .op6_secrets import op6_secret_scan
from .op7_jaccard import op7_jaccard_join
from .op8_urls import ORACLE_OP8, op8_url_filters
from .op9_quality import op9_quality_classifier

QUERIES = {
    "op1_pii": op1_pii,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_decontamination": op5_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_url_filters": op8_url_filters,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_codes,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash": op13_simhash,
}

# Operators without an entry are checked against brute force in tests/llm.
ORACLE = {
    "op4_warc": ORACLE_OP4,
    "op8_url_filters": ORACLE_OP8,
    "op11_vector_codes": ORACLE_OP11,
    "op12_hard_negatives": ORACLE_OP12,
}
