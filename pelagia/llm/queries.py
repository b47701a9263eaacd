"""The registered corpus queries and the SQL that checks them."""

from __future__ import annotations

from .chat import OP4_SQL, op4_chat_format
from .decontam import op6_decontamination
from .exact_dedup import OP7_SQL, op7_exact_dedup
from .langid import op9_language_id
from .lm import op10_lm_scoring
from .near_dedup import op3_minhash_near_dedup
from .negatives import OP12_SQL, op12_hard_negatives
from .packing import op1_best_fit_packing
from .spelling import op11_spelling_variants
from .suffix import op5_suffix_array_dedup
from .token_counts import op13_token_counts
from .toxicity import op2_toxicity
from .url_rules import OP8_SQL, op8_url_rules

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_rules": op8_url_rules,
    "op9_language_id": op9_language_id,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}
SQL = {"op4_chat_format": OP4_SQL, "op7_exact_dedup": OP7_SQL, "op8_url_rules": OP8_SQL, "op12_hard_negatives": OP12_SQL}
