"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from textgate.llm.conversation_trie import OP13_SQL, op13
from textgate.llm.cover_tree import OP8_SQL, op8
from textgate.llm.exact_dedup import OP4_SQL, op4
from textgate.llm.language_model import op1
from textgate.llm.mixing import OP5_SQL, op5
from textgate.llm.order_minhash import op12
from textgate.llm.pieces import op7
from textgate.llm.quality import op9
from textgate.llm.secrets import op3
from textgate.llm.sharding import op2
from textgate.llm.simhash import op10
from textgate.llm.surrogates import op6
from textgate.llm.whitening import op11

QUERIES = {
    "op1_gated_lm": op1,
    "op2_jump_sharding": op2,
    "op3_secret_scan": op3,
    "op4_exact_dedup": op4,
    "op5_source_mixing": op5,
    "op6_surrogates": op6,
    "op7_pieces": op7,
    "op8_cover_tree": op8,
    "op9_quality_classifier": op9,
    "op10_simhash": op10,
    "op11_whitening": op11,
    "op12_order_minhash": op12,
    "op13_prefix_trie": op13,
}

ORACLE = {
    "op4_exact_dedup": OP4_SQL,
    "op5_source_mixing": OP5_SQL,
    "op8_cover_tree": OP8_SQL,
    "op13_prefix_trie": OP13_SQL,
}
