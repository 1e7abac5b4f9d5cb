from textgate.functions.logits import argmax_class, confidence, label_array, probability_map, softmax
from textgate.functions.text import (
    attention_mask,
    collapse_ws,
    fill_blank,
    is_blank,
    lowercase,
    pad_tokens,
    strip,
    strip_collapse,
    to_string,
    tokens,
)

__all__ = [
    "argmax_class",
    "attention_mask",
    "collapse_ws",
    "confidence",
    "fill_blank",
    "is_blank",
    "label_array",
    "lowercase",
    "pad_tokens",
    "probability_map",
    "softmax",
    "strip",
    "strip_collapse",
    "to_string",
    "tokens",
]
