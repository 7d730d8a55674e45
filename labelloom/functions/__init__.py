"""Column expressions: every helper returns a `Column` built from native Spark functions."""

from labelloom.functions.keys import case_from_path, file_key, hash_order, label_key, strip_position
from labelloom.functions.predicates import (
    clip,
    differs,
    flag_gt,
    label_state,
    not_in,
    not_rlike_any,
    positive_labels,
    rlike_any,
    safe_ratio,
)
from labelloom.functions.vectors import argmax, bald_terms, entropy, margin, sigmoid, softmax

__all__ = [
    "argmax", "bald_terms", "case_from_path", "clip", "differs", "entropy", "file_key", "flag_gt",
    "hash_order", "label_key", "label_state", "margin", "not_in", "not_rlike_any",
    "positive_labels", "rlike_any", "safe_ratio", "sigmoid", "softmax", "strip_position",
]
