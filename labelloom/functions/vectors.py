"""Per-row arithmetic on arrays of logits or class probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def _against(values: Column, scalar: Column, combine) -> Column:
    """Combine every element with one number that is computed once per row."""
    return F.zip_with(values, F.array_repeat(scalar, F.size(values)), combine)


def softmax(logits: Column) -> Column:
    """Class probabilities; the largest logit is subtracted first so `exp` cannot overflow."""
    raised = _against(logits, F.array_max(logits), lambda x, peak: F.exp(x - peak))
    return _against(raised, _total(raised), lambda x, total: x / total)


def argmax(values: Column) -> Column:
    """Zero-based index of the first largest element."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def margin(logits: Column, label: Column) -> Column:
    """Logit of the given label minus the largest other logit."""
    others = F.filter(logits, lambda x, i: i != label)
    return F.get(logits, label) - F.array_max(others)


def entropy(probs: Column) -> Column:
    """Shannon entropy in nats; a zero probability contributes nothing."""
    return -_total(F.transform(probs, lambda p: F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0))))


def bald_terms(mean_probs: Column, mean_entropy: Column) -> Column:
    """Mutual information: entropy of the mean prediction minus the mean entropy."""
    return entropy(mean_probs) - mean_entropy
