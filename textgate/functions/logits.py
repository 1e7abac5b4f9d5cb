"""Scalars over a per-row logits / probability array (higher-order functions, JVM side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgate.functions.text import col


def argmax_class(c: str | Column) -> Column:
    """0-based index of the largest element; the first wins ties; NaN counts as largest."""
    a = col(c)
    pos = F.array_position(a, F.array_max(a))
    return F.when(pos > 0, (pos - 1).cast("int"))


def softmax(c: str | Column) -> Column:
    """exp(x - max) / sum(exp(x - max)), in double precision."""
    a = col(c)
    m = F.array_max(a).cast("double")
    e = F.transform(a, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def confidence(probs: str | Column, predicted: str | Column) -> Column:
    """Probability of the predicted (0-based) class."""
    return F.element_at(col(probs), col(predicted) + 1)


def label_array(labels: Sequence[str]) -> Column:
    return F.array(*[F.lit(str(x)) for x in labels])


def probability_map(probs: str | Column, labels: Sequence[str]) -> Column:
    """``{label: probability}`` over all classes, labels given in id order."""
    return F.map_from_arrays(label_array(labels), col(probs))
