"""Column expressions on a logits array and its label."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def predicted_class(logits: Column) -> Column:
    """Index of the largest logit, the lowest one on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row: as a variable of
    a one-element array, not again for every element of a lambda."""
    return F.transform(F.array(value), use)[0]


def _top(logits: Column) -> Column:
    return F.array_max(logits).cast("double")


def _shifted_exp(logits: Column) -> Column:
    return _let(_top(logits), lambda top: F.transform(
        logits, lambda x: F.exp(x.cast("double") - top)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def probabilities(logits: Column) -> Column:
    """Softmax, shifted by the largest logit so that exp cannot overflow."""
    return _let(_shifted_exp(logits), lambda shares: _let(
        _total(shares), lambda s: F.transform(shares, lambda x: x / s)))


def is_finite(value: Column) -> Column:
    """False for null, NaN and the infinities."""
    number = value.cast("double")
    return F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")), F.lit(False))


def in_top_k(logits: Column, label: Column, k: int) -> Column:
    """Fewer than k logits are larger, so ties at the cut count as in.

    A label outside the logits, or one whose logit is not finite, is a miss;
    a null label gives null.
    """
    target = F.get(logits, label.cast("int"))
    better = _let(target, lambda t: F.size(F.filter(logits, lambda x: x > t)))
    return F.when(label.isNotNull(), F.coalesce(is_finite(target) & (better < k), F.lit(False)))


def is_best(logits: Column, label: Column) -> Column:
    """The label is the predicted class; the same rules as in_top_k."""
    target = F.get(logits, label.cast("int"))
    best = predicted_class(logits) == label
    return F.when(label.isNotNull(), F.coalesce(is_finite(target) & best, F.lit(False)))


def cross_entropy(logits: Column, label: Column) -> Column:
    """Loss of one row. A label outside the logits has an all-zero one-hot
    row and so no loss; a null label has none at all (null)."""
    target = F.get(logits, label.cast("int")).cast("double")
    loss = F.log(_total(_shifted_exp(logits))) + _top(logits) - target
    return F.when(label.isNotNull(), F.when(target.isNull(), F.lit(0.0)).otherwise(loss))
