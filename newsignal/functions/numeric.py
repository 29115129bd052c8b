"""Rounding, exact means, softmax and label expressions.

Scores, price changes and correlations are published with four decimals.  Sums over
such values are taken on the scaled whole numbers, which a double holds exactly, so
a mean does not depend on the order in which partitions arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCALE = 4


def _unit(scale: int) -> Column:
    return F.lit(float(10**scale))


def _plain_zero(c: Column) -> Column:
    """Turns -0.0 into 0.0."""
    return c + F.lit(0.0)


def half_even(c: Column, scale: int = SCALE) -> Column:
    return _plain_zero(F.rint(c * _unit(scale)) / _unit(scale))


def half_up(c: Column, scale: int = SCALE) -> Column:
    return F.round(c, scale)


def whole(c: Column, scale: int = SCALE) -> Column:
    """The value in units of its last decimal, e.g. 0.1234 -> 1234.0."""
    return F.rint(c * _unit(scale))


def mean_half_up(c: Column, scale: int = SCALE) -> Column:
    return F.round(F.sum(whole(c, scale)) / F.count(c), 0) / _unit(scale)


def mean_half_even(c: Column, scale: int = SCALE) -> Column:
    return _plain_zero(F.rint(F.sum(whole(c, scale)) / F.count(c)) / _unit(scale))


def share(condition: Column, scale: int = SCALE) -> Column:
    """Share of rows that meet the condition, rounded."""
    return half_up(F.count_if(condition) / F.count(F.lit(1)), scale)


def percent(c: Column, decimals: int = 1) -> Column:
    return half_even(c * F.lit(100.0), decimals)


def softmax(logits: list[Column]) -> list[Column]:
    top = F.greatest(*logits)
    parts = [F.exp(x - top) for x in logits]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return [part / total for part in parts]


def argmax_label(positive: Column, negative: Column, neutral: Column) -> Column:
    """Name of the largest value; ties go to positive, then negative."""
    return (
        F.when((positive >= negative) & (positive >= neutral), F.lit("positive"))
        .when(negative >= neutral, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def direction(c: Column, threshold: float = 0.1) -> Column:
    return (
        F.when(c > threshold, F.lit("positive"))
        .when(c < -threshold, F.lit("negative"))
        .otherwise(F.lit("near-zero"))
    )
