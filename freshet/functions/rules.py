"""Ordered rules: the first condition that holds names the label."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str | Column, object]


def label(rules: Iterable[Rule], default: object) -> Column:
    """One CASE expression out of (condition, label) pairs.

    A condition that is null does not hold, so it falls through to the next.
    """
    pairs = [(F.expr(c) if isinstance(c, str) else c, F.lit(v)) for c, v in rules]
    (first, value), rest = pairs[0], pairs[1:]
    case = F.when(first, value)
    for condition, value in rest:
        case = case.when(condition, value)
    return case.otherwise(F.lit(default))


def classify(df: DataFrame, out: str, rules: Iterable[Rule], default: object) -> DataFrame:
    return df.withColumn(out, label(rules, default))
