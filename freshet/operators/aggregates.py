"""Grouped aggregates. All of them have partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.scalars import as_column, count_true, nan_to_null


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all set; a row without one is in no group."""
    return df.filter(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def group_agg(df: DataFrame, keys: str | Sequence[str], **named: Column) -> DataFrame:
    """Named aggregates per key; null keys form no group and NaN is skipped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    clean = nan_to_null(with_keys(df, keys))
    return clean.groupBy(*keys).agg(*(c.alias(name) for name, c in named.items()))


def group_all(df: DataFrame, keys: str | Sequence[str], **named: Column) -> DataFrame:
    """Named aggregates per key, rows without a key being a group of their own."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*(c.alias(name) for name, c in named.items()))


def agg_multi(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str], funcs: Sequence[str]) -> DataFrame:
    """Every function for every column, named column_function."""
    known = {"mean": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count, "std": F.stddev_samp}
    return group_agg(df, keys, **{f"{c}_{f}": known[f](c) for c in columns for f in funcs})


def group_mean(df: DataFrame, keys: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    return group_agg(df, keys, **{c: F.avg(c) for c in columns})


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations as rows (a, b, r), both orders and the diagonal.

    One pass and one row of partial results per task, whatever the row count.
    """
    clean = nan_to_null(df.select(*columns))
    pairs = list(combinations(columns, 2))
    own = [F.corr(c, c).alias(f"_{c}_{c}") for c in columns]
    row = clean.agg(*own, *(F.corr(a, b).alias(f"_{a}_{b}") for a, b in pairs))
    entries = [(c, c, f"_{c}_{c}") for c in columns]
    entries += [(x, y, f"_{a}_{b}") for a, b in pairs for x, y in ((a, b), (b, a))]
    structs = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(name).alias("r")) for x, y, name in entries]
    return row.select(F.explode(F.array(*structs)).alias("_c")).select("_c.*")


def volume_alert(
    df: DataFrame, batch: str | None, condition: str | Column, more_than: int, out: str = "hits"
) -> DataFrame:
    """Batches in which the condition holds for more than the given rows.

    Without a batch column the frame is one batch.
    """
    hits = count_true(condition).alias(out)
    counts = with_keys(df, [batch]).groupBy(batch).agg(hits) if batch else df.agg(hits)
    return counts.filter(F.col(out) > more_than)


def top_n(df: DataFrame, by: str | Column, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the highest value; each task keeps n rows only."""
    return df.orderBy(as_column(by).desc_nulls_last(), *ties).limit(n)


def ranked(df: DataFrame, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """All rows from the highest value down."""
    return df.orderBy(F.col(by).desc_nulls_last(), *ties)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


