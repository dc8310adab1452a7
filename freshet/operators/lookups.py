"""Lookups in a dimension. The side to broadcast is chosen by Catalyst, which
checks its size; a dimension beyond the limit is joined by a shuffle, whose hot
partitions AQE splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, on: str, defaults: Mapping[str, object]) -> DataFrame:
    """Adds the dimension's columns, with a default where the key has no row.

    ``dim`` holds one row per key. A stored value, zero too, is kept: only a
    missing one is replaced. Works on a stream against a static dimension.
    """
    hidden = {c: f"_dim_{c}" for c in defaults}
    side = dim.select(on, *(F.col(c).alias(h) for c, h in hidden.items()))
    joined = df.join(side, on, "left")
    filled = {c: F.coalesce(F.col(h), F.lit(defaults[c])) for c, h in hidden.items()}
    return joined.withColumns(filled).drop(*hidden.values())


def missing_keys(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Keys of the data that the dimension lacks, once each."""
    return df.select(on).filter(F.col(on).isNotNull()).distinct().join(dim.select(on), on, "left_anti")


def member_flag(df: DataFrame, members: DataFrame, on: str, out: str) -> DataFrame:
    """Whether the key is in the set."""
    known = members.select(on).distinct().withColumn("_member", F.lit(True))
    return df.join(known, on, "left").withColumn(out, F.col("_member").isNotNull()).drop("_member")


def first_written(
    df: DataFrame, key: str, order: str, offered: str, out: str, seed: DataFrame | None = None
) -> DataFrame:
    """The value that was first offered for the key, as it stood at each record.

    A record that offers a value where none is yet sets it, and sees it. Null offers
    none. ``seed`` holds one row per key with a value ``out`` set before. Two small
    aggregates and joins, so no key's rows need to be sorted.
    """
    offers = df.filter(F.col(offered).isNotNull()).groupBy(F.col(key).alias("_k"))
    firsts = offers.agg(F.min(F.struct(F.col(order).alias("at"), F.col(offered).alias("value"))).alias("_first"))
    rows = df.join(firsts, df[key].eqNullSafe(firsts["_k"]), "left").drop("_k")
    known = F.when(F.col(order) >= F.col("_first.at"), F.col("_first.value"))
    if seed is not None:
        before = seed.select(F.col(key).alias("_k"), F.col(out).alias("_set"))
        rows = rows.join(before, rows[key] == before["_k"], "left").drop("_k")
        known = F.coalesce("_set", known)
    return rows.withColumn(out, known).drop("_first", "_set")
