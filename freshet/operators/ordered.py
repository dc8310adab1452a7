"""Running values over the ordered rows of each key.

A plain window function sorts all rows of a key in one task. That holds for
ordinary keys and fails for a key with a third of the table. Here the keys with
more than ``hot_rows`` rows are found first, by one aggregate over the key
columns. Their rows are dealt by range of key and order to blocks of about
``span`` rows, each block is a window of its own, and a small table with one row
per block carries the result from block to block. If no key is hot, the plan is
the plain window. Blocks shorter than ``PART_ROWS`` share the task and the file
that deals them, so short blocks cost rows of the small table and no tasks.

Blocks come from row counts and never from the values, so any order that can be
sorted will do: numbers, times and texts, sparse or not, with nulls first as in
a window. Rows that are equal in key and order stay in one block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.functions.scalars import as_column
from freshet.session import shared_path

HOT_ROWS = 4_000_000  # rows of one key that a single task may sort
FOLD_ROWS = 100_000  # rows of one key that one expression folds
HOT_KEYS = 10_000  # hot keys that may be broadcast; beyond it all keys are cut
PART_ROWS = 100_000  # rows that one task deals to blocks, at least
KEY, BLOCK = "_key", "_block"


def listed(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], renamed: Sequence[str]) -> Column:
    return reduce(and_, (left[k].eqNullSafe(right[r]) for k, r in zip(keys, renamed, strict=True)), F.lit(True))


def cut_hot_keys(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], span: int = HOT_ROWS, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, list[str]]:
    """The frame, and the columns whose groups are small enough for one task.

    Without hot keys these are the keys. Otherwise they are two new columns: the
    keys as one ``_key``, which is never null and so can be joined on as it is
    partitioned, and ``_block``: null for ordinary keys, the number of the row's
    block for hot ones. Runs one job over the key columns, and writes the hot
    rows with their blocks to the shared folder, so that blocks stay as they are.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
    hot = sizes.limit(HOT_KEYS + 1).collect()
    if not hot:
        return df, list(keys)
    rest = None
    if keys and len(hot) <= HOT_KEYS:
        renamed = [f"_hot_{k}" for k in keys]
        known = df.sparkSession.createDataFrame(hot, sizes.schema).toDF(*renamed, "_hot")
        df = df.join(F.broadcast(known), same_keys(df, known, keys, renamed), "left").drop(*renamed)
        rest = df.filter(F.col("_hot").isNull()).drop("_hot").withColumn(BLOCK, F.lit(None).cast("long"))
        df = df.filter(F.col("_hot").isNotNull()).drop("_hot")
    # Written once, as counting, sampling and dealing would each compute the rows again.
    whole = shared_path(df.sparkSession, "hot-rows")
    df.write.parquet(whole)
    df = df.sparkSession.read.parquet(whole)
    parts = max(2, -(-df.count() // max(span, PART_ROWS)))
    dealt = df.repartitionByRange(parts, *keys, *order).withColumn(BLOCK, F.spark_partition_id().cast("long"))
    if span < PART_ROWS:
        # Equal rows have one rank, so they stay in one block.
        within = F.rank().over(Window.partitionBy(BLOCK).orderBy(*keys, *order)) - 1
        dealt = dealt.withColumn("_within", F.floor(within / span))
        dealt = dealt.withColumn(BLOCK, F.shiftleft(BLOCK, 32) + F.col("_within")).drop("_within")
    path = shared_path(df.sparkSession, "blocks")
    dealt.write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    if rest is not None:
        rows = rows.unionByName(rest)
    return rows.withColumn(KEY, F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))), [KEY, BLOCK]


def spread(rows: DataFrame, groups: Sequence[str], tasks: int | None) -> DataFrame:
    """Deals groups to a number of tasks, where the caller knows how many rows there are."""
    return rows.repartition(tasks, *groups) if tasks and groups else rows


def carry(rows: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """Joins per-block values to the rows of their block, which lie together already."""
    side = edges.select(F.col(KEY).alias("_carry_key"), F.col(BLOCK).alias("_carry_block"), name)
    on = (rows[KEY] == side["_carry_key"]) & (rows[BLOCK] == side["_carry_block"])
    return rows.join(side, on, "left").drop("_carry_key", "_carry_block")


def hot_blocks(blocked: DataFrame) -> DataFrame:
    return blocked.filter(F.col(BLOCK).isNotNull())


def running_sum(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column,
    out: str,
    inclusive: bool = True,
    span: int = HOT_ROWS,
    hot_rows: int = HOT_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """The sum up to each row of its key, or up to the row before it."""
    keys, order, value = listed(keys), listed(order), as_column(value)
    blocked, groups = cut_hot_keys(df, keys, order, span, hot_rows)
    blocked = spread(blocked, groups, tasks)
    last = Window.currentRow if inclusive else -1
    here = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    zero = F.lit(0)
    rows = blocked.withColumn(out, F.coalesce(F.sum(value).over(here), zero))
    if groups == keys:
        return rows
    totals = hot_blocks(blocked).groupBy(*groups).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(KEY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    joined = carry(rows, totals.withColumn("_before", F.sum("_total").over(earlier)), "_before")
    return joined.withColumn(out, F.col(out) + F.coalesce("_before", zero)).drop("_before", *groups)


def running_count(df: DataFrame, keys, order, out: str, **options) -> DataFrame:
    """The number of each row within its key, from 1."""
    return running_sum(df, keys, order, F.lit(1), out, **options)


def shifted(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column,
    out: str,
    back: bool = True,
    span: int = HOT_ROWS,
    hot_rows: int = HOT_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """The value of the row before (or after) each row within its key."""
    keys, order, value = listed(keys), listed(order), as_column(value)
    blocked, groups = cut_hot_keys(df, keys, order, span, hot_rows)
    blocked = spread(blocked, groups, tasks)
    here = Window.partitionBy(*groups).orderBy(*order)
    step = F.lag if back else F.lead
    rows = blocked.withColumn(out, step(value).over(here))
    if groups == keys:
        return rows
    rows = rows.withColumn("_at_edge", step(F.lit(True)).over(here).isNull())
    pick = F.max_by if back else F.min_by
    edges = hot_blocks(blocked).groupBy(*groups).agg(pick(value, F.struct(*order)).alias("_edge"))
    neighbour = step("_edge").over(Window.partitionBy(KEY).orderBy(BLOCK))
    joined = carry(rows, edges.withColumn("_across", neighbour), "_across")
    edge_value = F.when(F.col("_at_edge"), F.col("_across")).otherwise(F.col(out))
    return joined.withColumn(out, edge_value).drop("_across", "_at_edge", *groups)


def changed(df: DataFrame, keys, order, column: str, out: str, **options) -> DataFrame:
    """Whether the column differs from the key's row before; never on the first."""
    seen = shifted(df, keys, order, column, "_seen", **options)
    return seen.withColumn(out, F.coalesce(F.col("_seen") != F.col(column), F.lit(False))).drop("_seen")


def latched(
    df: DataFrame,
    key: str,
    order: str | Sequence[str],
    failing: Column,
    out: str,
    after: int,
    seed: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Whether the key was blocked when the row came in.

    A key is blocked once more than ``after`` of its rows have failed, or from
    the start if it is in ``seed``. A row sees the rows before it only.
    ``failing`` is a condition, or the number of failures a row stands for.
    """
    fails = failing.cast("long")  # a truth value counts as one; a number stands for that many
    counted = running_sum(df, key, order, F.coalesce(fails, F.lit(0)), "_failed", inclusive=False, **options)
    blocked = F.col("_failed") > after
    if seed is not None:
        known = seed.select(key).distinct().withColumn("_seeded", F.lit(True))
        counted = counted.join(known, key, "left")
        blocked = blocked | F.col("_seeded").isNotNull()
    return counted.withColumn(out, blocked).drop("_failed", "_seeded")


@dataclass(frozen=True)
class Fold:
    """A way to run through ordered values that can be cut anywhere.

    ``lift`` turns a value into what its step does to the state so far, ``join``
    makes one such partial of two that follow each other, ``identity`` does
    nothing, and ``result`` is the state a partial leads to. ``join`` must be
    associative; it need not be commutative.
    """

    lift: Callable[[Column], Column]
    join: Callable[[Column, Column], Column]
    identity: Column
    result: Callable[[Column], Column]

    def part(self, value: Column) -> Column:
        """The partial of one value; a null one changes nothing."""
        return F.when(value.isNull(), self.identity).otherwise(self.lift(value))


def affine(factor: float, gain: float, start: float | None = None) -> Fold:
    """s = factor * s + gain * v, from ``start`` or else from the first value."""

    def partial(begun: Column, by: Column, plus: Column) -> Column:
        return F.struct(begun.cast("double").alias("begun"), by.alias("by"), plus.alias("plus"))

    def join(x: Column, y: Column) -> Column:
        begun = F.coalesce(y["by"] * x["begun"] + y["plus"], y["begun"])
        return partial(begun, x["by"] * y["by"], y["by"] * x["plus"] + y["plus"])

    return Fold(
        lift=lambda v: partial(v, F.lit(float(factor)), F.lit(float(gain)) * v.cast("double")),
        join=join,
        identity=partial(F.lit(None), F.lit(1.0), F.lit(0.0)),
        result=lambda p: p["begun"] if start is None else p["by"] * F.lit(float(start)) + p["plus"],
    )


def clamped(low: int, high: int, start: int = 0) -> Fold:
    """s = s + v, held between ``low`` and ``high`` after each step; whole numbers."""
    least, most = F.lit(-(1 << 62)).cast("long"), F.lit(1 << 62).cast("long")

    def partial(shift: Column, floor: Column, top: Column) -> Column:
        return F.struct(shift.cast("long").alias("shift"), floor.cast("long").alias("floor"), top.cast("long").alias("top"))

    def held(s: Column, p: Column) -> Column:
        return F.least(F.greatest(s, p["floor"]), p["top"])

    return Fold(
        lift=lambda v: partial(v, F.lit(low), F.lit(high)),
        join=lambda x, y: partial(
            x["shift"] + y["shift"], held(x["floor"] + y["shift"], y), held(x["top"] + y["shift"], y)
        ),
        identity=partial(F.lit(0), least, most),
        result=lambda p: held(F.lit(start).cast("long") + p["shift"], p),
    )


def folded_parts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], part: str, fold: Fold, span: int, hot_rows: int
) -> DataFrame:
    """One row per key: the keys and ``part``, all its partials joined in order.

    A block's partials are put in order and joined in one expression. The blocks of a
    hot key leave one partial each; these are rows again, and are joined the same way.
    """
    blocked, groups = cut_hot_keys(df, keys, order, span, hot_rows)
    rows = F.array_sort(F.collect_list(F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order)), F.col(part).alias("_p"))))
    joined = F.aggregate(rows, fold.identity, lambda done, row: fold.join(done, row["_p"])).alias(part)
    parts = blocked.groupBy(*groups).agg(joined)
    if groups == list(keys):
        return parts
    path = shared_path(df.sparkSession, "folds")
    parts.select(*(F.col(f"{KEY}.{k}") for k in keys), F.col(BLOCK).alias("_after"), part).write.parquet(path)
    # A few partials are always folded at once, so every round leaves fewer.
    span, hot_rows = max(span, 8), max(hot_rows, 64)
    return folded_parts(df.sparkSession.read.parquet(path), keys, ["_after"], part, fold, span, hot_rows)


def ordered_fold(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column,
    out: str,
    fold: Fold,
    span: int = FOLD_ROWS,
    hot_rows: int = FOLD_ROWS,
) -> DataFrame:
    """The state of each key after all its values in order.

    Null values change nothing, wherever they stand; a key with no other values has
    the start, or null. Values that are equal in order are taken in any order.
    """
    keys, order, value = listed(keys), listed(order), as_column(value)
    rows = df.select(*keys, *order, fold.part(value).alias("_part"))
    parts = folded_parts(rows, keys, order, "_part", fold, span, hot_rows)
    return parts.select(*keys, fold.result(F.col("_part")).alias(out))


HALVING = (0.5, 0.5)


def halving_fold(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str | Column,
    out: str,
    span: int = FOLD_ROWS,
    hot_rows: int = FOLD_ROWS,
) -> DataFrame:
    """The result of s = (s + v) / 2 over the ordered values of each key, from the first value that is not null."""
    return ordered_fold(df, keys, order, value, out, affine(*HALVING), span, hot_rows)
