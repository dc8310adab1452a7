"""Ordered operators on micro-batches, safe for hot keys.

Spark's keyed state hands all rows of a key to one call. Where one key may hold
a large part of a micro-batch, the operators of ``freshet.operators.ordered``
run on the micro-batch instead, which cuts such a key into blocks. What came
before the micro-batch is one row per key, put in front of the key's rows: a
running total as its value, the last value as its value, and so on. After the
micro-batch the same kind of row is written for the next one.

The rows live in a table beside the checkpoint. Batch n reads the table of
batch n-1 and overwrites that of batch n-2, so a repeated batch finds what it
found the first time. ``seq`` is not negative; the carried rows get -1.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.ordered import FOLD_ROWS, HALVING, Fold, affine, changed, folded_parts, latched, listed, running_sum
from freshet.operators.ranking import rank_asof
from freshet.streaming.runs import Batch

Transform = Callable[[DataFrame], DataFrame]
BEFORE = -1


def carried(apply: Transform, remember: Transform, seq: str, folder: str, sink: Batch) -> Batch:
    """A micro-batch callback: ``apply`` makes the result, ``remember`` the carried rows."""

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = kept
            if batch_id > 0:
                before = kept.sparkSession.read.parquet(f"{folder}/{(batch_id - 1) % 2}")
                rows = kept.unionByName(before, allowMissingColumns=True)
            result = apply(rows).filter(F.col(seq) > BEFORE)
            # A carried total may be wider than the column it stands in for.
            kinds = {f.name: f.dataType for f in batch.schema.fields if f.name in result.columns}
            sink(result.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()}), batch_id)
            after = remember(rows).withColumn(seq, F.lit(BEFORE).cast(batch.schema[seq].dataType))
            after.write.mode("overwrite").parquet(f"{folder}/{batch_id % 2}")
        finally:
            kept.unpersist()

    return each


def with_column_first(each: Batch, name: str, value: Column) -> Batch:
    return lambda batch, batch_id: each(batch.withColumn(name, value), batch_id)


def widened(df: DataFrame, name: str) -> DataFrame:
    """A column in the type of its sums: the same for every micro-batch."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return df.withColumn(name, F.col(name).cast(T.DecimalType(38, kind.scale)))
    return df.withColumn(name, F.col(name).cast("long" if isinstance(kind, T.IntegralType) else "double"))


def running_sum_batches(
    keys: str | Sequence[str], seq: str, value: Column, out: str, folder: str, sink: Batch, **cut
) -> Batch:
    keys = listed(keys)
    each = carried(
        lambda rows: running_sum(rows, keys, seq, "_step", out, **cut).drop("_step"),
        lambda rows: rows.groupBy(*keys).agg(F.sum("_step").alias("_step")),
        seq,
        folder,
        sink,
    )
    return lambda batch, batch_id: each(widened(batch.withColumn("_step", value), "_step"), batch_id)


def running_count_batches(keys, seq: str, out: str, folder: str, sink: Batch, **cut) -> Batch:
    return running_sum_batches(keys, seq, F.lit(1), out, folder, sink, **cut)


def changed_batches(key: str, seq: str, column: str, out: str, folder: str, sink: Batch, **cut) -> Batch:
    return carried(
        lambda rows: changed(rows, key, seq, column, out, **cut),
        lambda rows: rows.groupBy(key).agg(F.max_by(column, seq).alias(column)),
        seq,
        folder,
        sink,
    )


def latched_batches(
    key: str, seq: str, failing: Column, out: str, after: int, folder: str, sink: Batch,
    seed: DataFrame | None = None, **cut
) -> Batch:
    """Keys that have failed too often; a carried row stands for its key's failures."""

    def apply(rows: DataFrame) -> DataFrame:
        return latched(rows, key, seq, F.col("_fails"), out, after, seed, **cut).drop("_fails")

    each = carried(
        apply, lambda rows: rows.groupBy(key).agg(F.sum("_fails").alias("_fails")), seq, folder, sink
    )
    return with_column_first(each, "_fails", F.when(failing, 1).otherwise(0).cast("long"))


def ordered_fold_batches(
    keys: str | Sequence[str], seq: str, value: str, out: str, fold: Fold, folder: str, sink: Batch,
    span: int = FOLD_ROWS, hot_rows: int = FOLD_ROWS,
) -> Batch:
    """The fold of each key after every micro-batch, for keys seen so far."""
    keys = listed(keys)

    def parts(rows: DataFrame) -> DataFrame:
        return folded_parts(rows.select(*keys, seq, "_part"), keys, [seq], "_part", fold, span, hot_rows)

    each = carried(
        lambda rows: parts(rows).select(*keys, fold.result(F.col("_part")).alias(out), F.lit(0).alias(seq)),
        parts,
        seq,
        folder,
        lambda result, n: sink(result.drop(seq), n),
    )
    return with_column_first(each, "_part", fold.part(F.col(value)))


def halving_fold_batches(
    keys: str | Sequence[str], seq: str, value: str, out: str, folder: str, sink: Batch, **cut
) -> Batch:
    return ordered_fold_batches(keys, seq, value, out, affine(*HALVING), folder, sink, **cut)


def rank_batches(key: str, seq: str, points: str, folder: str, sink: Batch, **options) -> Batch:
    return carried(
        lambda rows: rank_asof(rows, key, seq, points, **options),
        lambda rows: rows.groupBy(key).agg(F.sum(points).alias(points)),
        seq,
        folder,
        sink,
    )
