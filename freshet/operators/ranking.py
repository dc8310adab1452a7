"""Ranks among all keys, as they stood when each record came in.

A record's rank is the number of keys whose running total was higher at that
moment. Every total holds from its record to the key's next record, so the rank
is a count of points: +1 where a higher total began, -1 where it ended, both at
or before the record. Counting pairs would cost the square of the records.
Instead the plane (time, total) is cut into bands both ways and each record's
count is put together from three parts, none of which looks at all records:

* points of the same time band, in one bounded group per band,
* points of earlier time bands in the same total band, likewise,
* points of earlier time bands and higher total bands, from a table of sums.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.operators.ordered import HOT_ROWS, running_sum, shifted, spread
from freshet.session import shared_path

# The band functions travel to the executors by value, so the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_ROWS = 500_000  # rows that one task sorts or joins, about
LOW_BITS = 33  # monotonically_increasing_id: row number below, partition above


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks for so many rows: their number grows with the rows, so that the memory of one does not.

    Left to itself a shuffle keeps its width, and adaptive execution goes by bytes as they are packed. None
    where that width is enough, as for micro-batches.
    """
    tasks = -(-rows // TASK_ROWS)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def positions(df: DataFrame, order: list, out: str, tasks: int | None = None) -> DataFrame:
    """Numbers all rows from 0 in the given order, without a single-task sort.

    The rows are range partitioned, sorted and written to a table in the shared
    folder, so that the partition sizes and the rows come from the same
    partitioning, however often they are read or a task is run again.
    """
    path = shared_path(df.sparkSession, "positions")
    ranges = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order) if tasks else df.orderBy(*order)
    ranges.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    ordered = df.sparkSession.read.parquet(path)
    numbered = ordered.withColumns(
        {
            "_part": F.shiftright("_id", LOW_BITS),
            "_row": F.col("_id").bitwiseAND(F.lit((1 << LOW_BITS) - 1)),
        }
    )
    # One row per partition of the sort.
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + F.col("_row")).drop(
        "_id", "_part", "_row", "_start"
    )


def weight_above(when: np.ndarray, high_first: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each row the summed weight of the rows that are both earlier and higher.

    ``when`` places the rows in time (a permutation of 0..n-1), ``high_first``
    lists them from the highest down. Counts by halves of the time order, all
    halves of one size at once, so no pair of rows is ever formed.
    """
    t, w = when[high_first], weight[high_first]
    found = np.zeros(len(when), dtype=np.int64)
    for bit in range(max(len(when) - 1, 0).bit_length()):
        # Small numbers are sorted by their digits, in one pass.
        halves = t >> (bit + 1)
        by_node = np.argsort(halves.astype(np.uint16) if len(t) <= 1 << (bit + 17) else halves, kind="stable")
        node, second = t[by_node] >> (bit + 1), (t[by_node] >> bit) & 1
        first_half = np.where(second == 0, w[by_node], 0)
        sums = np.cumsum(first_half)
        starts = np.flatnonzero(np.diff(node, prepend=-1))
        before = np.repeat(sums[starts] - first_half[starts], np.diff(np.append(starts, len(t))))
        found[by_node] += np.where(second == 1, sums - before, 0)
    above = np.empty(len(when), dtype=np.int64)
    above[high_first] = found
    return above


def _count_in_band(pdf: pd.DataFrame) -> pd.DataFrame:
    at, level, asks = (pdf[c].to_numpy() for c in ("at", "level", "asks"))
    # At one moment points come before records, so a record sees them; at one
    # level records come before points, so a record does not count itself.
    when = np.empty(len(pdf), dtype=np.int64)
    when[np.lexsort((asks, at))] = np.arange(len(pdf))
    above = weight_above(when, np.lexsort((-asks, -level)), pdf["weight"].to_numpy())
    return pd.DataFrame({"row": pdf["row"].to_numpy()[asks == 1], "above": above[asks == 1]})


def _entry(at: str, weight: int, asks: int) -> Column:
    return F.struct(F.col(at).alias("at"), F.lit(weight).alias("weight"), F.lit(asks).alias("asks"))


def rank_asof(
    df: DataFrame,
    key: str,
    seq: str,
    points: str,
    total: str = "total_score",
    rank: str = "current_rank",
    band: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running total per key and its 0-based rank among all keys at that record.

    Equal totals rank by key, the higher key first. ``seq`` is a distinct
    integer per record. ``band`` is the number of records per band; by default
    it grows with the square root of the record count, which keeps both the
    groups and the table of band sums far smaller than the data. A ``band`` below
    that root is widened to it, so the table of sums never outgrows the records.
    """
    count = df.count()
    tasks, many = tasks_for(df.sparkSession, count), tasks_for(df.sparkSession, 3 * count)
    cut = {"span": hot_rows, "hot_rows": hot_rows, "tasks": tasks}
    in_time = positions(running_sum(df, key, seq, points, total, **cut), [F.col(seq)], "_when", tasks)
    spans = shifted(in_time, key, "_when", F.col("_when"), "_until", back=False, **cut)
    placed = positions(spans, [F.col(total), F.col(key), F.col("_when")], "_level", tasks)
    band = max(band, math.isqrt(count)) if band else max(4096, 4 * math.isqrt(count))

    # Each record is two points and one question.
    entries = [_entry("_when", 1, asks=0), _entry("_until", -1, asks=0), _entry("_when", 0, asks=1)]
    both = (
        placed.select(F.col("_when").alias("row"), F.col("_level").alias("level"), F.explode(F.array(*entries)).alias("_e"))
        .select("row", "level", "_e.*")
        .filter(F.col("at").isNotNull())
        .withColumns({"time_band": F.expr(f"at div {band}"), "level_band": F.expr(f"level div {band}")})
    )
    columns = ["row", "at", "level", "weight", "asks"]
    found = "row long, above long"
    same_time = spread(both, ["time_band"], many).groupBy("time_band").applyInPandas(lambda p: _count_in_band(p[columns]), found)
    # Within a band of totals only earlier time bands count: a record asks at
    # the first moment of its own band, before that band's points.
    band_start = both.withColumn(
        "at", F.when(F.col("asks") == 1, 2 * F.col("time_band")).otherwise(2 * F.col("time_band") + 1)
    )
    same_level = spread(band_start, ["level_band"], many).groupBy("level_band").applyInPandas(lambda p: _count_in_band(p[columns]), found)

    last = (count - 1) // band if count else 0
    cells = both.groupBy("time_band", "level_band").agg(F.sum("weight").alias("net"))
    bands = F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))
    grid = (
        df.sparkSession.range(0, last + 1)
        .select(F.col("id").alias("time_band"), F.explode(bands).alias("level_band"))
        .join(cells, ["time_band", "level_band"], "left")
        .withColumn("net", F.coalesce("net", F.lit(0)))
    )
    earlier = Window.partitionBy("level_band").orderBy("time_band").rowsBetween(Window.unboundedPreceding, -1)
    higher = Window.partitionBy("time_band").orderBy(F.col("level_band").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = (
        grid.withColumn("net", F.coalesce(F.sum("net").over(earlier), F.lit(0)))
        .withColumn("above", F.coalesce(F.sum("net").over(higher), F.lit(0)))
        .select("time_band", "level_band", "above")
    )
    cell = ["time_band", "level_band"]
    asked = spread(both.filter("asks = 1").select("row", *cell), cell, tasks)
    far = asked.join(spread(sums, cell, tasks), cell)
    parts = same_time.union(same_level).union(far.select("row", "above"))
    ranks = spread(parts, ["row"], tasks).groupBy("row").agg(F.sum("above").alias(rank))
    placed = spread(placed, ["_when"], tasks)
    return placed.join(ranks, placed["_when"] == ranks["row"]).drop("_until", "_level", "_when", "row")

