"""Rows that come too late, kept instead of dropped."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.streaming.runs import Batch

LATE_BY = "late_by_us"


def split_late(time: str, delay: str, folder: str, on_time: Batch, late: Batch) -> Batch:
    """A micro-batch callback that parts late rows from the others.

    A row is late if its time lies before the watermark: the latest time of all micro-batches
    before its own, less ``delay`` (an interval such as ``10 minutes``). That is the rule by which
    Spark's stateful operators drop rows. Late rows get ``late_by_us``, the microseconds they
    lie behind. Rows without a time are on time. Each row goes to just one sink.

    The latest time is one row beside the checkpoint; batch n reads that of
    batch n-1, so a repeated batch is parted as it was the first time.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = None
            if batch_id > 0:
                before = spark.read.parquet(f"{folder}/{(batch_id - 1) % 2}").first()["latest"]
            at = F.unix_micros(F.col(time).cast("timestamp"))
            mark = F.lit(before).cast("long")
            limit = F.unix_micros(F.timestamp_micros(mark) - F.expr(f"INTERVAL {delay}"))
            behind = F.coalesce(at < limit, F.lit(False))
            on_time(kept.filter(~behind), batch_id)
            late(kept.filter(behind).withColumn(LATE_BY, limit - at), batch_id)
            latest = kept.agg(F.greatest(F.max(at), mark).alias("latest"))
            latest.write.mode("overwrite").parquet(f"{folder}/{batch_id % 2}")
        finally:
            kept.unpersist()

    return each
