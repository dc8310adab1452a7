"""Row collections and generated rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows(spark: SparkSession, data: Iterable, schema: T.StructType | str) -> DataFrame:
    """A small collection as a frame with a declared schema."""
    return spark.createDataFrame(list(data), schema)


def rate(spark: SparkSession, rows_per_second: int = 5) -> DataFrame:
    """An endless stream of timestamp and rising value."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def rate_per_batch(spark: SparkSession, rows_per_batch: int, start_ms: int = 0, step_ms: int = 1000) -> DataFrame:
    """The same with a fixed number of rows per micro-batch."""
    return (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", rows_per_batch)
        .option("startTimestamp", start_ms)
        .option("advanceMillisPerBatch", step_ms)
        .load()
    )


def sequence(spark: SparkSession, start: int, end: int, low: int, high: int, seed: int = 0) -> DataFrame:
    """Ids from start to end, each with a random whole number in low..high."""
    value = (F.floor(F.rand(seed) * (high - low + 1)) + low).cast("int")
    return spark.range(start, end + 1).withColumn("val", value)
