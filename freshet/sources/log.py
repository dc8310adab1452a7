"""Message logs.

A log is a frame with the broker's record columns, so everything after the
source is the same for a topic, for a folder of records and for a batch read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.schemas import LOG


def topic_options(servers: str, topics: str, starting: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        **(extra or {}),
    }


def topic_stream(
    spark: SparkSession,
    servers: str,
    topics: str,
    starting: str = "latest",
    records_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic as a stream; needs Spark's Kafka connector on the class path."""
    settings = topic_options(servers, topics, starting, options)
    if records_per_trigger:
        settings["maxOffsetsPerTrigger"] = str(records_per_trigger)
    return spark.readStream.format("kafka").options(**settings).load()


def topic_replay(spark: SparkSession, servers: str, topics: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Everything a topic holds, from its first record, as a batch."""
    settings = topic_options(servers, topics, "earliest", {"endingOffsets": "latest", **(options or {})})
    return spark.read.format("kafka").options(**settings).load()


def folder_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Log records kept as Parquet files in a folder, as a stream."""
    reader = spark.readStream.schema(LOG)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def replay(log: DataFrame, start: Mapping[int, int] | None = None) -> DataFrame:
    """A log's records from given offsets on, by partition and offset.

    Partitions without an entry in ``start`` are read from the beginning.
    """
    kept = log
    for partition, offset in (start or {}).items():
        kept = kept.filter((F.col("partition") != partition) | (F.col("offset") >= offset))
    return kept.orderBy("partition", "offset")
