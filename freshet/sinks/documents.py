"""Document folders or indexes, and message topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from freshet.operators.decode import encode_json


def write_documents(
    df: DataFrame,
    root: str,
    resource: str,
    mode: str = "overwrite",
    connector: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Writes rows as JSON documents to root/resource.

    With ``connector`` (a data source on the class path) the resource is the
    place in that store, under the options given, and ``root`` is not used.
    """
    if connector:
        df.write.format(connector).options(**(options or {})).mode(mode).save(resource)
    else:
        df.write.mode(mode).json(f"{root}/{resource}")


def append_documents(df: DataFrame, root: str, resource: str, batch_id: int) -> None:
    """Adds a micro-batch of documents; a second delivery overwrites the first."""
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .json(f"{root}/{resource}")
    )


def publish_options(
    servers: str,
    topic: str,
    acks: str = "all",
    retries: int = 5,
    linger_ms: int = 50,
    batch_size: int = 64000,
    compression: str = "gzip",
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.retries": str(retries),
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_size),
        "kafka.compression.type": compression,
    }


def publish(
    df: DataFrame, servers: str, topic: str, key: str | None = None, columns: Sequence[str] | None = None, **settings
) -> None:
    """Sends rows as keyed JSON messages; needs Spark's Kafka connector."""
    messages = encode_json(df, key, columns)
    messages.write.format("kafka").options(**publish_options(servers, topic, **settings)).save()


def publish_stream(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    key: str | None = None,
    columns: Sequence[str] | None = None,
    **settings,
) -> DataStreamWriter:
    messages = encode_json(df, key, columns)
    return (
        messages.writeStream.format("kafka")
        .options(**publish_options(servers, topic, **settings))
        .option("checkpointLocation", checkpoint)
    )
