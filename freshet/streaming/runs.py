"""Starting streams and writing their micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from freshet.sinks.tables import append_batch, replace_snapshot
from freshet.sinks.versions import write_snapshot

Batch = Callable[[DataFrame, int], None]


def start(writer: DataStreamWriter, bounded: bool = True, every: str | None = None) -> StreamingQuery:
    """Starts a stream: to the end of what is there now, or endlessly."""
    if bounded:
        return writer.trigger(availableNow=True).start()
    return (writer.trigger(processingTime=every) if every else writer).start()


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Waits for a bounded stream, at most the given time, then stops it."""
    try:
        query.awaitTermination(seconds) if seconds else query.awaitTermination()
    finally:
        query.stop()


def to_archive(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only Parquet folder, each row once."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint
    )


def to_documents(
    df: DataFrame, root: str, resource: str, checkpoint: str, connector: str | None = None, **options
) -> DataStreamWriter:
    """Append-only document folder, or a document store's connector."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if connector:
        return writer.format(connector).options(**options).option("path", resource)
    return writer.format("json").option("path", f"{root}/{resource}")


def to_batches(df: DataFrame, each: Batch, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """Calls ``each(batch, batch_id)`` for every micro-batch."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)


def to_changes(df: DataFrame, path: str, checkpoint: str, mode: str = "update") -> DataStreamWriter:
    """The updated rows of every micro-batch, kept by batch number."""
    return to_batches(df, lambda batch, n: append_batch(batch, path, n), checkpoint, mode)


def to_snapshot(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The whole result after every micro-batch, in place of the last one."""
    return to_batches(df, lambda batch, n: replace_snapshot(batch, path), checkpoint, "complete")


def to_versions(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """The same as versions, read by ``read_snapshot``: the last one stays until the next is whole."""
    return to_batches(df, lambda batch, n: write_snapshot(batch, path), checkpoint, "complete")


def to_console(df: DataFrame, mode: str = "append", truncate: bool = False) -> DataStreamWriter:
    return df.writeStream.format("console").outputMode(mode).option("truncate", truncate)


def fan_out(*sinks: Batch) -> Batch:
    """One micro-batch to several sinks, computed once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return each


def per_batch(transform: Callable[[DataFrame], DataFrame], sink: Batch) -> Batch:
    """Applies a batch transform to every micro-batch on its own."""
    return lambda batch, batch_id: sink(transform(batch), batch_id)
