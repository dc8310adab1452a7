"""What a plan is, and how it runs on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from freshet.operators.decode import decode_json
from freshet.sinks.tables import append_batch
from freshet.streaming import runs
from freshet.streaming.runs import Batch

PLANS: dict[str, "Plan"] = {}


@dataclass(frozen=True)
class Plan:
    """A transform with the schema it reads.

    ``mode`` says how its stream is written: append, update and complete are
    Spark's output modes; per_batch applies the transform to each micro-batch
    alone; carried does so with the state of the one before; batch has no stream
    form. ``on_stream`` replaces the transform on a stream where keyed state is
    needed. ``on_batches(folder, sink)`` makes the callback for carried state.
    ``finish(batch, schema)`` makes rows of each micro-batch that ``on_stream`` gives,
    where those are parts of rows.
    ``keep`` names the log columns the transform reads besides the payload.
    """

    name: str
    schema: T.StructType
    transform: Callable[..., DataFrame]
    mode: str = "append"
    on_stream: Callable[..., DataFrame] | None = None
    keep: tuple[str, ...] = ()
    on_batches: Callable[..., Batch] | None = None
    finish: Callable[[DataFrame, T.StructType], DataFrame] | None = None

    def run(self, df: DataFrame, **tables) -> DataFrame:
        """The plan on decoded rows."""
        return (self.on_stream or self.transform if df.isStreaming else self.transform)(df, **tables)

    def run_log(self, log: DataFrame, **tables) -> DataFrame:
        """The plan on log records with JSON payloads."""
        return self.run(decode_json(log, self.schema, keep=self.keep), **tables)

    def run_documents(self, log: DataFrame, whole: bool = False, **tables) -> DataFrame:
        """The plan on log records, as documents.

        A document holds the payload's text, the columns the plan has added and
        the payload's declared fields as ``parsed_data``; with ``whole`` that is a
        variant with the undeclared ones too.
        """
        payload = self.schema.names
        text = log.withColumn("value", F.col("value").cast("string"))
        decoded = decode_json(text, self.schema, keep=["value", *self.keep])
        done = self.run(decoded, **tables)
        added = [c for c in done.columns if c not in ("value", *self.keep, *payload)]
        data = F.try_parse_json("value") if whole else F.struct(*payload)
        return done.select("value", *added, data.alias("parsed_data"))

    def write(
        self, stream: DataFrame, path: str, checkpoint: str, keyed_state: bool = False, **tables
    ) -> DataStreamWriter:
        """A stream of decoded rows through the plan into a Parquet folder.

        Plans with state per key carry it between micro-batches, which is safe
        for hot keys. ``keyed_state`` uses Spark's state store instead: better
        for very many keys of which none is hot.
        """
        if self.mode == "batch":
            raise ValueError(f"{self.name} has no stream form")
        if self.on_batches and not (keyed_state and self.on_stream):
            each = self.on_batches(f"{checkpoint}-carried", lambda b, n: append_batch(b, path, n), **tables)
            return runs.to_batches(stream, each, checkpoint)
        if self.finish:
            whole = lambda batch: self.finish(batch, stream.schema)
            each = runs.per_batch(whole, lambda b, n: append_batch(b, path, n))
            return runs.to_batches(self.run(stream, **tables), each, checkpoint)
        if self.mode == "per_batch":
            each = runs.per_batch(lambda batch: self.transform(batch, **tables), lambda b, n: append_batch(b, path, n))
            return runs.to_batches(stream, each, checkpoint)
        result = self.run(stream, **tables)
        if self.mode == "complete":
            return runs.to_snapshot(result, path, checkpoint)
        return runs.to_changes(result, path, checkpoint, self.mode)


def plan(
    schema: T.StructType,
    mode: str = "append",
    on_stream: Callable[..., DataFrame] | None = None,
    keep: tuple[str, ...] = (),
    on_batches: Callable[..., Batch] | None = None,
    finish: Callable[[DataFrame, T.StructType], DataFrame] | None = None,
):
    """Registers a transform as the plan of its name."""

    def register(transform: Callable[..., DataFrame]) -> Plan:
        made = Plan(transform.__name__, schema, transform, mode, on_stream, keep, on_batches, finish)
        PLANS[made.name] = made
        return made

    return register
