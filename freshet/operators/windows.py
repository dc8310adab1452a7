"""Event-time windows; the same call serves batch and streaming frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Named aggregates per window and key, as window_start and window_end.

    On a stream ``watermark`` bounds the state and drops older records. Without
    it every window is kept for good.
    """
    if watermark is not None and df.isStreaming:
        df = df.withWatermark(ts, watermark)
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(span, *keys).agg(*(c.alias(name) for name, c in aggs.items()))
    return flatten_window(grouped)


def flatten_window(df: DataFrame) -> DataFrame:
    """Replaces the window struct by its two ends, for tabular sinks."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def with_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Adds the ends of the tumbling window each row falls in."""
    span = F.window(ts, size)
    return df.withColumns({"window_start": span["start"], "window_end": span["end"]})
