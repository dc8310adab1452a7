"""Keyed state on streams: the stream form of the ordered operators.

Keys are dealt to buckets, and a call serves all keys of a bucket. A micro-batch
brings rows in no particular order, so each call sorts the bucket's rows of that
micro-batch by ``seq`` before it moves the states on. What one
call holds is bounded by the size of a micro-batch, which the source sets
(records or files per trigger). The state itself is one small row per key.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from freshet.operators.windows import with_window
from freshet.streaming.processors import BUCKETS, States, by_key, dealt, process, running_total

# The state functions travel to the executors by value, so the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# step(sorted rows, number of each row's key, states of the keys) -> (new column, states after)
Step = Callable[[pd.DataFrame, np.ndarray, list], "tuple[pd.Series, list]"]


def keyed(
    df: DataFrame, keys: Sequence[str], seq: str, step: Step, out: str, kind: str, state: str, empty: tuple, buckets: int = BUCKETS
) -> DataFrame:
    """Adds the column that ``step`` makes of a bucket's sorted rows and the states of their keys.

    Keys are dealt to buckets, so a micro-batch has one call per bucket and not one per key.
    """
    names = df.columns

    def call(bucket, rows: pd.DataFrame, held) -> pd.DataFrame:
        code, own, known = by_key(rows, held.map["state"])
        before = [empty if k is None else tuple(k) for k in known]
        made, after = step(rows, code, before)
        for k, old, new in zip(own, known, after, strict=True):
            if old is None or tuple(old) != new:
                held.map["state"].updateValue((k,), new)
        return rows[names].assign(**{out: made})

    states = States(maps={"state": ("k string", state)})
    result = T.StructType([*df.schema.fields]).add(out, kind)
    return process(df.withColumns(dealt(keys, buckets)), "_bucket", seq, result, call, states)


def running_sum_stream(
    df: DataFrame, keys: Sequence[str], seq: str, value: str | None, out: str, kind: str = "long"
) -> DataFrame:
    """Running sum of a column per key, or running count without a column."""
    return running_total(df, keys, seq, value, out, kind)


def _lasts(values: pd.Series, code: np.ndarray) -> list:
    """The last value of each key in the order of their numbers, null or not."""
    return pd.Series(values.to_numpy(), code)[~pd.Series(code).duplicated(keep="last").to_numpy()].sort_index().tolist()


def changed_stream(df: DataFrame, key: str, seq: str, column: str, out: str) -> DataFrame:
    """Whether a text column differs from the key's record before."""

    def step(rows: pd.DataFrame, code: np.ndarray, states: list) -> tuple[pd.Series, list]:
        now, first = rows[column].astype(object), ~pd.Series(code).duplicated()
        before = now.groupby(code).shift(1).where(~first, pd.Series([s[0] for s in states], dtype=object).reindex(code).to_numpy())
        flag = before.notna() & now.notna() & (before != now)
        return flag, [(None if pd.isna(v) else v,) for v in _lasts(now, code)]

    return keyed(df, [key], seq, step, out, "boolean", "last string", (None,))


def latched_stream(
    df: DataFrame, key: str, seq: str, status: str, failed: str, out: str, after: int, seeded: str | None = None
) -> DataFrame:
    """Whether the key was blocked when the record came in.

    ``seeded`` names a boolean column that marks keys blocked from the start.
    """

    def step(rows: pd.DataFrame, code: np.ndarray, states: list) -> tuple[pd.Series, list]:
        fails = (rows[status] == failed).astype("int64")
        sums = fails.groupby(code).cumsum() + np.array([s[0] for s in states], np.int64)[code]
        blocked = sums - fails > after
        if seeded:
            blocked = blocked | rows[seeded].fillna(False).astype(bool)
        return blocked, [(n,) for n in _lasts(sums, code)]

    return keyed(df, [key], seq, step, out, "boolean", "fails long", (0,))


def _folded(values: pd.Series, before: float | None) -> pd.Series:
    """The fold after each value: an exponential mean of weight 1/2 that starts
    at the state so far, or at the first value. Nulls leave it as it is."""
    values = values.astype("float64").reset_index(drop=True)
    if before is None:
        return values.ewm(alpha=0.5, adjust=False, ignore_na=True).mean()
    with_state = pd.concat([pd.Series([before]), values], ignore_index=True)
    return with_state.ewm(alpha=0.5, adjust=False, ignore_na=True).mean().iloc[1:].reset_index(drop=True)


def _or_none(value: float) -> float | None:
    return None if pd.isna(value) else float(value)


def halving_fold_stream(df: DataFrame, keys: Sequence[str], seq: str, value: str, out: str) -> DataFrame:
    """The fold s = (s + v) / 2 after each record of its key."""

    def step(rows: pd.DataFrame, code: np.ndarray, states: list) -> tuple[pd.Series, list]:
        # Every key's state stands in front of its values; where there is none, the first value begins.
        values = pd.Series([s[0] for s in states] + rows[value].tolist(), dtype="float64")
        both = pd.DataFrame({"code": np.concatenate([np.arange(len(states)), code]), "v": values})
        means = both.groupby("code")["v"].ewm(alpha=0.5, adjust=False, ignore_na=True).mean()
        folded = means.droplevel(0).sort_index().iloc[len(states) :].reset_index(drop=True)
        return folded, [(_or_none(v),) for v in _lasts(folded, code)]

    return keyed(df, keys, seq, step, out, "double", "folded double", (None,))


def windowed_fold_stream(
    df: DataFrame, ts: str, size: str, keys: Sequence[str], seq: str, value: str, out: str, watermark: str
) -> DataFrame:
    """The fold s = (s + v) / 2 per key and window, once the watermark has passed the window.

    A window's state is one number, dropped when its result goes out.
    """
    groups = ["window_start", "window_end", *keys]
    rows = with_window(df.withWatermark(ts, watermark), ts, size).select(*groups, ts, seq, value)
    result = T.StructType([rows.schema[c] for c in groups]).add(out, "double")
    names = result.names

    def call(key: tuple, chunks: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            (folded,) = held.get
            held.remove()
            yield pd.DataFrame([(*key, folded)], columns=names)
            return
        rows = pd.concat(list(chunks), ignore_index=True).sort_values(seq)
        folded = _folded(rows[value], held.get[0] if held.exists else None)
        held.update((_or_none(folded.iloc[-1]),))
        held.setTimeoutTimestamp(pd.Timestamp(key[1]).value // 1_000_000)  # the window's end, in ms

    state = T.StructType().add("folded", "double")
    grouped = rows.groupBy(*groups)
    return grouped.applyInPandasWithState(call, result, state, "append", GroupStateTimeout.EventTimeTimeout)
