"""Keyed state of several variables: Spark's stateful processors.

A key may hold single values, lists and maps, each with a time to live if the
stream runs on processing time, and may set timers. State can begin from a table
of seeds, which is read once when the stream first starts, so nothing is joined
per micro-batch.

A micro-batch brings a key's rows in no order, so each call sorts them first;
what one call holds is bounded by the source's rows per trigger. Where one key
may hold a large part of a micro-batch, use ``freshet.streaming.carried``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from freshet.operators.decode import change_identity
from freshet.operators.ordered import listed
from freshet.operators.words import BLOCK_BYTES, WORD_BUCKETS, by_bucket, counted, from_bytes, ordinals, pieces, rows_of, texts_of, to_bytes

# The processors travel to the executors by value, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


BUCKETS = 64
KEY_BUCKETS = 256  # where there are as many keys as rows


@dataclass(frozen=True)
class States:
    """The variables of a key: schemas by name, for maps those of key and value, and times to live."""

    values: Mapping[str, str] = field(default_factory=dict)
    lists: Mapping[str, str] = field(default_factory=dict)
    maps: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    live_ms: Mapping[str, int] = field(default_factory=dict)


class Held:
    """The variables of the key at hand, and its timers."""

    def __init__(self, handle, states: States):
        live = lambda name: states.live_ms.get(name)
        self.value = {n: handle.getValueState(n, kind, live(n)) for n, kind in states.values.items()}
        self.list = {n: handle.getListState(n, kind, live(n)) for n, kind in states.lists.items()}
        self.map = {n: handle.getMapState(n, *kinds, live(n)) for n, kinds in states.maps.items()}
        self.timers = handle

    def get(self, name: str, default=None):
        """The only field of a value, or the default."""
        state = self.value[name]
        return state.get()[0] if state.exists() else default

    def put(self, name: str, value) -> None:
        self.value[name].update((value,))


Step = Callable[[tuple, pd.DataFrame, Held], "pd.DataFrame | None"]


class Steps(StatefulProcessor):
    """Calls ``step(key, sorted rows, held)`` per key and micro-batch; ``load`` puts a
    seed's row into state, ``expire(key, time, held)`` answers a timer."""

    def __init__(self, names: list, seeds: list, states: States, order: list, step: Step, load: Callable | None, expire: Callable | None):
        self.names, self.seeds, self.states, self.order = names, seeds, states, order
        self.step, self.load, self.expire = step, load, expire

    def init(self, handle) -> None:
        self.held = Held(handle, self.states)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks = list(rows)
        if chunks:
            together = pd.concat(chunks, ignore_index=True).rename(columns=dict(zip(numbered(self.names), self.names, strict=True)))
            made = self.step(key, together.sort_values(self.order, ignore_index=True), self.held)
            if made is not None:
                yield made

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.load(key, initialState.rename(columns=dict(zip(numbered(self.seeds), self.seeds, strict=True))), self.held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.expire:
            yield self.expire(key, expiredTimerInfo.getExpiryTimeInMs(), self.held)

    def close(self) -> None:
        pass


def numbered(names: Sequence[str]) -> list[str]:
    return [f"c{i}" for i in range(len(names))]


def process(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    out: T.StructType | str,
    step: Step,
    states: States,
    seed: DataFrame | None = None,
    load: Callable | None = None,
    expire: Callable | None = None,
    time: str = "None",
) -> DataFrame:
    """A stream through a stateful processor. ``time`` is None, ProcessingTime (times to
    live, timers) or EventTime (timers behind the watermark of ``df``). A stream on
    processing time waits for times to pass, so it has no end: start it unbounded."""
    keys = listed(keys)
    if time == "None" and states.live_ms:
        time = "ProcessingTime"
    # Rows reach a processor as named tuples, which not every column name fits.
    grouped = lambda rows: rows.toDF(*numbered(rows.columns)).groupBy(*(f"c{rows.columns.index(k)}" for k in keys))
    steps = Steps(df.columns, seed.columns if seed is not None else [], states, listed(order), step, load, expire)
    first = grouped(seed) if seed is not None else None
    return grouped(df).transformWithStateInPandas(steps, out, "Append", time, initialState=first)


def dealt(keys: Sequence[str], buckets: int) -> dict:
    """Columns that deal keys to buckets: the key as text and its bucket."""
    return {"_k": F.to_json(F.struct(*keys)), "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")}


def by_key(rows: pd.DataFrame, known) -> tuple[np.ndarray, list, list]:
    """For the rows of a bucket: the number of each row's key, the keys, and what ``known`` holds of them or None."""
    code, own = pd.factorize(rows["_k"])
    return code, own.tolist(), [known.getValue((k,)) for k in own]


def packed(known: pd.Series) -> bytes:
    """Numbers by key as one value of state: an Arrow table."""
    sink = pa.BufferOutputStream()
    made = pa.table({"k": pa.array(known.index, pa.string()), "n": pa.array(known.to_numpy())})
    with pa.ipc.new_stream(sink, made.schema) as writer:
        writer.write_table(made)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes | None, number: str) -> pd.Series:
    if value is None:
        return pd.Series([], index=pd.Index([], dtype=object), dtype=number)
    made = pa.ipc.open_stream(value).read_all()
    return pd.Series(made["n"].to_numpy(), index=pd.Index(made["k"].to_numpy(), dtype=object))


def running_total(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    value: str | None,
    out: str,
    kind: str = "long",
    seed: DataFrame | None = None,
    live_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Running sum of a column per key, or running count without a column; nulls add nothing.

    Keys are dealt to ``buckets``: one call serves all keys of a bucket. Their totals are one
    value of state, read and written once a micro-batch, as a request for each key takes far longer
    than its rows; so there should be more buckets where there are more keys.
    ``seed`` holds the keys and the totals ``out`` they begin with. A key that is not
    seen for ``live_ms`` is forgotten; the totals are a map then, as each has a time of its
    own. The number of buckets is fixed once a stream has begun.
    """
    keys, names = listed(keys), df.columns
    number = "float64" if kind in ("double", "float") else "int64"
    result = T.StructType([*df.schema.fields]).add(out, kind)
    places = dealt(keys, buckets)
    first = None if seed is None else seed.withColumns(places).select("_bucket", "_k", out)

    def summed(rows, code, before) -> pd.Series:
        # State takes values of its own type only; a column with nulls comes as fractions.
        steps = rows[value].fillna(0).astype(number) if value else pd.Series(np.ones(len(rows), dtype=np.int64))
        return steps.groupby(code).cumsum() + before[code]

    def load_packed(bucket, initial, held) -> None:
        seeds = pd.Series(initial[out].to_numpy().astype(number), index=pd.Index(initial["_k"], dtype=object))
        every = pd.concat([unpacked(held.get("totals"), number), seeds])
        held.put("totals", packed(every[~every.index.duplicated(keep="last")]))

    def step_packed(bucket, rows, held):
        known = unpacked(held.get("totals"), number)
        code, own = pd.factorize(rows["_k"])
        at = known.index.get_indexer(own)
        values = known.to_numpy().copy()
        sums = summed(rows, code, np.append(values, np.zeros(1, values.dtype))[at])
        last = np.zeros(len(own), sums.dtype)
        last[code] = sums.to_numpy()  # of a key's rows the last one stays
        values[at[at >= 0]] = last[at >= 0]
        held.put("totals", packed(pd.Series(np.append(values, last[at < 0]), index=known.index.append(pd.Index(own[at < 0], dtype=object)))))
        return rows[names].assign(**{out: sums})

    if not live_ms:
        states = States(values={"totals": "packed binary"})
        return process(df.withColumns(places), "_bucket", order, result, step_packed, states, first, load_packed)

    def load(bucket, initial, held) -> None:
        for k, total in zip(initial["_k"], initial[out].tolist(), strict=True):
            held.map["totals"].updateValue((k,), (total,))

    def step(bucket, rows, held):
        known = held.map["totals"]
        code, own, before = by_key(rows, known)
        sums = summed(rows, code, np.array([b[0] if b else 0 for b in before]))
        for k, total in zip(own, sums.groupby(code).last().tolist(), strict=True):
            known.updateValue((k,), (total,))
        return rows[names].assign(**{out: sums})

    states = States(maps={"totals": ("k string", f"total {kind}")}, live_ms={"totals": live_ms})
    return process(df.withColumns(places), "_bucket", order, result, step, states, first, load)


def running_words(df: DataFrame, seq: str, text: str, buckets: int = WORD_BUCKETS) -> DataFrame:
    """Every word of the texts with its count so far, as ``freshet.operators.words`` makes it of a batch.

    The words of a run of texts come to a bucket as one row, and its counts are one value of state.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, BLOCK_BYTES):
                for bucket, found, _ in by_bucket(piece, buckets):
                    one = {"bucket": [bucket], "first": [int(piece["seq"][0].as_py())], "words": [to_bytes(found)]}
                    yield pa.RecordBatch.from_pydict(one, schema=pa.schema({"bucket": pa.int32(), "first": pa.int64(), "words": pa.binary()}))

    def step(bucket, rows, held):
        known = unpacked(held.get("totals"), "int64")
        made, after = counted(from_bytes(rows["words"].tolist()), known)
        at = known.index.get_indexer(after.index)
        values = known.to_numpy().copy()
        values[at[at >= 0]] = after.to_numpy()[at >= 0]
        held.put("totals", packed(pd.Series(np.append(values, after.to_numpy()[at < 0]), index=known.index.append(after.index[at < 0]))))
        return pd.DataFrame({"rows": [to_bytes(made.slice(n, 1_000_000)) for n in range(0, made.num_rows, 1_000_000)]})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch["rows"]:
                yield from rows_of(from_bytes([value.as_py()]), seq)

    dealt_words = texts_of(df, seq, text).mapInArrow(pack, "bucket int, first long, words binary")
    made = process(dealt_words, "bucket", "first", "rows binary", step, States(values={"totals": "packed binary"}))
    return ordinals(made.mapInArrow(unpack, f"`{seq}` long, position int, word string, count long"), df, seq)


def latched(
    df: DataFrame, key: str, order: str | Sequence[str], failing: str, out: str, after: int, seed: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Whether the key was blocked when the record came in.

    A key is blocked once more than ``after`` of its records were ``failing`` (a boolean
    column, null is false), or from the start if it is in ``seed``. Keys are dealt to
    buckets as in ``running_total``.
    """
    names = [c for c in df.columns if c != failing]

    def load(bucket, initial, held) -> None:
        for k in initial["_k"]:
            held.map["known"].updateValue((k,), (0, True))

    def step(bucket, rows, held):
        known = held.map["known"]
        code, own, before = by_key(rows, known)
        begun = np.array([b[0] if b else 0 for b in before], np.int64)
        seeded = np.array([bool(b and b[1]) for b in before])
        fails = rows[failing].fillna(False).astype("int64")
        sums = fails.groupby(code).cumsum() + begun[code]
        failed = fails.groupby(code).sum().to_numpy()
        for k, more, total, blocked in zip(own, failed.tolist(), (begun + failed).tolist(), seeded.tolist(), strict=True):
            if more:  # without a failure the state stays as it is
                known.updateValue((k,), (total, blocked))
        return rows[names].assign(**{out: (sums - fails > after) | seeded[code]})

    states = States(maps={"known": ("k string", "fails long, blocked boolean")})
    result = T.StructType([f for f in df.schema.fields if f.name != failing]).add(out, "boolean")
    places = dealt([key], buckets)
    first = None
    if seed is not None:
        first = seed.select(key).filter(F.col(key).isNotNull()).distinct().withColumns(places).select("_bucket", "_k")
    return process(df.withColumns(places), "_bucket", order, result, step, states, first, load)


def first_written(
    df: DataFrame, key: str, order: str | Sequence[str], offered: str, out: str, seed: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The value that was first offered for the key, as it stood at each record.

    A record that offers a value where none is yet sets it, and sees it; so do the
    later ones of the same micro-batch. Null offers none. ``seed`` holds keys
    with values ``out`` set before the stream began. Keys are dealt to buckets as in ``running_total``.
    """
    names = df.columns

    def load(bucket, initial, held) -> None:
        for k, value in initial[["_k", out]].itertuples(index=False, name=None):
            held.map["set"].updateValue((k,), (value,))

    def step(bucket, rows, held):
        known = held.map["set"]
        code, own, before = by_key(rows, known)
        value = np.array([b[0] if b else None for b in before], object)
        since = np.where([b is not None for b in before], 0, len(rows))  # the row from which a key's value stands
        offers = rows[offered].dropna()
        firsts = offers[~pd.Series(code[offers.index], offers.index).duplicated()]
        for at, offer in zip(firsts.index, firsts.tolist(), strict=True):
            if since[code[at]] == len(rows):
                since[code[at]], value[code[at]] = at, offer
                known.updateValue((own[code[at]],), (offer,))
        stands = np.arange(len(rows)) >= since[code]
        return rows[names].assign(**{out: [v if s else None for v, s in zip(value[code], stands, strict=True)]})

    kind = df.schema[offered].dataType
    states = States(maps={"set": ("k string", T.StructType().add("set", kind))})
    result = T.StructType([*df.schema.fields]).add(out, kind)
    places, first = dealt([key], buckets), None
    if seed is not None:
        first = seed.select(key, out).filter(F.col(key).isNotNull() & F.col(out).isNotNull()).dropDuplicates([key])
        first = first.withColumns(places).select("_bucket", "_k", out)
    return process(df.withColumns(places), "_bucket", order, result, step, states, first, load)


def packed_stamps(keys: np.ndarray, stamps: np.ndarray) -> bytes:
    """Stamps of some numbers each by key as one value of state."""
    return to_bytes(pa.table([pa.array(keys, pa.string()), *map(pa.array, stamps.T)], ["k", *numbered(stamps.T)]))


def unpacked_stamps(value: bytes | None, numbers: int) -> tuple[np.ndarray, np.ndarray]:
    if value is None:
        return np.array([], object), np.empty((0, numbers), np.int64)
    made = pa.ipc.open_stream(value).read_all()
    return made["k"].to_numpy(), np.stack([made[c].to_numpy() for c in numbered(range(numbers))], axis=1)


def later(stamps: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each stamp comes after the known one: by its first number that differs."""
    found = np.zeros(len(stamps), bool)
    for new, old in zip(stamps.T[::-1], known.T[::-1], strict=True):
        found = (new > old) | ((new == old) & found)
    return found


STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def newest_changes(
    df: DataFrame, key: str, order: Sequence[str] = ("ts",), tombstone_ms: int | None = None, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Decoded change events to the newest state of each key, one row per key that a
    micro-batch has changed: ``_key`` as text, ``order``, ``deleted`` and ``after``.

    An event that is not newer than what is known, late or delivered again, changes
    nothing. Of deleted keys a tombstone stays, so a late event can't bring one back;
    after ``tombstone_ms`` it is given up. Events without a key, or with a null in ``order``,
    are left out. Keys are dealt to buckets as in ``running_total``, and the stamps of a
    bucket's keys are one value of state likewise, unless tombstones are given up.
    """
    whole, times = df.schema["after"].dataType, [df.schema[c] for c in order]
    stamped = T.StructType([T.StructField(f.name, T.LongType()) for f in times])
    kind = stamped.simpleString()[len("struct<") : -1].replace(":", " ")
    identity = change_identity(df, key).cast("string")
    rows = df.select(
        F.pmod(F.xxhash64(identity), F.lit(buckets)).cast("int").alias("bucket"),
        identity.alias("_key"),
        *(F.col(c).cast("long").alias(c) for c in order),
        (F.col("op") == "d").alias("deleted"),
        F.to_json("after", STAMP).alias("_row"),
    ).dropna(subset=["_key", *order])
    names = list(order)

    def step_packed(bucket, rows, held):
        newest = rows.drop_duplicates("_key", keep="last")
        own, stamps = newest["_key"].to_numpy(object), newest[names].to_numpy(np.int64)
        keys, known = unpacked_stamps(held.get("newest"), len(names))
        at = pd.Index(keys).get_indexer(own)
        there = np.flatnonzero(at >= 0)
        changed = at < 0
        changed[there] = later(stamps[there], known[at[there]])
        moved = there[changed[there]]
        known[at[moved]] = stamps[moved]
        if changed.any():
            held.put("newest", packed_stamps(np.append(keys, own[at < 0]), np.concatenate([known, stamps[at < 0]])))
        return newest[changed]

    def step(bucket, rows, held):
        alive, gone = held.map["alive"], held.map["gone"]
        newest = rows.drop_duplicates("_key", keep="last")
        changed = []
        for k, deleted, *stamp in newest[["_key", "deleted", *names]].itertuples(index=False, name=None):
            known, buried = alive.getValue((k,)), gone.getValue((k,))
            stamp = tuple(map(int, stamp))
            changed.append((known is None or stamp > tuple(known)) and (buried is None or stamp > tuple(buried)))
            if not changed[-1]:
                continue
            if deleted:
                gone.updateValue((k,), stamp)
                if known is not None:
                    alive.removeKey((k,))
            else:
                alive.updateValue((k,), stamp)
                if buried is not None:
                    gone.removeKey((k,))
        return newest[changed]

    if tombstone_ms:
        states = States(maps={"alive": ("k string", kind), "gone": ("k string", kind)}, live_ms={"gone": tombstone_ms})
    else:  # nothing is given up, so the stamps of all keys are kept alike
        states, step = States(values={"newest": "packed binary"}), step_packed
    made = process(rows, "bucket", names, rows.schema, step, states)
    kinds = [F.col(f.name).cast(f.dataType).alias(f.name) for f in times]
    return made.select("_key", *kinds, "deleted", F.from_json("_row", whole, STAMP).alias("after"))


def windowed_totals(
    df: DataFrame, keys: str | Sequence[str], ts: str, size_ms: int, value: str, out: str, watermark: str
) -> DataFrame:
    """The sum per key and tumbling window, given out by a timer once the watermark has
    passed the window's end, and then forgotten. A key's open windows are a map."""
    keys = listed(keys)
    rows = df.withWatermark(ts, watermark).select(*keys, ts, value)
    kinds = [rows.schema[k] for k in keys]
    result = T.StructType([*kinds]).add("window_end", "timestamp").add(out, "double")

    def step(key, rows, held):
        ends = (rows[ts].astype("datetime64[ns]").astype("int64") // 1_000_000 // size_ms + 1) * size_ms
        for end, total in rows[value].fillna(0).groupby(ends).sum().items():
            at = (int(end),)
            before = held.map["open"].getValue(at)[0] if held.map["open"].containsKey(at) else None
            if before is None:
                held.timers.registerTimer(int(end))
            held.map["open"].updateValue(at, (float(total) + (before or 0.0),))

    def expire(key, at, held):
        (total,) = held.map["open"].getValue((at,))
        held.map["open"].removeKey((at,))
        return pd.DataFrame([(*key, pd.Timestamp(at, unit="ms"), total)], columns=result.names)

    states = States(maps={"open": ("window_end long", "total double")})
    return process(rows, keys, ts, result, step, states, expire=expire, time="EventTime")
