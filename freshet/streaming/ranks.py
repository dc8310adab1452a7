"""Ranks among all keys on a stream, from counts that a micro-batch changes only where it falls.

All totals lie on a line that is cut into bands. Over the bands stands a tree of
counts: four levels, each of which tells 65,536 parts of its range apart. A key's
total is one member of its band and one in the count of each level above. When it
changes, the old place loses one and the new place gains one on each level.
A record's rank is what lies above its own part on every level, and the members of
its band that are higher; so it asks five nodes, however many keys there are.

Time is cut into slices of neighbouring ``seq``, at most 16,384 records each. What a
slice changes itself is counted within it. To the nodes above the bands a slice goes as
one row for each part it changes or asks for, so the topmost ones, in which all records
lie, see few rows; a band sees the records that fall in it. Changes and questions of one
micro-batch meet in their nodes in order, so a record sees those before it.

Totals are state by bucket of keys, as one value. Nodes are dealt to buckets too; a
node is one value of state. A call holds a bucket's narrow rows of one micro-batch, and
a band all members of some neighbouring totals, so there should be more of these than a few.
Sparse ``seq`` make slices of few records, which cost the topmost nodes a row for each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.ranking import weight_above
from freshet.operators.words import to_bytes
from freshet.streaming.processors import KEY_BUCKETS, States, packed, process, unpacked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAND_BITS = 4  # a band holds 16 neighbouring totals
LEVELS, DIGITS = 4, 4  # of four hexadecimal digits each
SLICE_BITS = 14
LAST = (1 << 63) - 1  # stands for a ``seq`` that is null
STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}

_SLICED = "slice long, level int, total long, name string, gain long, asks boolean, seq long, above long, record string"
_ANSWERS = "slice long, level int, total long, seq long, above long, record string"


def bucket_of(column: str | Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(KEY_BUCKETS)).cast("int").alias("_bucket")


def totals(df: DataFrame, key: str, seq: str, points: str, total: str) -> DataFrame:
    """Each record with its key's total after it and, from the second on, before it.

    Names come with a sign in front, so that none is null; a null one is the lowest.
    """

    def step(bucket, rows, held):
        known = unpacked(held.get("totals"), "int64")
        code, own = pd.factorize(rows["name"])
        at = known.index.get_indexer(own)
        values = known.to_numpy().copy()
        points = rows["points"].fillna(0).astype("int64")
        sums = (points.groupby(code).cumsum() + np.append(values, 0)[at][code]).to_numpy()
        last = np.zeros(len(own), np.int64)
        last[code] = sums  # of a key's rows the last one stays
        values[at[at >= 0]] = last[at >= 0]
        held.put("totals", packed(pd.Series(np.append(values, last[at < 0]), index=known.index.append(pd.Index(own[at < 0], dtype=object)))))
        first = (at < 0)[code] & ~pd.Series(code).duplicated().to_numpy()
        return rows[["name", "seq", "record"]].assign(total=sums, before=pd.arrays.IntegerArray(sums - points.to_numpy(), first))

    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    rows = df.select(
        name.alias("name"),
        F.col(seq).cast("long").alias("seq"),
        F.col(points).cast("long").alias("points"),
        F.to_json(F.struct(*df.columns), STAMP).alias("record"),
    ).withColumn("_bucket", bucket_of("name"))
    out = "name string, seq long, record string, total long, before long"
    return process(rows, "_bucket", "seq", out, step, States(values={"totals": "packed binary"}))


def nodes(total: Column) -> Column:
    """The nodes of a total, from the top to its band."""
    band = F.shiftright(total, BAND_BITS).bitwiseXOR(F.lit(-(1 << 63)))
    code = F.lpad(F.hex(band), LEVELS * DIGITS, "0")
    return F.array(*(F.struct(F.substring(code, 1, level * DIGITS).alias("node")) for level in range(LEVELS + 1)))


def part(total: np.ndarray, level: int) -> np.ndarray:
    """The lowest total of the part of a node that a total lies in; node and part are one to it."""
    low = BAND_BITS + 4 * DIGITS * (LEVELS - 1 - level)
    return total >> low << low


def _ranked(group: np.ndarray, at: np.ndarray, height: np.ndarray, name: np.ndarray, weight: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """For the rows that ask, the weight of their own group above them and not after them.

    A later group is a higher one as well, so no row of another group is both earlier and higher.
    At one moment changes come before questions, at one height questions before changes.
    """
    when = np.empty(len(at), np.int64)
    when[np.lexsort((asks, at, group))] = np.arange(len(at))
    return weight_above(when, np.lexsort((~asks, ~name, ~height, ~group)), weight)[asks == 1]


def _net(weight: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of weights of each."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    sums = np.add.reduceat(weight[order], starts, axis=0) if len(starts) else weight[:0]
    return *(k[starts] for k in keys), sums


def _coded(names: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of names in the order of the names, and the names by number."""
    found = names.dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    number = np.empty(len(order), np.int64)
    number[order.to_numpy()] = np.arange(len(order))
    return number[found.indices.to_numpy()], found.dictionary.take(order)


def _one(column: pa.ChunkedArray) -> pa.Array:
    made = column.combine_chunks()
    return pa.concat_arrays(made.chunks) if isinstance(made, pa.ChunkedArray) else made


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found) if found else None


def sliced(moved: DataFrame) -> DataFrame:
    """Changes and questions by slice of time, with what a record sees of its own slice.

    Records keep their places in their bands (the last level) and ask there; what they change
    is summed by slice, in bands by place, in the nodes above by part.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is None:
            return
        seq = pc.fill_null(table["seq"], LAST).to_numpy()
        own, total = seq >> SLICE_BITS, table["total"].to_numpy()
        name, names = _coded(_one(table["name"]))
        moves = pc.is_valid(table["before"]).to_numpy()
        before = pc.fill_null(table["before"], 0).to_numpy()[moves]
        n, k = len(seq), len(before)
        slices, heights, by = np.append(own, own[moves]), np.append(total, before), np.append(name, name[moves])
        gain = np.repeat(np.array([1, -1], np.int64), [n, k])
        asks = np.repeat(np.array([0, 1], np.int64), [n + k, n])
        above = _ranked(
            np.append(slices, own), np.concatenate([seq, seq[moves], seq]), np.append(heights, total), np.append(by, name),
            np.append(gain, np.zeros(n, np.int64)), asks,
        )
        yield from made(own, LEVELS, total, table["name"], 0, True, table["seq"], above, table["record"])
        s, t, b, net = _net(gain, slices, heights, by)
        s, t, b, net = (c[net != 0] for c in (s, t, b, net))
        yield from made(s, LEVELS, t, names.take(pa.array(b)), net, False)
        for level in range(LEVELS):
            counts = np.stack([np.append(gain, np.zeros(n, np.int64)), asks], axis=1)
            s, t, sums = _net(counts, np.append(slices, own), part(np.append(heights, total), level))
            net, asked = sums.T
            kept = (net != 0) | (asked > 0)
            yield from made(s[kept], level, t[kept], "", net[kept], asked[kept] > 0)

    def made(slices, level, total, name, gain, asks, seq=None, above=0, record=None) -> Iterator[pa.RecordBatch]:
        kinds = {"slice": pa.int64(), "level": pa.int32(), "total": pa.int64(), "name": pa.string(), "gain": pa.int64(), "asks": pa.bool_()}
        kinds |= {"seq": pa.int64(), "above": pa.int64(), "record": pa.string()}
        columns = []
        for value, kind in zip((slices, level, total, name, gain, asks, seq, above, record), kinds.values(), strict=True):
            one = value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value, kind) if isinstance(value, np.ndarray) else pa.repeat(pa.scalar(value, kind), len(slices))
            columns.append(one)
        yield from pa.table(columns, pa.schema(kinds)).to_batches(max_chunksize=100_000)

    own = F.shiftright(F.coalesce("seq", F.lit(LAST)), SLICE_BITS)
    return moved.select("name", "seq", "record", "total", "before").repartition(own).mapInArrow(cut, _SLICED)


def answers(placed: DataFrame) -> DataFrame:
    """How many lie above, by slice: for records in their bands, with what they saw of their slice; for parts in their nodes."""

    def step(bucket, rows, held):
        known = held.map["nodes"]
        code, own = pd.factorize(rows["node"])
        before = [known.getValue((n,)) for n in own]
        tables = [pa.ipc.open_stream(b[0]).read_all() if b else None for b in before]
        sizes = [t.num_rows if t else 0 for t in tables]
        there = pa.concat_tables([t for t in tables if t]) if any(sizes) else pa.table({"t": pa.array([], pa.int64()), "name": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        held_by, m = np.repeat(np.arange(len(own)), sizes), there.num_rows
        name, names = _coded(pa.concat_arrays([_one(there["name"]), pa.array(rows["name"], pa.string())]))
        height, gain, asking = rows["total"].to_numpy(np.int64), rows["gain"].to_numpy(np.int64), rows["asks"].to_numpy(bool)
        at, moves = rows["slice"].to_numpy(np.int64), gain != 0

        # A question sees the slices before its own, and what was there before them.
        def joined(base, own):
            return np.concatenate([base, own[moves], own[asking]])

        above = _ranked(
            joined(held_by, code),
            np.concatenate([np.full(m, np.iinfo(np.int64).min), 2 * at[moves] + 1, 2 * at[asking]]),
            joined(there["t"].to_numpy(), height),
            joined(name[:m], name[m:]),
            np.concatenate([there["n"].to_numpy(), gain[moves], np.zeros(asking.sum(), np.int64)]),
            np.repeat(np.array([0, 1], np.int64), [m + moves.sum(), asking.sum()]),
        )
        changed = np.zeros(len(own), bool)
        changed[code[moves]] = True
        node, t, b, n = _net(
            np.append(there["n"].to_numpy(), gain[moves]), np.append(held_by, code[moves]),
            np.append(there["t"].to_numpy(), height[moves]), np.append(name[:m], name[m:][moves]),
        )
        node, t, b, n = (c[n != 0] for c in (node, t, b, n))
        after = pa.table({"t": t, "name": names.take(pa.array(b)), "n": n})
        ends = np.searchsorted(node, np.arange(len(own) + 1))
        for i in np.flatnonzero(changed).tolist():
            if ends[i] < ends[i + 1]:
                known.updateValue((own[i],), (to_bytes(after.slice(ends[i], ends[i + 1] - ends[i])),))
            elif before[i]:
                known.removeKey((own[i],))
        asked = rows[asking]
        return asked[["slice", "level", "total", "seq"]].assign(above=asked["above"] + above, record=asked["record"])

    return process(placed, "_bucket", "slice", _ANSWERS, step, States(maps={"nodes": ("node string", "packed binary")}))


def rank_parts(df: DataFrame, key: str, seq: str, points: str, total: str = "total_score") -> DataFrame:
    """The stream's part of a rank: answers for each record and slice, for ``ranks`` to add up.

    ``seq`` is a distinct integer per record and ``points`` are whole numbers.
    """
    rows = sliced(totals(df, key, seq, points, total))
    at = nodes(F.col("total"))
    upper = F.element_at(F.slice(at, 1, LEVELS), F.col("level") + 1)
    node = F.when(F.col("level") == LEVELS, at[LEVELS]["node"]).otherwise(upper["node"])
    return answers(rows.withColumn("node", node).withColumn("_bucket", bucket_of("node")))


def ranks(parts: DataFrame, schema: T.StructType, total: str = "total_score", rank: str = "current_rank") -> DataFrame:
    """The records of one micro-batch with total and rank, from the answers to them and to their slices."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _whole(batches)
        if table is None:
            return
        level = table["level"].to_numpy()
        own = table.filter(pa.array(level == LEVELS))
        slices, height, above = (own[c].to_numpy() for c in ("slice", "total", "above"))
        for n in range(LEVELS):
            asked = table.filter(pa.array(level == n))
            known = pd.MultiIndex.from_arrays([asked["slice"].to_numpy(), asked["total"].to_numpy()])
            above = above + asked["above"].to_numpy()[known.get_indexer(pd.MultiIndex.from_arrays([slices, part(height, n)]))]
        made = pa.table({"_record": own["record"], "_total": height, "_rank": above})
        seq = pc.fill_null(own["seq"], LAST).to_numpy()
        if len(np.unique(seq)) < len(seq):  # records of one ``seq`` are one
            made = made.append_column("seq", pa.array(seq)).group_by("seq").aggregate([("_record", "max"), ("_total", "max"), ("_rank", "sum")])
            made = made.select(["_record_max", "_total_max", "_rank_sum"]).rename_columns(["_record", "_total", "_rank"])
        yield from made.to_batches(max_chunksize=100_000)

    added = parts.repartition("slice").mapInArrow(add, "_record string, _total long, _rank long")
    rows = added.select(F.from_json("_record", schema, STAMP).alias("_r"), "_total", "_rank")
    return rows.select("_r.*", F.col("_total").alias(total), F.col("_rank").alias(rank))
