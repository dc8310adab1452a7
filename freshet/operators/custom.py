"""A user's own Python functions over rows, groups and tables, in Arrow batches.

They are for what no expression says; an expression is always the faster form.
Types are declared, functions see no null unless they ask for it, and no
function is handed a group without a bound on its rows:

* ``row_function`` - values to values, also in SQL once registered;
* ``flat_function`` - values to any number of rows, also in SQL;
* ``fold_groups`` - an aggregate from parts that can be merged, for groups of any size;
* ``apply_groups`` - whole groups of at most ``MOST_ROWS`` rows;
* ``apply_batches`` - groups of any size, a batch at a time.

Functions are sent to the executors by value, so a function defined inside
another one needs no module there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from freshet.operators.aggregates import with_keys
from freshet.operators.ordered import listed

MOST_ROWS = 1_000_000  # rows of a group that one call may hold
HELD_STATES = 50_000  # states a task holds before it merges and hands them on
MERGED_AT_ONCE = 64  # states of one group that a task gathers before it merges them


def declared(returns: str | T.DataType) -> T.DataType:
    return T.DataType.fromDDL(returns) if isinstance(returns, str) else returns


def columns_of(returns: str | T.StructType) -> tuple[T.StructType, pa.Schema]:
    kind = declared(returns)
    return kind, to_arrow_schema(kind)


def row_function(f: Callable[..., pd.Series], returns: str | T.DataType, nulls: bool = False):
    """A function of columns; ``spark.udf.register(name, it)`` makes it known to SQL.

    ``f`` takes one Series per column and returns as many values as it got. Rows
    with a null in any argument do not reach it and give null. With ``nulls`` they
    do, in Series of Arrow types, which tell null from NaN. A result of another
    length is an error.
    """
    kind = to_arrow_type(declared(returns))

    def run(*columns: pa.Array) -> pa.Array:
        if nulls:
            given = [c.to_pandas(types_mapper=pd.ArrowDtype) for c in columns]
            wanted = len(columns[0])
        else:
            present = columns[0].is_valid()
            for c in columns[1:]:
                present = pc.and_(present, c.is_valid())
            given = [c.filter(present).to_pandas() for c in columns]
            wanted = len(given[0])
        made = f(*given) if wanted else []
        if len(made) != wanted:
            raise ValueError(f"the function returned {len(made)} values for {wanted} rows")
        made = pa.array(made, kind, from_pandas=True)
        return made if nulls else pc.replace_with_mask(pa.nulls(len(columns[0]), kind), present, made)

    return F.arrow_udf(run, declared(returns))


def flat_function(f: Callable[..., Iterator[tuple]], returns: str | T.StructType):
    """A table function; ``spark.udtf.register(name, it)`` makes it known to SQL.

    ``f`` takes the values of one row and gives tuples of the declared columns.
    A row with a null among its values gives no rows.
    """

    class Rows:
        def eval(self, *values):
            if all(v is not None for v in values):
                yield from f(*values)

    return F.udtf(Rows, returnType=declared(returns), useArrow=True)


def flat_rows(df: DataFrame, f: Callable[..., Iterator[tuple]], columns: str | Sequence[str], returns: str | T.StructType) -> DataFrame:
    """The rows of ``df``, each once for every tuple that ``f`` makes of its columns; those without any are left out."""
    kind = declared(returns)
    both = {c.lower() for c in df.columns} & {n.lower() for n in kind.names}
    if both:
        raise ValueError(f"columns of these names are there already: {sorted(both)}")
    return df.lateralJoin(flat_function(f, kind)(*(F.col(c).outer() for c in listed(columns))))


def fold_groups(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: str | Sequence[str],
    part: Callable[[pd.DataFrame], tuple],
    merge: Callable[[pd.DataFrame], tuple],
    state: str | T.StructType,
    **named: Column,
) -> DataFrame:
    """A user's aggregate of each group, whatever its size.

    ``part`` makes a state, a tuple of the columns of ``state``, of some rows of a group, and
    ``merge`` one state of a frame of states (Python's values, None for null). They must agree for every way to cut
    and order a group. The rows of a group are brought together first, so ``part`` is called once
    or twice for a small group and not once for every batch that holds a row of it; partitions
    that a hot group swells are split, as states can be merged. A group is merged a
    batch at a time. ``named`` are results over the columns of the state; without any these are the result.

    Null keys form no group. ``part`` sees the rows as they are: a null in a
    whole-number column makes it a column of objects with None, so no number
    is rounded. An empty table has no groups.
    """
    keys, columns = listed(keys), listed(columns)
    kind, arrow = columns_of(state)
    width, names, at_once, most = len(keys), kind.names, MERGED_AT_ONCE, HELD_STATES
    key_names = [f"_key_{i}" for i in range(width)]
    state_names = [f"_state_{i}" for i in range(len(names))]
    picked = [F.col(k).alias(n) for k, n in zip(keys, key_names, strict=True)]
    rows = with_keys(df, keys).select(*picked, *(F.col(c).alias(f"_value_{i}") for i, c in enumerate(columns)))
    key_kinds = T.StructType(rows.schema.fields[:width])
    out = T.StructType([*key_kinds.fields, *(T.StructField(n, f.dataType) for n, f in zip(state_names, kind.fields, strict=True))])
    out_arrow = to_arrow_schema(out)

    def one_of(states: list[tuple]) -> tuple:
        return states[0] if len(states) == 1 else tuple(merge(pd.DataFrame(states, columns=names, dtype=object)))

    def handed_on(held: dict) -> pa.RecordBatch:
        made = [(*key, *one_of(states)) for key, states in held.items()]
        arrays = [pa.array(c, f.type, from_pandas=True) for c, f in zip(zip(*made, strict=True), out_arrow, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=out_arrow)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            frame = batch.to_pandas(integer_object_nulls=True, date_as_object=True)
            values = frame.iloc[:, width:].set_axis(columns, axis=1)
            for key, places in frame.groupby(key_names, sort=False, dropna=False).indices.items():
                states = held.setdefault(key if width > 1 else (key,), [])
                states.append(tuple(part(values.iloc[places])))
                if len(states) >= at_once:
                    states[:] = [one_of(states)]
            if len(held) >= most:
                yield handed_on(held)
                held = {}
        if held:
            yield handed_on(held)

    def merged(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, last = next(batches), next(batches, None), None
        if second is None and first.num_rows == 1:  # most groups have one state
            yield first.select(out.names)
            return
        for batch in chain([first] if second is None else [first, second], batches):
            states = batch.select(state_names).to_pandas(integer_object_nulls=True, date_as_object=True)
            found = list(states.itertuples(index=False, name=None))
            last = one_of(found if last is None else [last, *found])
        arrays = [pa.array([v], f.type, from_pandas=True) for v, f in zip(last, arrow, strict=True)]
        yield pa.RecordBatch.from_arrays([*first.slice(0, 1).select(key_names).columns, *arrays], names=[*key_names, *state_names])

    together = rows.hint("rebalance", *key_names).sortWithinPartitions(*key_names)
    whole = together.mapInArrow(parts, out).groupBy(*key_names).applyInArrow(merged, out)
    states = whole.select(*(F.col(n).alias(k) for k, n in zip(keys, key_names, strict=True)), *(F.col(s).alias(n) for s, n in zip(state_names, names, strict=True)))
    return states.select(*keys, *(c.alias(n) for n, c in named.items())) if named else states


def apply_groups(
    df: DataFrame, keys: str | Sequence[str], f: Callable[[pd.DataFrame], pd.DataFrame], returns: str | T.StructType, most_rows: int = MOST_ROWS
) -> DataFrame:
    """The keys and the rows that ``f`` makes of each whole group, of the declared columns.

    Groups are counted first, by one aggregate over the keys; one above ``most_rows``
    is an error before any is handed to a call. ``fold_groups`` and ``apply_batches``
    take groups of any size. Null keys form no group; rows come in no order;
    whole numbers with nulls come as objects.
    """
    keys = listed(keys)
    kind, arrow = columns_of(returns)
    rows = with_keys(df, keys)
    largest = rows.groupBy(*keys).agg(F.count("*").alias("_rows")).agg(F.max("_rows")).first()[0] or 0
    if largest > most_rows:
        raise ValueError(f"a group has {largest} rows, above {most_rows}: use fold_groups or apply_batches")
    wide = keyed_schema(rows, keys, kind)

    def run(group: pa.Table) -> pa.Table:
        made = f(group.to_pandas(integer_object_nulls=True, date_as_object=True))
        return with_key_columns(group, pa.Table.from_pandas(made[arrow.names], schema=arrow, preserve_index=False))

    def with_key_columns(group: pa.Table, made: pa.Table) -> pa.Table:
        same = pa.array([0] * made.num_rows, pa.int32())
        return pa.Table.from_arrays([*(group[k].take(same) for k in keys), *made.columns], names=wide.names)

    return rows.groupBy(*keys).applyInArrow(run, wide)


def apply_batches(
    df: DataFrame, keys: str | Sequence[str], f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], returns: str | T.StructType
) -> DataFrame:
    """As ``apply_groups``, for groups of any size: ``f`` gets a group's frames one after
    the other and gives frames as it goes. It should not gather them."""
    keys = listed(keys)
    kind, arrow = columns_of(returns)
    rows = with_keys(df, keys)
    wide = keyed_schema(rows, keys, kind)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = []

        def frames() -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not first:
                    first.append(batch.slice(0, 1).select(keys))
                yield batch.to_pandas(integer_object_nulls=True, date_as_object=True)

        for made in f(frames()):
            part = pa.RecordBatch.from_pandas(made[arrow.names], schema=arrow, preserve_index=False)
            same = pa.array([0] * part.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(c.take(same) for c in first[0].columns), *part.columns], names=wide.names)

    return rows.groupBy(*keys).applyInArrow(run, wide)


def keyed_schema(rows: DataFrame, keys: Sequence[str], kind: T.StructType) -> T.StructType:
    both = {k.lower() for k in keys} & {n.lower() for n in kind.names}
    if both:
        raise ValueError(f"the function may not return its keys: {sorted(both)}")
    return T.StructType([*(rows.schema[k] for k in keys), *kind.fields])
