"""JSON payloads of a log to typed columns, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.ordered import shifted

BAD = "_bad_json"


def _parsed(value: str, schema: T.StructType, keep_bad: bool):
    text = F.col(value).cast("string")
    if not keep_bad:
        return F.from_json(text, schema)
    marked = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return F.from_json(text, marked, {"columnNameOfCorruptRecord": BAD})


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    nested: str | None = None,
    keep: Sequence[str] = (),
    keep_bad: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Decodes the payload column against a declared schema.

    Without ``nested`` the payload's fields become the columns, after those in
    ``keep``. With it all columns stay and the payload's declared fields become
    one nested field; with ``whole`` that field is a variant, which holds the
    undeclared ones as well. Text that does not fit gives null fields, and a null
    variant if it is no JSON; ``keep_bad`` adds it as a column, for ``good_rows``
    and ``bad_rows`` to split on.
    """
    if whole:
        if nested is None or keep_bad:
            raise ValueError("a whole payload needs a nested column, and has no bad rows apart")
        return df.withColumn(nested, F.try_parse_json(F.col(value).cast("string")))
    data = _parsed(value, schema, keep_bad)
    if nested is None:
        return df.select(*keep, data.alias("_data")).select(*keep, "_data.*")
    return df.withColumn(nested, data)


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(BAD).isNull()).drop(BAD)


def bad_rows(decoded: DataFrame) -> DataFrame:
    """The payloads that could not be read, for a quarantine table."""
    return decoded.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("value"))


def encode_json(df: DataFrame, key: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as keyed JSON messages: columns key and value, both text."""
    value = F.to_json(F.struct(*(columns or df.columns))).alias("value")
    head = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*head, value)


def decode_changes(df: DataFrame, row_schema: T.StructType, value: str = "value") -> DataFrame:
    """Change events: op, before, after and ts (milliseconds since the epoch)."""
    envelope = T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", row_schema),
            T.StructField("after", row_schema),
            T.StructField("ts", T.LongType()),
        ]
    )
    return df.withColumn("_e", F.from_json(F.col(value).cast("string"), envelope)).select(
        *[c for c in df.columns if c != value], "_e.*"
    )


def change_identity(changes: DataFrame, key: str) -> Column:
    """The key of the row that was changed, from what it is or was."""
    return F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}"))


def current_rows(changes: DataFrame, key: str, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The table that a log of change events leaves behind.

    The newest change of a key wins; a key whose newest change is a delete is
    gone. One aggregate with partial results, so a key with many changes sends
    one row per task.
    """
    newest = changes.groupBy(change_identity(changes, key).alias("_key")).agg(
        F.max_by(F.struct("op", "after"), F.struct(*order)).alias("_last")
    )
    return newest.filter(F.col("_last.op") != "d").select("_last.after.*")


def row_versions(changes: DataFrame, key: str, order: Sequence[str] = ("ts",), **cut) -> DataFrame:
    """Every state a row has had: its columns, ``valid_from`` and ``valid_to``.

    Times are the first column of ``order``. A state ends where the key's next change
    begins, and the newest one is open: null. Deletes end a state and are none themselves. Events
    with the same key and order are one, however often they were delivered; late ones fall
    into their place. A key with very many changes is cut as in ``operators.ordered``.
    """
    stamps = [f"_o{i}" for i in range(len(order))]
    keyed = changes.select(
        change_identity(changes, key).alias("_key"), *(F.col(c).alias(s) for c, s in zip(order, stamps, strict=True)), "op", "after"
    )
    once = keyed.groupBy("_key", *stamps).agg(F.max(F.struct("op", "after")).alias("_c"))
    ended = shifted(once, "_key", stamps, F.col(stamps[0]), "valid_to", back=False, **cut)
    return ended.filter(F.col("_c.op") != "d").select("_c.after.*", F.col(stamps[0]).alias("valid_from"), "valid_to")


def newest_states(changes: DataFrame, key: str, order: Sequence[str] = ("ts",)) -> DataFrame:
    """The newest state of each key: ``_key`` as text, the order columns, ``deleted``, ``after``."""
    newest = changes.groupBy(change_identity(changes, key).cast("string").alias("_key")).agg(
        F.max_by(F.struct(*order, (F.col("op") == "d").alias("deleted"), "after"), F.struct(*order)).alias("_s")
    )
    return newest.select("_key", "_s.*")


def merged_changes(base: DataFrame, delta: DataFrame) -> DataFrame:
    """A table of newest states after a delta, both as ``newest_states`` gives them.

    Tombstones stay, so deltas may overlap the base and each other and may come late.
    """
    order = [c for c in base.columns if c not in ("_key", "deleted", "after")]
    both = base.unionByName(delta.select(*base.columns))
    newest = both.groupBy("_key").agg(F.max_by(F.struct(*order, "deleted", "after"), F.struct(*order)).alias("_s"))
    return newest.select("_key", "_s.*")


def living(states: DataFrame) -> DataFrame:
    """The rows of a table of newest states, without the deleted ones."""
    return states.filter(~F.col("deleted")).select("after.*")
