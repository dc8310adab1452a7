"""Tables: Parquet folders, catalog tables and JDBC tables.

A micro-batch may be delivered twice. Every append by batch therefore either
replaces the rows of the same batch or adds only those that are not there yet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.sources.files import typed

BATCH = "batch_id"


def archive(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Appends a batch to a Parquet folder, cast to the schema if given."""
    (typed(df, schema) if schema is not None else df).write.mode("append").parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Appends a micro-batch to a Parquet folder, one sub-folder per batch.

    A second delivery overwrites the sub-folder. An empty batch adds nothing.
    """
    (
        df.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .parquet(path)
    )


def latest_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a folder of updates by batch says now: the newest row of each key."""
    values = [c for c in changes.columns if c not in (*keys, BATCH)]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_row"))
    return newest.select(*keys, "_row.*")


def append_to_table(df: DataFrame, name: str, batch_id: int) -> None:
    """The same for a catalog table; the first batch creates it."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        empty = df.limit(0).withColumn(BATCH, F.lit(batch_id).cast("long"))
        empty.write.format("parquet").partitionBy(BATCH).saveAsTable(name)
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != BATCH)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = {int(batch_id)}) SELECT {columns} FROM {{batch}}", batch=df
    )


def replace_table(df: DataFrame, name: str) -> None:
    """Replaces a catalog table by a snapshot."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """A catalog table whose rows lie in buckets by key, one sorted file each.

    Tables of the same keys and number of buckets join, and group by the keys,
    without a shuffle. One task writes and one reads a bucket, so this is for keys none of which is
    hot; a join by a hot key does better unbucketed, where it is split at run time.
    """
    first, *more = keys
    writer = df.repartition(buckets, *keys).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, first, *more).sortBy(first, *more)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def counted(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Writes rows and counts them on the way: ``rows`` and the aggregates given, without a second read.

    ``write`` must run one job over all rows, as a sink does.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(name) for name, m in metrics.items())))
    return seen.get


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Overwrites the only copy; ``versions.write_snapshot`` keeps the last until the new one is whole."""
    df.write.mode("overwrite").parquet(path)


def not_yet_there(df: DataFrame, there: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold yet; a null in a key is a value like any other."""
    held = there.select(*(F.col(c).alias(f"_there_{n}") for n, c in enumerate(row_key)))
    same = [F.col(c).eqNullSafe(F.col(f"_there_{n}")) for n, c in enumerate(row_key)]
    return df.join(held, same, "left_anti")


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, **(properties or {})}


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batch_id: int,
    row_key: Sequence[str],
    properties: Mapping[str, str] | None = None,
) -> None:
    """Appends a micro-batch to a database table from the executors.

    A failed attempt may have committed some partitions, so the rows of this
    batch that are there already are left out. ``row_key`` names the columns
    that tell the rows of a batch apart.
    """
    options = jdbc_options(url, table, properties)
    marked = df.withColumn(BATCH, F.lit(batch_id).cast("long"))
    marked.limit(0).write.format("jdbc").options(**options).mode("ignore").save()
    there = df.sparkSession.read.format("jdbc").options(**options).load().filter(F.col(BATCH) == batch_id)
    not_yet_there(marked, there, row_key).write.format("jdbc").options(**options).mode("append").save()


def replace_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Replaces the rows of a database table by a snapshot."""
    options = jdbc_options(url, table, properties)
    df.write.format("jdbc").options(**options).option("truncate", True).mode("overwrite").save()
