"""Versioned tables: snapshots, and archives of streams compacted into few files.

A version is a row of the table's manifest that names the folders it consists
of. The row is written after the data and as one file, so a reader gets the
version before or the whole new one, and a crash on the way leaves the last
version as it was. A table has one writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.sinks.tables import BATCH

MANIFEST = "version long, keep int, upto long, segments array<struct<folder: string, level: int, rows: long>>"

KEEP = 3  # folders that the versions of a snapshot take turns in
FAN = 8  # segments of a level that become one of the next
FILE_ROWS = 5_000_000


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions of a table, or None before the first."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, path: str) -> Row | None:
    rows = manifest(spark, path)
    return rows.orderBy(F.desc("version")).first() if rows is not None else None


def announce(spark: SparkSession, path: str, version: int, keep: int, upto: int | None, segments: list) -> None:
    row = spark.createDataFrame([(version, keep, upto, segments)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def write_snapshot(df: DataFrame, path: str, keep: int = KEEP) -> int:
    """Writes the rows as the table's next version and returns its number.

    Versions take turns in ``keep`` folders (two at least), so the disk is bounded and the
    newest is untouched while the next is written. ``df`` may read the newest version.
    """
    if keep < 2:
        raise ValueError("a snapshot needs two folders to take turns in")
    last = newest(df.sparkSession, path)
    version = last["version"] + 1 if last else 0
    folder = f"data/{keep}-{version % keep}"  # no other number of folders shares it
    df.write.mode("overwrite").parquet(f"{path}/{folder}")
    announce(df.sparkSession, path, version, keep, None, [(folder, 0, None)])
    return version


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or an earlier one whose folder no later write may have taken."""
    last = newest(spark, path)
    if last is None:
        raise ValueError(f"no version of {path}")
    row = last
    if version is not None and version != last["version"]:
        row = manifest(spark, path).filter(F.col("version") == version).first()
        if row is None or version + row["keep"] <= last["version"] + 1:
            raise ValueError(f"version {version} of {path} is not kept")
    return spark.read.parquet(*(f"{path}/{s['folder']}" for s in row["segments"]))


def compact(
    spark: SparkSession,
    archive: str,
    path: str,
    upto: int | None = None,
    cluster: Sequence[str] = (),
    fan: int = FAN,
    file_rows: int = FILE_ROWS,
) -> int | None:
    """Rewrites the settled micro-batches of an archive as few files; the new version, or None without any.

    ``archive`` is a folder of ``append_batch``; it is left as it is until
    ``expire``. Batches to ``upto`` are settled, by default all but the newest,
    which may be delivered again. They become a segment of level 0; ``fan`` segments of a
    level become one of the next, in the same write. A row is so rewritten once per level, and there are
    fewer than ``fan`` segments on each. Files hold at most ``file_rows`` rows and are cut by
    ranges of ``cluster``, so that a filter on it skips most of them; a hot value goes to several files.
    """
    rows = spark.read.parquet(archive)
    last = newest(spark, path)
    done = last["upto"] if last else -1
    if upto is None:
        top = rows.agg(F.max(BATCH)).first()[0]
        upto = -1 if top is None else top - 1
    fresh = rows.filter((F.col(BATCH) > done) & (F.col(BATCH) <= upto))
    total = fresh.count()
    if total == 0:
        return None
    parts, level, kept = [fresh], 0, list(last["segments"]) if last else []
    while len(same := [s for s in kept if s["level"] == level]) + 1 >= fan:
        parts += [spark.read.parquet(f"{path}/{s['folder']}") for s in same]
        total += sum(s["rows"] for s in same)
        kept = [s for s in kept if s["level"] != level]
        level += 1
    folder = f"data/{uuid.uuid4().hex}"
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    ranged(merged, max(1, -(-total // file_rows)), cluster).write.option("maxRecordsPerFile", file_rows).parquet(f"{path}/{folder}")
    version = last["version"] + 1 if last else 0
    announce(spark, path, version, 0, upto, [*kept, (folder, level, total)])
    return version


def ranged(df: DataFrame, files: int, cluster: Sequence[str]) -> DataFrame:
    """Rows cut into files by ranges of some columns, then by hash, so that no value has to fit into one."""
    plain = [f.name for f in df.schema.fields if not holds_map(f.dataType)]
    spread = F.xxhash64(*(F.col(f"`{c}`") for c in plain))
    order = [F.col(f"`{c}`") for c in cluster]
    return df.repartitionByRange(files, *order, spread).sortWithinPartitions(*order, BATCH)


def holds_map(kind: T.DataType) -> bool:
    """Whether values of a type cannot be hashed."""
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def read_compacted(spark: SparkSession, archive: str, path: str) -> DataFrame:
    """An archive's rows: its segments, and the micro-batches since."""
    rows = spark.read.parquet(archive)
    last = newest(spark, path)
    if last is None:
        return rows
    old = [spark.read.parquet(f"{path}/{s['folder']}") for s in last["segments"]]
    since = rows.filter(F.col(BATCH) > last["upto"])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [since, *old]).select(*rows.columns)


def expire(spark: SparkSession, archive: str, path: str, keep: int = 2) -> None:
    """Deletes what the newest ``keep`` versions do not need: segments, failed attempts, settled micro-batches.

    Frames that read an older version must be done. The archive's newest
    micro-batch always stays.
    """
    rows = manifest(spark, path)
    kept = rows.orderBy(F.desc("version")).limit(max(1, keep)).collect() if rows is not None else []
    if not kept:
        return
    named = {s["folder"].split("/")[-1] for row in kept for s in row["segments"]}
    settled = min(row["upto"] for row in kept)
    for name, remove in children(spark, f"{path}/data"):
        if name not in named:
            remove()
    batches = [(int(n.split("=")[1]), r) for n, r in children(spark, archive) if n.startswith(f"{BATCH}=")]
    top = max((n for n, _ in batches), default=None)
    for number, remove in batches:
        if number <= settled and number != top:
            remove()


def children(spark: SparkSession, folder: str) -> list:
    """Names in a folder of any file system Spark knows, each with a call that deletes it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    found = [status.getPath() for status in system.listStatus(place)] if system.exists(place) else []
    return [(p.getName(), lambda p=p: system.delete(p, True)) for p in found]
