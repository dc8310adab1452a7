"""Versioned tables, compacted archives, counts on the way, bucketed tables and late rows."""

import datetime as dt
import os

import pytest
from feeds import write_files
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.sinks import tables, versions
from freshet.sources.files import documents, parquet_arrivals
from freshet.streaming import runs
from freshet.streaming.late import LATE_BY, split_late

ROW = "id long, user string, tags map<string,int>"
EVENT = S.schema(id="long", ts="timestamp")
START = dt.datetime(2024, 1, 1)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def parquet_files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


@pytest.fixture
def archive(spark, tmp_path):
    """Eight micro-batches of ten rows; user h holds most of them."""
    path = str(tmp_path / "archive")
    for n in range(8):
        rows = [(n * 10 + i, "h" if i < 7 else f"u{i}", {"i": i}) for i in range(10)]
        tables.append_batch(spark.createDataFrame(rows, ROW).repartition(4), path, n)
    return path


def test_compaction_keeps_every_row_at_every_step(spark, archive, tmp_path):
    table = str(tmp_path / "table")
    for upto in range(7):
        assert versions.compact(spark, archive, table, upto, ["user"], fan=2) == upto
        assert ids(versions.read_compacted(spark, archive, table)) == list(range(80))
        levels = [s["level"] for s in versions.newest(spark, table)["segments"]]
        assert len(levels) == len(set(levels))  # fewer than two on each level
    assert sum(s["rows"] for s in versions.newest(spark, table)["segments"]) == 70
    back = versions.read_compacted(spark, archive, table)
    assert back.columns == spark.read.parquet(archive).columns
    assert {r["batch_id"] for r in back.select("batch_id").collect()} == set(range(8))


def test_compaction_by_default_leaves_the_newest_batch(spark, archive, tmp_path):
    table = str(tmp_path / "table")
    assert versions.compact(spark, archive, table) == 0
    assert versions.newest(spark, table)["upto"] == 6
    assert versions.compact(spark, archive, table) is None  # nothing new
    # The newest may come again, with other rows after a failure.
    tables.append_batch(spark.createDataFrame([(999, "x", {})], ROW), archive, 7)
    assert ids(versions.read_compacted(spark, archive, table)) == [*range(70), 999]


def test_files_are_few_bounded_and_cut_within_a_hot_value(spark, archive, tmp_path):
    table = str(tmp_path / "table")
    versions.compact(spark, archive, table, 7, ["user"], file_rows=10)
    folder = f"{table}/{versions.newest(spark, table)['segments'][0]['folder']}"
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 10 and 8 <= len(sizes) <= 16 and sum(sizes) == 80


def test_unannounced_data_is_not_seen_and_expires(spark, archive, tmp_path):
    table = str(tmp_path / "table")
    versions.compact(spark, archive, table, 3, fan=2)
    versions.compact(spark, archive, table, 4, fan=2)
    spark.createDataFrame([(-1, "crash", {})], ROW).write.parquet(f"{table}/data/halfway")
    assert ids(versions.read_compacted(spark, archive, table)) == list(range(80))
    versions.expire(spark, archive, table, keep=1)
    assert len(os.listdir(f"{table}/data")) == len(versions.newest(spark, table)["segments"])
    assert sorted(n for n in os.listdir(archive) if "=" in n) == ["batch_id=5", "batch_id=6", "batch_id=7"]
    assert ids(versions.read_compacted(spark, archive, table)) == list(range(80))


def test_compaction_of_an_empty_archive(spark, tmp_path):
    archive, table = str(tmp_path / "archive"), str(tmp_path / "table")
    spark.createDataFrame([], "id long, batch_id long").write.parquet(archive)
    assert versions.compact(spark, archive, table) is None
    versions.expire(spark, archive, table)
    assert ids(versions.read_compacted(spark, archive, table)) == []


def test_snapshot_versions(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(ValueError):
        versions.read_snapshot(spark, path)
    for n in range(5):
        assert versions.write_snapshot(spark.range(n, n + 3), path) == n
    assert ids(versions.read_snapshot(spark, path)) == [4, 5, 6]
    assert ids(versions.read_snapshot(spark, path, 3)) == [3, 4, 5]
    for gone in (2, 9):
        with pytest.raises(ValueError):
            versions.read_snapshot(spark, path, gone)
    assert len(os.listdir(f"{path}/data")) == 3
    # A version made from the last one; a write that dies leaves the last one.
    versions.write_snapshot(versions.read_snapshot(spark, path).filter("id > 4"), path)
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.write_snapshot(broken, path)
    assert ids(versions.read_snapshot(spark, path)) == [5, 6]


def test_empty_snapshot(spark, tmp_path):
    versions.write_snapshot(spark.range(0), str(tmp_path / "t"))
    assert versions.read_snapshot(spark, str(tmp_path / "t")).dtypes == [("id", "bigint")]


def test_rows_counted_on_the_way(spark, tmp_path):
    rows = spark.range(100)
    seen = tables.counted(rows, lambda df: df.write.parquet(str(tmp_path / "out")), top=F.max("id"))
    assert seen == {"rows": 100, "top": 99} and spark.read.parquet(str(tmp_path / "out")).count() == 100
    none = tables.counted(rows.limit(0), lambda df: df.write.parquet(str(tmp_path / "none")), top=F.max("id"))
    assert none == {"rows": 0, "top": None}


def test_null_row_keys_match(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (2, "x", "c")], "id int, k string, v string")
    there = spark.createDataFrame([(1, None), (None, None)], "id int, k string")
    left = tables.not_yet_there(df, there, ["id", "k"])
    assert left.columns == df.columns and [r["v"] for r in left.collect()] == ["c"]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(200).withColumn("a", F.col("id") % 7)
    right = spark.range(0, 200, 2).withColumn("b", F.col("id") * 2)
    for name, rows in (("b_left", left), ("b_right", right)):
        tables.save_bucketed(rows, name, ["id"], 4, str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("b_left").join(spark.table("b_right"), "id")
        counts = joined.groupBy("id").count()
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert ids(joined) == list(range(0, 200, 2)) and counts.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE b_left")
        spark.sql("DROP TABLE b_right")


def test_late_rows_are_kept_apart(spark, tmp_path):
    folder = str(tmp_path)
    seconds = [0, 100, 95, 89, None, 300, 150, 290, 289, 100]
    rows = [(i, None if s is None else START + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    write_files(spark, f"{folder}/in", rows, EVENT, 5)  # two rows each
    stream = parquet_arrivals(spark, f"{folder}/in", EVENT, files_per_trigger=1)
    late, latest, want = {}, None, {}
    for at in range(0, len(rows), 2):
        for i in (at, at + 1):
            if latest is not None and seconds[i] is not None and seconds[i] < latest - 10:
                want[i] = (latest - 10 - seconds[i]) * 1_000_000
        latest = max([latest or 0, *(s for s in seconds[at : at + 2] if s is not None)])
    parted = split_late(
        "ts", "10 seconds", f"{folder}/mark",
        lambda b, n: tables.append_batch(b, f"{folder}/on_time", n),
        lambda b, n: tables.append_batch(b, f"{folder}/late", n),
    )

    def twice(batch, n):  # every micro-batch delivered twice
        parted(batch, n)
        parted(batch, n)

    runs.finish(runs.start(runs.to_batches(stream, twice, f"{folder}/check")))
    late = {r["id"]: r[LATE_BY] for r in spark.read.parquet(f"{folder}/late").collect()}
    assert late == want and len(want) == 4
    assert sorted([*late, *ids(spark.read.parquet(f"{folder}/on_time"))]) == list(range(10))


def test_documents_appended_by_a_stream(spark, tmp_path):
    folder = str(tmp_path)
    write_files(spark, f"{folder}/in", [(i, START) for i in range(12)], EVENT, 3)
    stream = parquet_arrivals(spark, f"{folder}/in", EVENT, files_per_trigger=1)
    for _ in range(2):  # started again, it adds nothing
        runs.finish(runs.start(runs.to_documents(stream, folder, "index", f"{folder}/check")))
        assert ids(documents(spark, folder, "index", EVENT)) == list(range(12))
