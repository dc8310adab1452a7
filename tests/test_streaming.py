"""Streams in several micro-batches against the batch form of the same operator."""

import datetime as dt
import random
import time

import pytest
from feeds import add_file, write_files
from pyspark.sql import functions as F

from freshet import schemas as S
from freshet.operators.aggregates import group_agg, top_n
from freshet.operators.ordered import changed, halving_fold, latched, running_count, running_sum
from freshet.operators.ranking import rank_asof
from freshet.operators.windows import windowed
from freshet.sinks.tables import append_batch, latest_rows, replace_snapshot
from freshet.sources.files import csv_arrivals, parquet_arrivals
from freshet.sources.generated import rate, rate_per_batch
from freshet.streaming import carried, runs, state

EVENT = S.schema(seq="long", k="string", v="long", c="string", ts="timestamp")
START = dt.datetime(2024, 1, 1)
CUT = {"span": 40, "hot_rows": 20}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    keys = ["hot"] * 4 + list("abcdefg")
    return [
        (i, rng.choice(keys), rng.randint(0, 9), rng.choice("xyz"), START + dt.timedelta(seconds=7 * i))
        for i in range(300)
    ]


@pytest.fixture(scope="module")
def feed(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    write_files(spark, folder, list(rows), EVENT, 4, random.Random(1))
    return folder


@pytest.fixture
def stream(spark, feed):
    return parquet_arrivals(spark, feed, EVENT, files_per_trigger=1)


@pytest.fixture(scope="module")
def batch(spark, rows):
    return spark.createDataFrame(rows, EVENT).cache()


def run(writer):
    query = runs.start(writer)
    runs.finish(query, 120)
    return query


def rows_of(df, *drop):
    shown = df.drop("batch_id", *drop)
    return sorted(tuple(str(r[c]) for c in sorted(shown.columns)) for r in shown.collect())


def written(spark, df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    run(runs.to_changes(df, out, str(tmp_path / "check"), mode))
    result = spark.read.parquet(out)
    assert result.select("batch_id").distinct().count() > 1
    return result


def test_running_count(spark, stream, batch, tmp_path):
    got = written(spark, state.running_sum_stream(stream, ["k", "c"], "seq", None, "n"), tmp_path)
    assert rows_of(got) == rows_of(running_count(batch, ["k", "c"], "seq", "n"))


def test_running_sum(spark, stream, batch, tmp_path):
    got = written(spark, state.running_sum_stream(stream, ["k"], "seq", "v", "s"), tmp_path)
    assert rows_of(got) == rows_of(running_sum(batch, "k", "seq", "v", "s"))


def test_changed(spark, stream, batch, tmp_path):
    got = written(spark, state.changed_stream(stream, "k", "seq", "c", "alert"), tmp_path)
    assert rows_of(got) == rows_of(changed(batch, "k", "seq", "c", "alert"))


def test_latched(spark, stream, batch, tmp_path):
    got = written(spark, state.latched_stream(stream, "k", "seq", "c", "x", "blocked", 5), tmp_path)
    assert rows_of(got) == rows_of(latched(batch, "k", "seq", F.col("c") == "x", "blocked", 5))


def test_halving_fold(spark, stream, batch, tmp_path):
    got = written(spark, state.halving_fold_stream(stream, ["k"], "seq", "v", "s"), tmp_path)
    last = {r["k"]: r["s"] for r in got.groupBy("k").agg(F.max_by("s", "seq").alias("s")).collect()}
    want = {r["k"]: r["s"] for r in halving_fold(batch, "k", "seq", "v", "s").collect()}
    assert last == pytest.approx(want)


def through_batches(spark, stream, tmp_path, make):
    out = str(tmp_path / "out")
    each = make(str(tmp_path / "carried"), lambda df, n: append_batch(df, out, n))
    run(runs.to_batches(stream, each, str(tmp_path / "check")))
    return spark.read.parquet(out)


def test_carried_count(spark, stream, batch, tmp_path):
    got = through_batches(
        spark, stream, tmp_path, lambda f, sink: carried.running_count_batches(["k", "c"], "seq", "n", f, sink, **CUT)
    )
    assert rows_of(got) == rows_of(running_count(batch, ["k", "c"], "seq", "n"))


def test_carried_changed(spark, stream, batch, tmp_path):
    got = through_batches(
        spark, stream, tmp_path, lambda f, sink: carried.changed_batches("k", "seq", "c", "alert", f, sink, **CUT)
    )
    assert rows_of(got) == rows_of(changed(batch, "k", "seq", "c", "alert"))


def test_carried_latched(spark, stream, batch, tmp_path):
    seed = spark.createDataFrame([("a",)], "k string")
    failing = F.col("c") == "x"
    got = through_batches(
        spark,
        stream,
        tmp_path,
        lambda f, sink: carried.latched_batches("k", "seq", failing, "blocked", 5, f, sink, seed, **CUT),
    )
    assert rows_of(got) == rows_of(latched(batch, "k", "seq", failing, "blocked", 5, seed))


def test_carried_fold(spark, stream, batch, tmp_path):
    got = through_batches(
        spark, stream, tmp_path, lambda f, sink: carried.halving_fold_batches("k", "seq", "v", "s", f, sink, **CUT)
    )
    last = {r["k"]: r["s"] for r in latest_rows(got, ["k"]).collect()}
    want = {r["k"]: r["s"] for r in halving_fold(batch, "k", "seq", "v", "s").collect()}
    assert last == pytest.approx(want)


def test_carried_rank(spark, stream, batch, tmp_path):
    got = through_batches(
        spark, stream, tmp_path, lambda f, sink: carried.rank_batches("k", "seq", "v", f, sink, band=30, hot_rows=20)
    )
    assert rows_of(got) == rows_of(rank_asof(batch, "k", "seq", "v"))


def test_carried_batch_delivered_twice(spark, rows, batch, tmp_path):
    """A repeated micro-batch finds the state it found the first time."""
    out = str(tmp_path / "out")
    each = carried.running_count_batches("k", "seq", "n", str(tmp_path / "c"), lambda df, n: append_batch(df, out, n))
    parts = [spark.createDataFrame(rows[i : i + 100], EVENT) for i in range(0, 300, 100)]
    for n in (0, 0, 1, 1, 2, 2, 2):
        each(parts[n], n)
    assert rows_of(spark.read.parquet(out)) == rows_of(running_count(batch, "k", "seq", "n"))


def sliding(df, watermark=None):
    return windowed(df, "ts", "10 minutes", ["k"], {"n": F.count("*"), "s": F.sum("v")}, "5 minutes", watermark)


def test_sliding_window_update_mode(spark, stream, batch, tmp_path):
    got = written(spark, sliding(stream, "1 hour"), tmp_path, "update")
    assert rows_of(latest_rows(got, ["window_start", "window_end", "k"])) == rows_of(sliding(batch))


def test_window_append_mode_leaves_open_windows_out(spark, stream, batch, tmp_path):
    out = str(tmp_path / "out")
    run(runs.to_archive(sliding(stream, "0 seconds"), out, str(tmp_path / "check")))
    want = rows_of(sliding(batch))
    got = rows_of(spark.read.parquet(out))
    assert set(got) < set(want) and len(got) > len(want) / 2


def test_running_totals_complete_mode(spark, stream, batch, tmp_path):
    out = str(tmp_path / "out")
    totals = lambda df: top_n(group_agg(df, "k", total=F.sum("v")), "total", 3, ["k"])
    run(runs.to_snapshot(totals(stream), out, str(tmp_path / "check")))
    assert rows_of(spark.read.parquet(out)) == rows_of(totals(batch))


def test_late_records_are_dropped(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    folder = str(tmp_path / "in")
    # Spark drops a record by the watermark the batch before it worked with, so
    # the late one comes two batches after the watermark has passed it.
    rows = [(i, "a", 1, "x", at(s)) for i, s in enumerate([0, 100, 150, 1, 200])]
    write_files(spark, folder, rows, EVENT, 5)
    stream = parquet_arrivals(spark, folder, EVENT, files_per_trigger=1)
    counts = windowed(stream, "ts", "5 seconds", ["k"], {"n": F.count("*")}, watermark="10 seconds")
    got = written(spark, counts, tmp_path, "update")
    seen = {(r["window_start"] - START).seconds: r["n"] for r in latest_rows(got, ["window_start", "window_end", "k"]).collect()}
    assert seen == {0: 1, 100: 1, 150: 1, 200: 1}


def test_restart_goes_on_where_it_stopped(spark, rows, batch, tmp_path):
    folder, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    write_files(spark, folder, list(rows[:150]), EVENT, 2)
    counted = lambda: state.running_sum_stream(parquet_arrivals(spark, folder, EVENT), ["k"], "seq", None, "n")
    run(runs.to_archive(counted(), out, check))
    assert spark.read.parquet(out).count() == 150
    add_file(spark, folder, rows[150:], EVENT, 900)
    run(runs.to_archive(counted(), out, check))
    assert rows_of(spark.read.parquet(out)) == rows_of(running_count(batch, "k", "seq", "n"))


def test_folder_of_csv_files_is_read_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    (folder / "a.csv").write_text("k,v\nx,1\ny,2\n")
    schema = S.schema(k="string", v="integer")
    each = runs.per_batch(
        lambda df: group_agg(df, "k", total=F.sum("v")), lambda df, n: append_batch(df, out, n)
    )
    go = lambda: run(runs.to_batches(csv_arrivals(spark, str(folder), schema), each, check))
    go()
    (folder / "b.csv").write_text("k,v\nx,10\n")
    go()
    go()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("batch_id", "k", "total").collect())
    assert got == [(0, "x", 1), (0, "y", 2), (1, "x", 10)]


def test_fan_out_feeds_all_sinks_from_one_computation(spark, stream, tmp_path):
    seen = []
    both = runs.fan_out(
        lambda df, n: append_batch(df, str(tmp_path / "a"), n),
        lambda df, n: (seen.append(df.is_cached), replace_snapshot(df.filter("v > 5"), str(tmp_path / f"b{n}"))),
    )
    run(runs.to_batches(stream, both, str(tmp_path / "check")))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 300
    assert seen == [True] * 4


def test_rate_sources(spark, tmp_path):
    assert rate(spark, 5).schema == S.schema(timestamp="timestamp", value="long")
    query = rate_per_batch(spark, 20).writeStream.format("memory").queryName("rated").start()
    for _ in range(100):
        if spark.table("rated").count() >= 20:
            break
        time.sleep(0.2)
    query.stop()
    values = sorted(r["value"] for r in spark.table("rated").collect())
    assert values[:20] == list(range(20))


def test_console_sink_modes(spark, stream, tmp_path):
    totals = group_agg(stream, "k", total=F.sum("v"))
    shown = {"append": stream.filter("v > 8"), "update": totals, "complete": totals.orderBy(F.desc("total"))}
    for mode, df in shown.items():
        query = run(runs.to_console(df, mode).option("checkpointLocation", str(tmp_path / mode)))
        progress = query.recentProgress
        assert sum(p["numInputRows"] for p in progress) == 300
        assert "ConsoleTable" in progress[0]["sink"]["description"]


def test_unbounded_start_and_timed_stop(spark, stream, tmp_path):
    query = runs.start(runs.to_archive(stream, str(tmp_path / "o"), str(tmp_path / "c")), bounded=False, every="1 second")
    query.processAllAvailable()
    runs.finish(query, 1)
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "o")).count() == 300
