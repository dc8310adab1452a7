"""Stateful processors and ordered folds against batches and loops, over several micro-batches."""

import datetime as dt
import random
import time

import pytest
from feeds import write_files
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators import lookups, ordered
from freshet.operators.decode import living, merged_changes, newest_states, row_versions
from freshet.operators.ranking import rank_asof
from freshet.plans.catalog import PLANS
from freshet.sinks.tables import append_batch, latest_rows
from freshet.sources.files import parquet_arrivals
from freshet.streaming import carried, processors, ranks, runs

START = dt.datetime(2024, 1, 1)
SCHEMA = T.StructType().add("k", "string").add("seq", "long").add("v", "long").add("_c", "string").add("ts", "timestamp")


def made(seed=1, n=240):
    draw = random.Random(seed)
    return [
        (draw.choice(["ann", "bo", "é", None]), i, draw.choice([None, 1, 2, 7, -3]), draw.choice([None, "x", "y"]), START + dt.timedelta(minutes=i))
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed"))
    write_files(spark, path, made(), SCHEMA, 4, random.Random(1))
    return path


@pytest.fixture
def stream(spark, folder):
    return parquet_arrivals(spark, folder, SCHEMA, files_per_trigger=1)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(made(), SCHEMA)


def ran(spark, df, tmp_path, each=lambda b: b, bounded=True):
    """With times to live a stream has no end of its own, so it is stopped when all is read."""
    out = str(tmp_path / "out")
    writer = runs.to_batches(df, lambda b, n: append_batch(each(b), out, n), str(tmp_path / "check"))
    if bounded:
        runs.finish(runs.start(writer))
    else:
        query = runs.start(writer, bounded=False)
        for _ in range(60):
            time.sleep(1)
            if query.lastProgress and query.lastProgress["batchId"] >= 4 or not query.isActive:
                break
        query.stop()
    return spark.read.parquet(out)


def same(got, want):
    assert got.select("batch_id").distinct().count() > 1
    rows = lambda df: sorted(tuple(str(r[c]) for c in sorted(want.columns)) for r in df.collect())
    assert rows(got) == rows(want)


def test_running_total_with_seeds(spark, stream, batch, tmp_path):
    seed = spark.createDataFrame([("bo", 100), ("never", 5)], "k string, s long")
    got = ran(spark, processors.running_total(stream, "k", "seq", "v", "s", seed=seed, buckets=3), tmp_path)
    first = F.when(F.col("k") == "bo", 100).otherwise(0)
    same(got, ordered.running_sum(batch, "k", "seq", "v", "s").withColumn("s", F.col("s") + first))


def test_total_is_forgotten_after_its_time(spark, stream, batch, tmp_path):
    got = ran(spark, processors.running_total(stream, "k", "seq", None, "n", live_ms=3_600_000), tmp_path, bounded=False)
    same(got, ordered.running_count(batch, "k", "seq", "n"))  # an hour has not passed


def test_latched_with_seeds(spark, stream, batch, tmp_path):
    seed = spark.createDataFrame([("é",), (None,)], "k string")
    rows = stream.withColumn("failing", F.col("_c") == "x")
    got = ran(spark, processors.latched(rows, "k", "seq", "failing", "blocked", 5, seed), tmp_path)
    same(got, ordered.latched(batch, "k", "seq", F.col("_c") == "x", "blocked", 5, seed.filter("k IS NOT NULL")))


def first_offers(rows, seed):
    known, out = dict(seed), []
    for k, seq, _, offer, _ in sorted(rows, key=lambda r: r[1]):
        if offer is not None:
            known.setdefault(k, offer)
        out.append((seq, known.get(k)))
    return out


def test_first_written(spark, stream, batch, tmp_path):
    seed = spark.createDataFrame([("bo", "set")], "k string, plan string")
    want = first_offers(made(), [("bo", "set")])
    got = ran(spark, processors.first_written(stream, "k", "seq", "_c", "plan", seed), tmp_path)
    assert sorted((r["seq"], r["plan"]) for r in got.collect()) == want
    again = lookups.first_written(batch, "k", "seq", "_c", "plan", seed)
    assert sorted((r["seq"], r["plan"]) for r in again.collect()) == want and again.columns == [*batch.columns, "plan"]


def test_ranks_from_counts(spark, stream, batch, tmp_path):
    got = ran(spark, ranks.rank_parts(stream, "k", "seq", "v"), tmp_path, lambda b: ranks.ranks(b, SCHEMA))
    same(got, rank_asof(batch, "k", "seq", "v"))


@pytest.mark.parametrize("wide", [1, 3_000_000_007])
def test_ranks_over_slices_of_time(spark, stream, batch, tmp_path, monkeypatch, wide):
    monkeypatch.setattr(ranks, "SLICE_BITS", 3, raising=False)
    points = F.col("v") * wide
    got = ran(spark, ranks.rank_parts(stream.withColumn("v", points), "k", "seq", "v"), tmp_path, lambda b: ranks.ranks(b, SCHEMA))
    same(got, rank_asof(batch.withColumn("v", points), "k", "seq", "v"))


def test_the_topmost_nodes_see_a_row_for_each_part_of_a_slice(spark):
    """They saw every record of a micro-batch, twice."""
    draw, held, rows = random.Random(4), {}, []
    for i in range(600):
        k = draw.choice("abcdefgh")
        rows.append((f"={k}", i * 100, f"r{i}", held.get(k, 5_000) + draw.randint(-2, 5), held.get(k)))
        held[k] = rows[-1][3]
    moved = spark.createDataFrame(rows, "name string, seq long, record string, total long, before long").repartition(5)
    got = ranks.sliced(moved).collect()
    slices = {i * 100 >> 14 for i in range(600)}
    assert sorted(r["slice"] for r in got if r["level"] == 0) == sorted(slices) == [0, 1, 2, 3]
    for level in range(4):
        assert sum(r["gain"] for r in got if r["level"] == level) == len(held)
    seen = {r["record"]: r["above"] for r in got if r["level"] == 4 and r["asks"]}
    want, places = {}, {}
    for name, seq, record, total, _ in rows:
        own = seq >> 14
        places.setdefault(own, {p: 0 for p in places.get(own, ())})[name] = total
        before = dict((n, t) for n, s, _, t, _ in rows if s >> 14 < own)
        above = lambda at: sum((t, n) > (total, name) for n, t in at.items())
        want[record] = above(before | places[own]) - above(before)
    assert seen == want


def test_a_micro_batch_changes_only_its_own_nodes(spark):
    places = spark.createDataFrame([(5,), (6,), (70_000,), (-1,)], "t long").select(F.transform(ranks.nodes(F.col("t")), lambda n: n["node"]))
    found = [r[0] for r in places.collect()]
    assert found[0] == found[1] and found[0][:3] == found[2][:3] and found[0][1] != found[3][1] and len(found[0]) == 5


def test_window_totals_by_timers(spark, stream, batch, tmp_path):
    got = ran(spark, processors.windowed_totals(stream, "k", "ts", 600_000, "v", "total", "0 seconds"), tmp_path)
    ends = lambda k: {r["window_end"]: r["total"] for r in got.filter(F.col("k").eqNullSafe(k)).collect()}
    for k in ("ann", None):
        want = {}
        for name, _, v, _, at in made():
            if name == k:
                end = at.replace(minute=at.minute // 10 * 10) + dt.timedelta(minutes=10)
                want[end] = want.get(end, 0) + (v or 0)
        closed = {e: t for e, t in want.items() if e <= START + dt.timedelta(minutes=239)}
        assert ends(k) == closed


CHANGE = "op string, before struct<id: int, s: string>, after struct<id: int, s: string>, ts long, n long"


def change_rows():
    draw, rows = random.Random(7), []
    for i in range(40):
        for n in range(draw.randint(1, 5)):
            gone = draw.random() < 0.3
            rows.append(("d" if gone else "u", {"id": i, "s": "old"}, None if gone else {"id": i, "s": f"s{n}"}, n // 2, i * 10 + n))
    return rows


def plain_states(rows):
    last = {}
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        last[r[1]["id"]] = r
    return sorted((i, r[2]["s"]) for i, r in last.items() if r[0] != "d")


def test_changes_late_and_doubled(spark, tmp_path):
    rows = change_rows()
    mixed = rows + random.Random(3).sample(rows, 40)
    random.Random(2).shuffle(mixed)
    schema = spark.createDataFrame([], CHANGE).schema
    write_files(spark, str(tmp_path / "in"), mixed, schema, 5)
    stream = parquet_arrivals(spark, str(tmp_path / "in"), schema, files_per_trigger=1)
    got = ran(spark, processors.newest_changes(stream, "id", ["ts", "n"]), tmp_path).drop("batch_id")
    states = merged_changes(got.limit(0), got)
    assert sorted((r["id"], r["s"]) for r in living(states).collect()) == plain_states(rows)
    base = newest_states(spark.createDataFrame(mixed[:60], schema), "id", ["ts", "n"])
    delta = newest_states(spark.createDataFrame(mixed[40:], schema), "id", ["ts", "n"])
    assert sorted((r["id"], r["s"]) for r in living(merged_changes(base, delta)).collect()) == plain_states(rows)


@pytest.mark.parametrize("cut", [{}, {"span": 40, "hot_rows": 2}])
def test_versions(spark, cut):
    rows = change_rows()
    want = []
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[3], r[4])):
        by_key.setdefault(r[1]["id"], []).append(r)
    for i, own in by_key.items():
        for r, after in zip(own, [*own[1:], None], strict=True):
            if r[0] != "d":
                want.append((i, r[2]["s"], r[3], after[3] if after else None))
    got = row_versions(spark.createDataFrame(rows + rows[::2], CHANGE), "id", ["ts", "n"], **cut)
    assert got.columns == ["id", "s", "valid_from", "valid_to"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


FOLDS = {
    "halving": (lambda: ordered.affine(0.5, 0.5), lambda s, v: v if s is None else (s + v) / 2, None),
    "affine": (lambda: ordered.affine(0.75, 2, 10), lambda s, v: 0.75 * s + 2 * v, 10.0),
    "clamped": (lambda: ordered.clamped(-5, 7, 1), lambda s, v: min(max(s + v, -5), 7), 1),
}


def folded(rows, f, start):
    state = {}
    for k, _, v, *_ in sorted(rows, key=lambda r: r[1]):
        state.setdefault(k, start)
        if v is not None:
            state[k] = f(state[k], v)
    return state


@pytest.mark.parametrize("name", sorted(FOLDS))
@pytest.mark.parametrize("cut", [{}, {"span": 50, "hot_rows": 60}, {"span": 7, "hot_rows": 3}])
def test_fold_at_every_block_size(spark, name, cut):
    fold, f, start = FOLDS[name]
    rows = [*made(), ("null", 1, None, None, START)]
    got = ordered.ordered_fold(spark.createDataFrame(rows, SCHEMA), "k", "seq", "v", "s", fold(), **cut)
    assert {r["k"]: r["s"] for r in got.collect()} == pytest.approx(folded(rows, f, start))


@pytest.mark.parametrize("name", ["clamped"])
def test_fold_carried_between_micro_batches(spark, stream, name, tmp_path):
    fold, f, start = FOLDS[name]
    out = str(tmp_path / "out")
    each = carried.ordered_fold_batches("k", "seq", "v", "s", fold(), str(tmp_path / "c"), lambda b, n: append_batch(b, out, n), span=20, hot_rows=15)
    runs.finish(runs.start(runs.to_batches(stream, each, str(tmp_path / "check"))))
    got = latest_rows(spark.read.parquet(out), ["k"])
    assert {r["k"]: r["s"] for r in got.collect()} == pytest.approx(folded(made(), f, start))


def test_running_sum_of_fractions_on_batches(spark, tmp_path):
    rows = [("a", i, 0.25 * i) for i in range(40)]
    out = str(tmp_path / "out")
    each = carried.running_sum_batches("k", "seq", F.col("v"), "s", str(tmp_path / "c"), lambda b, n: append_batch(b, out, n))
    for n in range(4):
        each(spark.createDataFrame(rows[n * 10 : n * 10 + 10], "k string, seq long, v double"), n)
    got = {r["seq"]: r["s"] for r in spark.read.parquet(out).collect()}
    assert got == {i: 0.25 * i * (i + 1) / 2 for i in range(40)}


def test_running_words_as_a_stream(spark, tmp_path):
    texts = [(i, f"w{i % 3} same w{i % 5}") for i in range(20)]
    schema = T.StructType().add("offset", "long").add("text", "string")
    write_files(spark, str(tmp_path / "in"), texts, schema, 4)
    plan = PLANS["running_word_counts"]
    runs.finish(runs.start(plan.write(parquet_arrivals(spark, str(tmp_path / "in"), schema, 1), str(tmp_path / "o"), str(tmp_path / "c"))))
    same(spark.read.parquet(str(tmp_path / "o")), plan.run(spark.createDataFrame(texts, schema)))


@pytest.mark.parametrize("name", ["latched", "first_written", "running_sum", "changed", "latched_stream", "halving_fold"])
def test_a_call_serves_a_bucket_of_keys(spark, stream, name):
    from freshet.streaming import state

    made = {
        "latched": lambda rows: processors.latched(rows.withColumn("f", F.col("v") < 0), "k", "seq", "f", "out", 5),
        "first_written": lambda rows: processors.first_written(rows, "k", "seq", "c", "out"),
        "running_sum": lambda rows: state.running_sum_stream(rows, ["k"], "seq", "v", "out"),
        "changed": lambda rows: state.changed_stream(rows, "k", "seq", "c", "out"),
        "latched_stream": lambda rows: state.latched_stream(rows, "k", "seq", "c", "x", "out", 5),
        "halving_fold": lambda rows: state.halving_fold_stream(rows, ["k"], "seq", "v", "out"),
    }
    rows = spark.readStream.format("rate").load().select(
        F.col("value").alias("seq"), F.lit("a").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("c")
    )
    plan = made[name](rows)._jdf.queryExecution().analyzed().toString()
    assert "_bucket" in plan and "TransformWithState" in plan  # it was a call for each key


def test_totals_of_ranks_are_kept_by_bucket(spark):
    from freshet.streaming.ranks import totals

    rows = spark.readStream.format("rate").load().select(F.col("value").alias("seq"), F.lit("a").alias("k"), F.lit(1).alias("v"))
    assert "_bucket" in totals(rows, "k", "seq", "v", "total")._jdf.queryExecution().analyzed().toString()


def test_totals_of_a_bucket_are_one_request(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    class Value:
        def __init__(self):
            self.kept, self.requests = {}, 0

        def get(self, name):
            self.requests += 1
            return self.kept.get(name)

        def put(self, name, value):
            self.requests += 1
            self.kept[name] = value

    rows = spark.readStream.format("rate").load().select(F.col("value").alias("seq"), F.lit("a").alias("k"), F.lit(1).alias("v"))
    made = {}
    monkeypatch.setattr(processors, "process", lambda df, keys, order, out, step, *rest: made.update(step=step))
    processors.running_total(rows, "k", "seq", "v", "s")
    held, keys = Value(), [f"k{i % 500}" for i in range(1500)]
    for turn in range(3):
        names = keys if turn < 2 else ["new", *keys[:5]]
        pdf = pd.DataFrame({"seq": range(len(names)), "k": names, "v": 1, "_k": names})
        got = made["step"]((0,), pdf, held)
        want = pdf.groupby("k").cumcount() + 1 + np.where(pdf["k"] == "new", 0, 3 * turn)
        assert got["s"].tolist() == want.tolist() and got.columns.tolist() == ["seq", "k", "v", "s"]
    assert held.requests == 6  # it was two for each key and micro-batch


def test_stamps_of_a_bucket_are_one_request(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    class Value:
        def __init__(self):
            self.kept, self.requests = {}, 0

        def get(self, name):
            self.requests += 1
            return self.kept.get(name)

        def put(self, name, value):
            self.requests += 1
            self.kept[name] = value

    rows = spark.readStream.format("rate").load().select(
        F.lit("u").alias("op"), F.struct(F.col("value").alias("id")).alias("before"), F.struct(F.col("value").alias("id")).alias("after"),
        F.col("value").alias("ts"), F.col("value").alias("n"),
    )
    made = {}
    monkeypatch.setattr(processors, "process", lambda df, keys, order, out, step, *rest: made.update(step=step) or df)
    processors.newest_changes(rows, "id", ["ts", "n"])
    held, draw, known = Value(), np.random.default_rng(5), {}
    for _ in range(3):
        stamps = draw.integers(-3, 4, (900, 2))
        pdf = pd.DataFrame({"_key": [f"k{i}" for i in draw.integers(0, 400, 900)], "deleted": False, "ts": stamps[:, 0], "n": stamps[:, 1], "_row": "{}"})
        want = {}
        for k, *stamp in pdf[["_key", "ts", "n"]].itertuples(index=False, name=None):
            if tuple(stamp) > known.get(k, (-9, -9)):
                want[k] = known[k] = tuple(stamp)
        got = made["step"]((0,), pdf.sort_values(["ts", "n"], ignore_index=True), held)
        assert {k: (t, n) for k, t, n in zip(got["_key"], got["ts"], got["n"], strict=True)} == want
    assert held.requests == 6  # it was up to two for each key and micro-batch


def test_a_turn_of_changes_is_many_files(spark, tmp_path, monkeypatch):
    import glob

    from suite import streams

    rows = [(i, "P" if i % 3 else "O", START, f"{i}") for i in range(200)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string, o_orderdate timestamp, o_comment string").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(streams, "FILE_BYTES", 5_000)
    monkeypatch.setattr(streams, "shared_path", lambda spark, name: str(tmp_path / name))
    stream = streams.change_stream(spark, str(tmp_path))
    files = glob.glob(str(tmp_path / "change-log/*.parquet"))
    assert len(files) > 5 and len(files) % 5 == 0  # it was one for each of the five
    log = spark.read.parquet(str(tmp_path / "change-log"))
    assert log.count() == 600 + log.filter("pmod(xxhash64(offset), 4) = 3").distinct().count()
    assert log.distinct().count() == 600 and stream.isStreaming
