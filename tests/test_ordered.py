"""Ordered operators against plain Python loops, with and without hot keys."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshet.operators import ordered
from freshet.operators.ranking import rank_asof

# One key holds about a third of all rows; one key is null.
CUT = [{}, {"span": 16, "hot_rows": 16}, {"span": 7, "hot_rows": 100}, {"span": 64, "hot_rows": 1}]


def make_rows(n=600, seed=3):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + list("abcdefghi") + [None]
    return [(i * 3, rng.choice(keys), rng.randint(-3, 9), rng.choice(["x", "y", None])) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "seq long, k string, v int, c string").repartition(3).cache()


def by_seq(df, *columns):
    return {r["seq"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


@pytest.mark.parametrize("cut", CUT)
def test_running_sum_and_count(frame, rows, cut):
    total, number = defaultdict(int), defaultdict(int)
    want = {}
    for seq, k, v, _ in rows:
        before = total[k]
        total[k] += v
        number[k] += 1
        want[seq] = (total[k], before, number[k])
    out = ordered.running_sum(frame, "k", "seq", "v", "s", **cut)
    out = ordered.running_sum(out, "k", "seq", "v", "b", inclusive=False, **cut)
    out = ordered.running_count(out, "k", "seq", "n", **cut)
    assert by_seq(out, "s", "b", "n") == want


@pytest.mark.parametrize("cut", CUT)
def test_running_sum_without_key(frame, rows, cut):
    total, want = 0, {}
    for seq, _, v, _ in rows:
        total += v
        want[seq] = total
    assert by_seq(ordered.running_sum(frame, [], "seq", "v", "s", **cut), "s") == want


@pytest.mark.parametrize("cut", CUT)
def test_shifted(frame, rows, cut):
    seen, want = {}, {}
    for seq, k, v, c in rows:
        want[seq] = seen.get(k)
        seen[k] = c
    assert by_seq(ordered.shifted(frame, "k", "seq", "c", "p", **cut), "p") == want
    seen, want = {}, {}
    for seq, k, v, c in reversed(rows):
        want[seq] = seen.get(k)
        seen[k] = c
    assert by_seq(ordered.shifted(frame, "k", "seq", "c", "p", back=False, **cut), "p") == want


@pytest.mark.parametrize("cut", CUT)
def test_changed(frame, rows, cut):
    seen, want = {}, {}
    for seq, k, v, _ in rows:
        want[seq] = k in seen and seen[k] != v
        seen[k] = v
    assert by_seq(ordered.changed(frame, "k", "seq", "v", "alert", **cut), "alert") == want


@pytest.mark.parametrize("cut", CUT)
def test_latched(spark, frame, rows, cut):
    fails, want = defaultdict(int), {}
    for seq, k, v, _ in rows:
        want[seq] = fails[k] > 5 or k == "c"
        fails[k] += v < 0
    seed = spark.createDataFrame([("c",), ("c",)], "k string")
    out = ordered.latched(frame, "k", "seq", F.col("v") < 0, "blocked", after=5, seed=seed, **cut)
    assert by_seq(out, "blocked") == want


def test_latch_at_exactly_five_and_six_failures(spark):
    data = [(i, "five", 1) for i in range(5)] + [(9, "five", 0)] + [(i + 20, "six", 1) for i in range(6)] + [(30, "six", 0)]
    df = spark.createDataFrame(data, "seq long, k string, f int")
    out = by_seq(ordered.latched(df, "k", "seq", F.col("f") == 1, "blocked", after=5), "blocked")
    assert out[9] is False
    assert out[25] is False and out[30] is True


@pytest.mark.parametrize("cut", CUT)
def test_halving_fold(frame, rows, cut):
    state = {}
    for _, k, v, _ in rows:
        state[k] = (state[k] + v) / 2 if k in state else v
    out = {r["k"]: r["s"] for r in ordered.halving_fold(frame, "k", "seq", "v", "s", **cut).collect()}
    assert out.keys() == state.keys()
    for k, s in state.items():
        assert out[k] == pytest.approx(s, abs=1e-9)


def test_too_many_hot_keys_cuts_all(frame, rows, monkeypatch):
    monkeypatch.setattr(ordered, "HOT_KEYS", 2)
    total, want = defaultdict(int), {}
    for seq, k, v, _ in rows:
        total[k] += v
        want[seq] = total[k]
    assert by_seq(ordered.running_sum(frame, "k", "seq", "v", "s", span=50, hot_rows=3), "s") == want


@pytest.mark.parametrize("band", [None, 8, 37, 2000])
def test_rank_asof(spark, band):
    rng = random.Random(5)
    names = ["hot"] * 4 + [f"p{i}" for i in range(12)]
    data = [(i * 2 + 1, rng.choice(names), rng.choice([0, 1, 1, 5, -2])) for i in range(400)]
    total, want = defaultdict(int), {}
    for seq, k, v in data:
        total[k] += v
        ordered_names = sorted(total, key=lambda name: (total[name], name), reverse=True)
        want[seq] = (total[k], ordered_names.index(k))
    df = spark.createDataFrame(data, "seq long, player string, points int").repartition(3)
    hot = {} if band is None else {"hot_rows": 20}
    out = rank_asof(df, "player", "seq", "points", band=band, **hot)
    assert by_seq(out, "total_score", "current_rank") == want
    assert out.columns == ["seq", "player", "points", "total_score", "current_rank"]


ORDERS = {
    "null first": ("int", lambda i: None if i == 0 else i * 1000),
    "time": ("timestamp", lambda i: datetime(2020, 1, 1) + timedelta(microseconds=i * 7919)),
    "text": ("string", lambda i: f"{i:05d}"),
    "sparse": ("long", lambda i: i**3 * 1_000_003),
    "negative": ("double", lambda i: i - 150.5),
}


@pytest.mark.parametrize("cut", [{}, {"span": 30, "hot_rows": 20}, {"span": 7, "hot_rows": 100}])
@pytest.mark.parametrize("order", ORDERS)
def test_any_order_gives_the_same_in_blocks(spark, order, cut):
    kind, at = ORDERS[order]
    data = [("hot" if i % 3 else "cold", at(i), i) for i in range(300)]
    df = spark.createDataFrame(data, f"k string, o {kind}, v int").repartition(3)
    out = ordered.running_count(df, "k", "o", "n", **cut)
    out = ordered.shifted(out, "k", "o", "v", "before", **cut)
    seen, want = {}, {}
    for k, _, v in data:
        n, before = seen.get(k, (0, None))
        seen[k] = (n + 1, v)
        want[v] = (n + 1, before)
    assert {r["v"]: (r["n"], r["before"]) for r in out.collect()} == want


def test_repeated_order_values_stay_in_one_block(spark):
    df = spark.createDataFrame([("a", i // 50, 1) for i in range(300)], "k string, o int, v int")
    out = ordered.running_sum(df, "k", "o", "v", "s", span=20, hot_rows=10).collect()
    assert sorted(r["s"] for r in out) == list(range(1, 301))
    assert all(r["o"] * 50 < r["s"] <= r["o"] * 50 + 50 for r in out)


def test_short_blocks_take_no_task_each(spark):
    df = spark.createDataFrame([(i % 5, i, 1) for i in range(3000)], "k int, seq long, v int")
    blocked, groups = ordered.cut_hot_keys(df, ["k"], ["seq"], span=10, hot_rows=10)
    sizes = [r["count"] for r in blocked.groupBy(*groups).count().collect()]
    assert len(sizes) >= 300 and max(sizes) <= 10
    files = [f for f in blocked.inputFiles() if f.endswith(".parquet")]
    assert len(files) < 20  # each block had a task and a file of its own


def test_narrow_rank_bands_never_outgrow_the_records(spark):
    df = spark.createDataFrame([(i, f"p{i % 40}", i % 7) for i in range(3000)], "seq long, player string, points int")
    out = rank_asof(df, "player", "seq", "points", band=2)
    plan = out._jdf.queryExecution().analyzed().toString()
    grid = [line for line in plan.splitlines() if "Range (0," in line]
    assert grid and "Range (0, 56" in grid[0]  # 1,500 bands would make 2,250,000 cells of 3,000 records
    assert by_seq(out, "current_rank") == by_seq(rank_asof(df, "player", "seq", "points"), "current_rank")


def test_hot_rows_are_computed_twice_at_most(spark):
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    df = spark.range(2000).selectExpr("id % 3 as k", "id as seq").mapInPandas(counted, "k long, seq long")
    ordered.cut_hot_keys(df, [], ["seq"], span=100, hot_rows=100)
    assert made.value <= 4000  # counted, sampled and dealt, they were computed four times


def test_rank_asof_tasks_grow_with_the_rows(spark, monkeypatch):
    from freshet.operators import ranking

    monkeypatch.setattr(ranking, "TASK_ROWS", 40, raising=False)
    rows = [(i, f"p{i * 7 % 11}", i * 5 % 13) for i in range(200)]
    df = spark.createDataFrame(rows, "seq long, player string, points long")
    got = rank_asof(df, "player", "seq", "points")
    totals, want = {}, []
    for seq, player, points in rows:
        totals[player] = totals.get(player, 0) + points
        own = (totals[player], player)
        want.append((seq, own[0], sum((t, p) > own for p, t in totals.items())))
    assert sorted(tuple(r) for r in got.select("seq", "total_score", "current_rank").collect()) == want
    assert got.rdd.getNumPartitions() == 5  # it was the width of a shuffle, however many rows
