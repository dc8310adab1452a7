"""Users' functions of rows and groups: nulls, exact numbers, hot and too large groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from freshet.operators import custom

BIG = 2**62 + 1


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_row_function_skips_rows_with_nulls_and_keeps_numbers_exact(spark):
    df = spark.createDataFrame([(1, BIG, 1), (2, None, 1), (3, 5, None), (4, 7, 2)], "id int, a long, b long")
    add = custom.row_function(lambda a, b: a + b, "long")
    assert rows(df.select("id", add("a", "b"))) == [(1, BIG + 1), (2, None), (3, None), (4, 9)]
    assert rows(df.limit(0).select(add("a", "b"))) == []


def test_row_function_may_ask_for_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, a double")
    missing = custom.row_function(lambda a: a.isna(), "boolean", nulls=True)
    assert rows(df.select("id", missing("a"))) == [(1, False), (2, True), (3, False)]


def test_row_function_of_another_length_fails(spark):
    short = custom.row_function(lambda a: a[:1], "long")
    with pytest.raises(Exception, match="returned 1 values for 3 rows"):
        spark.range(3).coalesce(1).select(short("id")).collect()


def test_row_function_in_sql(spark):
    spark.udf.register("doubled", custom.row_function(lambda a: 2 * a, "long"))
    assert rows(spark.sql("SELECT doubled(id) AS x FROM VALUES (1), (NULL), (3) AS t(id)")) == [(2,), (6,), (None,)]


def test_flat_function_in_sql_and_on_a_frame(spark):
    def parts(text):
        for word in text.split():
            yield word, len(word)

    spark.udtf.register("parts", custom.flat_function(parts, "word string, size int"))
    df = spark.createDataFrame([(1, "a bb"), (2, ""), (3, None), (4, "a")], "id int, text string")
    df.createOrReplaceTempView("flat_texts")
    want = [(1, "a", 1), (1, "bb", 2), (4, "a", 1)]
    assert rows(spark.sql("SELECT id, word, size FROM flat_texts, LATERAL parts(text)")) == want
    assert rows(custom.flat_rows(df, parts, "text", "word string, size int").drop("text")) == want
    with pytest.raises(ValueError, match="id"):
        custom.flat_rows(df, parts, "text", "ID string, size int")


def sums():
    """Functions of a module stay behind on the driver, so these are made by a call."""

    def part(frame):
        known = [int(v) for v in frame["x"] if v is not None and v == v]
        return len(frame), sum(known), max(known, default=None)

    def merge(states):
        most = [v for v in states["most"] if v is not None and v == v]
        return int(states["n"].sum()), int(sum(states["total"])), max(most, default=None)

    return part, merge


STATE = "n long, total long, most long"


def test_fold_of_a_hot_group_equals_plain_aggregates(spark, monkeypatch):
    monkeypatch.setattr(custom, "MERGED_AT_ONCE", 3)
    monkeypatch.setattr(custom, "HELD_STATES", 5)
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 7).alias("j"),
        F.when(F.col("id") % 11 > 0, F.col("id")).alias("x"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        made = rows(custom.fold_groups(df.repartition(9), ["k", "j"], "x", *sums(), STATE))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = df.groupBy("k", "j").agg(F.count("*"), F.sum("x"), F.max("x"))
    assert made == rows(plain)


def test_fold_with_null_keys_null_values_and_clashing_names(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", BIG, 2), (None, 4, 3), ("b", None, 4)], "n string, x long, total int")
    df = df.withColumnRenamed("n", "k")
    out = custom.fold_groups(df, "k", "x", *sums(), STATE, most=F.col("most"), many=F.col("n") > 1)
    assert rows(out) == [("a", BIG, True), ("b", None, False)]
    assert rows(custom.fold_groups(df.limit(0), "k", "x", *sums(), STATE)) == []


def test_apply_to_whole_groups(spark):
    def spread(frame):
        known = [v for v in frame["x"] if v is not None]
        return pd.DataFrame({"rows": [len(frame)] * len(known), "x_again": known})

    df = spark.createDataFrame([("a", 1, BIG), ("a", 1, None), ("b", 1, None), (None, 1, 2), ("c", None, 3)], "k string, j int, x long")
    out = custom.apply_groups(df, ["k", "j"], spread, "rows long, x_again long")
    assert out.columns == ["k", "j", "rows", "x_again"] and rows(out) == [("a", 1, 2, BIG)]
    assert rows(custom.apply_groups(df.limit(0), "k", spread, "rows long, x_again long")) == []
    with pytest.raises(ValueError, match="has 2 rows, above 1"):
        custom.apply_groups(df, "k", spread, "rows long, x_again long", most_rows=1)
    with pytest.raises(ValueError, match="keys"):
        custom.apply_groups(df, "k", spread, "K long")


def test_apply_in_batches_sees_every_row_once(spark):
    df = spark.range(20_000).select((F.col("id") % 2).alias("k"), "id")

    def totals(frames):
        total = count = 0
        for frame in frames:
            assert len(frame) <= 1000
            total, count = total + int(np.sum(frame["id"])), count + 1
        yield pd.DataFrame({"total": [total], "several": [count > 1]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        out = rows(custom.apply_batches(df, "k", totals, "total long, several boolean"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == [(0, 99_990_000, True), (1, 100_000_000, True)]


def test_fold_calls_part_once_or_twice_for_each_small_group(spark, tmp_path):
    calls = str(tmp_path / "calls")
    sums_part, merge = sums()

    def part(frame):
        with open(calls, "a") as log:
            log.write(".")
        return sums_part(frame)

    df = spark.range(20_000).select((F.col("id") % 200).alias("k"), F.col("id").alias("x")).repartition(8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "250")
    try:
        made = rows(custom.fold_groups(df, "k", "x", part, merge, STATE))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert made == rows(df.groupBy("k").agg(F.count("*"), F.sum("x"), F.max("x")))
    assert len(open(calls).read()) <= 400  # one for every group in every batch would be about 14,000
