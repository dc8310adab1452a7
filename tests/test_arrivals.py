"""Tables that arrive as streams."""

import pytest
from pyspark.sql import functions as F

from freshet.streaming import runs
from suite import streams


@pytest.mark.parametrize("bytes_", [2_000, 10_000_000])
def test_micro_batches_are_ranges_of_several_files(spark, tmp_path, monkeypatch, bytes_):
    monkeypatch.setattr(streams, "FILE_BYTES", bytes_, raising=False)
    # Shuffled, with a gap that leaves ranges without rows, and a row without order.
    ids = spark.range(0, 600, 1, 3).select(F.when(F.col("id") < 599, F.col("id") + F.when(F.col("id") > 200, 900).otherwise(0)).alias("n"))
    ids.withColumn("text", F.repeat(F.lit("x"), 40)).orderBy(F.xxhash64("n")).write.parquet(str(tmp_path / "t.parquet"))
    seen = []

    def each(batch, n):
        rows = batch.select("n", F.input_file_name().alias("f")).collect()
        found = [r.n for r in rows if r.n is not None]
        seen.append((min(found), max(found), len(rows), len({r.f for r in rows})))

    runs.finish(runs.start(runs.to_batches(streams.arriving(spark, str(tmp_path), "t", "n"), each, str(tmp_path / "check"))))
    assert sum(s[2] for s in seen) == 600
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))  # in order, none a row of a later one
    files = {s[3] for s in seen[:-1]}
    assert len(files) == 1 and (files.pop() > 1) == (bytes_ < 10_000)  # one task wrote a whole micro-batch


def test_an_empty_table_arrives(spark, tmp_path):
    spark.range(0).select(F.col("id").alias("n")).write.parquet(str(tmp_path / "t.parquet"))
    seen = []
    rows = streams.arriving(spark, str(tmp_path), "t", "n")
    runs.finish(runs.start(runs.to_batches(rows, lambda batch, n: seen.append(batch.count()), str(tmp_path / "check"))))
    assert sum(seen) == 0
