"""Folders of files that arrive in a known order."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile
import time

from freshet.schemas import LOG


def add_file(spark, folder, rows, schema, number):
    """Rows as one Parquet file; a higher number means a younger file."""
    os.makedirs(folder, exist_ok=True)
    made = tempfile.mkdtemp(prefix="feed-")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(made)
    part = os.path.join(made, next(f for f in os.listdir(made) if f.endswith(".parquet")))
    at = time.time() - 10_000 + number
    os.utime(part, (at, at))
    os.replace(part, os.path.join(folder, f"part-{number:03d}.parquet"))


def write_files(spark, folder, rows, schema, files, shuffle=None):
    size = -(-len(rows) // files)
    for i in range(files):
        part = rows[i * size : (i + 1) * size]
        if shuffle:
            shuffle.shuffle(part)
        add_file(spark, folder, part, schema, i)


def log_rows(payloads, topic="t"):
    """Payloads as log records of one partition with rising offsets."""
    at = dt.datetime(2024, 1, 1)
    text = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return [(None, p.encode(), topic, 0, i, at) for i, p in enumerate(text)]


def write_log(spark, folder, payloads, files):
    write_files(spark, folder, log_rows(payloads), LOG, files)
