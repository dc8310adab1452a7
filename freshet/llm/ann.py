"""Nearest neighbours by cross-polytope hashing.

A table turns a unit vector by three rounds of random signs and a fast Hadamard
transform, which acts like a random rotation, and files it under the signed axis
that it then lies nearest to. Queries look under several axes of each table, the
nearest first, and all vectors found are ranked by their exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

TABLES = 16
PROBES = 6  # axes that a query looks under in each table
HELD = 500_000  # answers that a task holds before it drops the worse ones
SEED = 11


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Rows of 2^k numbers, each times the orthogonal Hadamard matrix."""
    count, width = rows.shape
    span = 1
    while span < width:
        pairs = rows.reshape(count, width // (2 * span), 2, span)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(count, width)
        span *= 2
    return rows / np.sqrt(width)


def signs(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, width]).choice([-1.0, 1.0], (tables, 3, width))


def rotated(rows: np.ndarray, turns: np.ndarray) -> np.ndarray:
    for turn in turns:
        rows = hadamard(rows * turn)
    return rows


def padded(rows: np.ndarray) -> np.ndarray:
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def axes(rows: np.ndarray, tables: int, probes: int, seed: int = SEED) -> np.ndarray:
    """The nearest signed axes of unit vectors: table by row by probe, the nearest first."""
    rows = padded(rows)
    out = []
    for turns in signs(rows.shape[1], tables, seed):
        turned = rotated(rows, turns)
        both = np.concatenate([turned, -turned], 1)
        count = min(probes, both.shape[1])
        top = np.argpartition(-both, count - 1, 1)[:, :count]
        order = np.argsort(-np.take_along_axis(both, top, 1), 1, kind="stable")
        out.append(np.take_along_axis(top, order, 1))
    return np.array(out)


def usable(vectors: DataFrame, vec_id: str, vector: str, number: str) -> DataFrame:
    """Id and vector, without vectors that are null, empty, zero or hold
    nulls or numbers that are not finite, and without null ids."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(f"array<{number}>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def by_width(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    widths = np.array([len(v) for v in batch.column(1)])
    for width in np.unique(widths):
        yield batch.filter(pa.array(widths == width))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)  # squares stay finite
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision, the same for equal vectors wherever they stand."""
    q, rows = query / np.abs(query).max(), rows / np.abs(rows).max(1, keepdims=True)
    return (rows * q).sum(1) / (np.sqrt((rows * rows).sum(1)) * np.sqrt((q * q).sum()))


class Best:
    """The k best rows of each query met so far in a task."""

    def __init__(self, k: int):
        self.k, self.parts, self.held = k, [], 0

    def add(self, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.parts.append((queries, ids, scores))
        self.held += len(queries)
        if self.held > HELD:
            self.prune()

    def prune(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row once per query, the k nearest, ties by id."""
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        queries, ids, scores = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((-scores, ids, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        first = np.ones(len(ids), bool)
        first[1:] = (queries[1:] != queries[:-1]) | (ids[1:] != ids[:-1])
        queries, ids, scores = queries[first], ids[first], scores[first]
        order = np.lexsort((ids, -scores, queries))
        queries, ids, scores = queries[order], ids[order], scores[order]
        begins = np.flatnonzero(np.r_[True, queries[1:] != queries[:-1]])
        place = np.arange(len(queries)) - np.repeat(begins, np.diff(np.r_[begins, len(queries)]))
        kept = place < self.k
        self.parts = [(queries[kept], ids[kept], scores[kept])]
        self.held = int(kept.sum())
        return self.parts[0]


def compare(query_ids: np.ndarray, asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple:
    """The k best rows of a bucket's piece for each query that looks there."""
    close = unit(asked) @ unit(rows).T
    close[query_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        bound = np.partition(close, len(ids) - k, 1)[:, len(ids) - k, None] - 1e-9
    else:
        bound = np.full((len(query_ids), 1), -2.0)
    q, r = np.nonzero((close >= bound) & np.isfinite(close))
    return query_ids[q], ids[r], exact(asked[q], rows[r])


def exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row cosines in double precision, the same for equal vectors wherever they stand."""
    left = left / np.abs(left).max(1, keepdims=True)
    right = right / np.abs(right).max(1, keepdims=True)
    return (left * right).sum(1) / (np.sqrt((left * left).sum(1)) * np.sqrt((right * right).sum(1)))


def filed(rows: DataFrame, tables: int, probes: int, seed: int, number: str) -> DataFrame:
    """Pieces of buckets: ``width`` and ``bucket``, ids and vectors end to end.

    A batch of rows gives one piece for each bucket that it meets, so a bucket
    with very many rows is a series of pieces and never one value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_width(batch):
                ids, vectors = np.asarray(part.column(0)), np.asarray(part.column(1).flatten()).reshape(part.num_rows, -1)
                near = axes(unit(vectors.astype(float)), tables, probes, seed)
                span = 2 * padded(vectors[:1]).shape[1]
                bucket = (near + span * np.arange(tables)[:, None, None]).ravel()
                owner = np.broadcast_to(np.arange(len(ids))[None, :, None], near.shape).ravel()
                order = np.argsort(bucket, kind="stable")
                bucket, owner = bucket[order], owner[order]
                begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                pieces = np.split(owner, begins[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([vectors.shape[1]] * len(pieces), pa.int32()),
                        pa.array(bucket[begins].astype(np.int32)),
                        pa.array([ids[p].tobytes() for p in pieces], pa.binary()),
                        pa.array([vectors[p].tobytes() for p in pieces], pa.binary()),
                    ],
                    names=["width", "bucket", "ids", "vectors"],
                )

    return rows.mapInArrow(run, f"width int, bucket int, {number}_ids binary, {number}_vectors binary")


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    tables: int = TABLES,
    probes: int = PROBES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    seed: int = SEED,
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` have an id and an array of numbers. A query finds
    any row but those of its own id; equal scores rank by id. Vectors that are
    null, empty or zero or hold nulls or numbers that are not finite take no
    part, nor do rows without an id, and only vectors of equal length meet. A
    repeated id is found once, by its best vector, and answers once. Other
    columns are ignored. Empty tables give no rows.

    Rows meet queries in the buckets that a probe of the query names, and only
    there. Buckets travel in pieces, a hot one is split between tasks, and a
    task keeps k rows for each query. Every row is filed once in each table.
    """
    double = dict(vectors.dtypes)[vector] != "array<float>" or dict(queries.dtypes)[vector] != "array<float>"
    number = "double" if double else "float"
    kind = "<f8" if double else "<f4"
    corpus = filed(usable(vectors, vec_id, vector, number), tables, 1, seed, "row")
    asked = filed(usable(queries, vec_id, vector, number), tables, probes, seed, "query")
    met = asked.join(corpus, ["width", "bucket"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for batch in batches:
            for width, _, query_ids, asked_bytes, ids, row_bytes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sides = [np.frombuffer(b, kind).reshape(-1, width).astype(float) for b in (asked_bytes, row_bytes)]
                best.add(*compare(np.frombuffer(query_ids, "<i8"), sides[0], np.frombuffer(ids, "<i8"), sides[1], k))
            if best.held > HELD // 2 and best.prune() and best.held > HELD // 2:
                yield answers(*best.parts[0])  # very many queries in one task
                best = Best(k)
        found = best.prune()
        if len(found[0]):
            yield answers(*found)

    found = met.mapInArrow(run, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def answers(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(queries), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])
