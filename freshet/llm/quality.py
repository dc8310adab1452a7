"""A quality classifier by nearest-neighbour voting.

A document is a bag of style terms: three characters in a row, each reduced to
its class, and how often a word repeats the one before. The labelled documents
of a bounded sample give weights and a latent-semantic space (a truncated
singular value decomposition). Their vectors are broadcast; every document's
cosines with all of them are computed block by block, and the labels of the
nearest vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import forget, unused

PER_LABEL = 2000  # labelled documents of each label that the space is fitted on, at most
DIMENSIONS = 32
NEIGHBOURS = 25
SHARPNESS = 16  # votes weigh similarity to this power
CLASSES = 40
TERMS = CLASSES**3 + 1  # the last one counts repeated words
REPEAT_WEIGHT = 9.0
BLOCK = 512  # documents whose cosines are computed at a time
SEED = 7


def character_classes() -> np.ndarray:
    """Small letters and bytes of other scripts, capitals and digits are one class
    each; other signs stand for themselves, control characters are two classes."""
    table, free = np.zeros(256, np.int32), 5
    for byte in range(128):
        sign = chr(byte)
        if sign.isupper():
            table[byte] = 1
        elif sign.isdigit():
            table[byte] = 2
        elif sign == "\n":
            table[byte] = 3
        elif byte < 32 or byte == 127:
            table[byte] = 4
        elif not sign.islower():
            table[byte] = free
            free += 1
    return table


CLASS = character_classes()


def terms(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of a text's terms."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    classes = CLASS[np.frombuffer(text, np.uint8)]
    numbers, counts = np.unique((classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:], return_counts=True)
    words = text.lower().split()
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    if repeats:
        numbers, counts = np.append(numbers, TERMS - 1), np.append(counts, REPEAT_WEIGHT * repeats)
    return numbers.astype(np.int64), counts.astype(np.float32)


@dataclass
class Space:
    """Weights of terms into the space, and the labelled vectors with their votes."""

    weights: np.ndarray  # terms x dimensions, with the terms' rarity
    rarity: np.ndarray
    vectors: np.ndarray  # of unit length
    labels: np.ndarray
    votes: np.ndarray
    base: float  # the share of label 1 among all labelled documents

    def place(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(found), self.weights.shape[1]), np.float32)
        for row, (numbers, counts) in enumerate(found):
            if len(numbers):
                out[row] = np.sqrt(counts) @ self.weights[numbers]
        return unit(out)

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Votes for label 1 as a share of all votes, for each document."""
        placed = self.place(found)
        answer = np.full(len(found), self.base)
        if not len(self.vectors):
            return answer
        cosines = placed @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosines, near, 1), 0, 1).astype(float) ** SHARPNESS * self.votes[near]
        total = weight.sum(1)
        known = (total > 0) & placed.any(1)
        answer[known] = ((weight * self.labels[near]).sum(1)[known] / total[known]).clip(0, 1)
        return answer


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


def space_of(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, totals: dict[int, int]) -> Space:
    """The space of labelled documents; ``totals`` counts all labelled ones by label."""
    all_labelled = sum(totals.values())
    base = totals.get(1, 0) / all_labelled if all_labelled else 0.5
    if not len(found):
        return Space(np.zeros((TERMS, 1), np.float32), np.zeros(TERMS), np.empty((0, 1), np.float32), labels, labels, base)
    present = np.zeros(TERMS)
    for numbers, _ in found:
        present[numbers] += 1
    used = np.flatnonzero(present >= min(2, len(found)))
    column = np.full(TERMS, -1)
    column[used] = np.arange(len(used))
    rarity = np.zeros(TERMS)
    rarity[used] = np.log(1 + len(found) / present[used])
    rows = np.zeros((len(found), len(used)), np.float32)
    for row, (numbers, counts) in enumerate(found):
        kept = column[numbers] >= 0
        rows[row, column[numbers[kept]]] = np.sqrt(counts[kept]) * rarity[numbers[kept]]
    rows = unit(rows)
    axes = main_axes(rows, DIMENSIONS)
    weights = np.zeros((TERMS, axes.shape[1]), np.float32)
    weights[used] = axes * rarity[used, None]
    votes = np.array([totals[label] / np.count_nonzero(labels == label) for label in labels])
    return Space(weights, rarity, unit(rows @ axes), labels, votes, base)


def main_axes(rows: np.ndarray, count: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    count = max(1, min(count, *rows.shape)) if rows.shape[1] else 1
    if not rows.shape[1]:
        return np.zeros((0, 1), np.float32)
    start = np.random.default_rng(SEED).standard_normal((rows.shape[1], min(count + 16, *rows.shape)))
    basis = np.linalg.qr(rows @ start)[0]
    for _ in range(3):
        basis = np.linalg.qr(rows @ (rows.T @ basis))[0]
    return np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:count].T.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", per_label: int = PER_LABEL) -> Space:
    """The space of at most ``per_label`` labelled documents of each label.

    ``labels`` has the id and a label of 0 or 1; other labels and nulls are left
    out. The sample is the documents with the smallest hashes of their ids, so
    it is the same in each run. Only their term counts come to the driver.
    A repeated id takes its first label in order; repeated documents repeat.
    """
    named = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1) AND id IS NOT NULL")
    named = named.groupBy("id").agg(F.min("label").alias("label"))
    totals = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    order = F.struct(F.xxhash64(F.col("id").cast("string")).alias("h"), "id", "label")
    chosen = None
    for value in (0, 1):
        part = named.filter(F.col("label") == value).select(order.alias("s")).orderBy("s").limit(per_label).select("s.id", "s.label")
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(t.as_py()) for t in batch.column(1)]
            numbers = pa.array([n for n, _ in found], pa.list_(pa.int64()))
            counts = pa.array([c for _, c in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), numbers, counts], names=["id", "label", "numbers", "counts"])

    kind = T.StructType(
        [
            T.StructField("id", texts.schema["id"].dataType),
            T.StructField("label", T.IntegerType()),
            T.StructField("numbers", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.FloatType())),
        ]
    )
    sample = texts.join(F.broadcast(chosen), "id").select("id", "text", "label").mapInArrow(counted, kind)
    rows = sample.drop("id").toArrow().to_pydict()
    found = [(np.array(n, np.int64), np.array(c, np.float32)) for n, c in zip(rows["numbers"], rows["counts"], strict=True)]
    order_of = sorted(range(len(found)), key=lambda i: (rows["label"][i], found[i][0].tobytes(), found[i][1].tobytes()))
    return space_of([found[i] for i in order_of], np.array([rows["label"][i] for i in order_of], np.int64), totals)


def score(docs: DataFrame, space: Space, out: str = "score", text: str = "text") -> DataFrame:
    """All rows with ``out``, from 0 to 1, higher if label 1 is likelier.

    The score comes from the text alone. A null or empty text, and one that
    shares no term with the labelled ones, gets the share of label 1 among all
    labelled documents (0.5 without any). Every row keeps its place, repeated
    rows too; a column called ``out`` is replaced.
    """
    rows = docs.withColumn(unused(docs.columns, "_body"), F.col(text).cast("binary")).drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(space)  # bounded by the sample and the terms
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                scores = shared.value.scores([terms(t.as_py()) for t in part.column(part.num_columns - 1)])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], names=schema.names)

    return rows.mapInArrow(run, schema)
