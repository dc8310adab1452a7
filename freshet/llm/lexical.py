"""Ranked lexical search by two trees.

Items and documents are points with one coordinate for each term. A tree over
the items and a tree over each batch of documents hold, at every node, the
largest value of each coordinate below it. The product of two nodes' maxima is at
least the score of any item and document below them, so a pair of nodes whose
product is less than the weakest of its items' k best scores is left out, with
all its pairs. Everything else is scored exactly, in whole numbers.

Items are taken in blocks of bounded size. Each task keeps the k best of each
item so far, goes through its batches from the most promising nodes down, and
gives on only what is among its own k best.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.graph import written

# The pattern of terms and the constants of the score.
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SHARE, SCALE, GAIN = 75, 1_000_000_000, 8
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

BLOCK_CHARS = 200_000  # characters of the items that one pass over the documents serves
FAN, LEAF_DOCS, LEAF_ITEMS = 8, 32, 4
BATCH_DOCS, BATCH_CELLS = 2048, 24_000_000  # documents in one tree, and cells of its table of maxima
EXACT = float(1 << 52)  # sums below it are exact in doubles


def terms(text: str | None) -> list[str]:
    return TERMS.findall(text.translate(LOWER)) if text else []


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    """Weight of each term by the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in holding.tolist()], np.int64)


def impacts(times: np.ndarray, lengths: list[int], sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """A term's whole-number value in its document, before the weight."""
    size = [100 - SHARE + SHARE * n * documents // words if words else 100 for n in lengths]  # Python's integers have no end
    return SCALE * times // (1000 * times + GAIN * np.repeat(np.array(size, np.int64), sizes))


class Tree:
    """Rows in a fixed order; each level holds the maxima of up to ``FAN`` nodes of the level below.

    ``levels[0]`` are the leaves, of ``leaf`` rows each.
    """

    def __init__(self, owner: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, width: int, leaf: int):
        self.rows, self.leaf = rows, leaf
        low = np.zeros((max(1, -(-rows // leaf)), width), np.float64)
        np.maximum.at(low, (owner // leaf, column), value)
        self.levels = [low]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), FAN), axis=0))

    def children(self, level: int, node: int) -> range:
        return range(node * FAN, min((node + 1) * FAN, len(self.levels[level - 1])))

    def members(self, leaf: int) -> range:
        return range(leaf * self.leaf, min((leaf + 1) * self.leaf, self.rows))


class Search:
    """The k best documents of some items, over batches of documents."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray]], width: int, k: int):
        """``items`` holds each one's terms, rising, and their weights times repeats; those alike lie together."""
        self.items, self.width, self.k = items, width, k
        sizes = [len(t) for t, _ in items]
        columns = np.concatenate([t for t, _ in items]) if items else np.zeros(0, np.int64)
        values = np.concatenate([w for _, w in items]) if items else np.zeros(0, np.int64)
        self.tree = Tree(np.repeat(np.arange(len(items)), sizes), columns, values, len(items), width, LEAF_ITEMS)
        self.best: list[list[tuple]] = [[] for _ in items]
        self.floors = np.zeros(len(items))  # kth best score so far; a document must reach it, and be above 0
        self.scored = self.skipped = 0

    def floor(self, level: int, node: int) -> float:
        span = LEAF_ITEMS * FAN**level
        return self.floors[node * span : (node + 1) * span].min()

    def add(self, ids: list, sizes: np.ndarray, columns: np.ndarray, values: np.ndarray) -> None:
        """A batch of documents: their terms, ``sizes`` of them for each, and the terms' values."""
        if not len(ids) or not self.items:
            return
        ids, sizes, columns, values = alike_together(ids, sizes, columns, values, self.width)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(ids)), sizes)
        docs = Tree(owner, columns, values, len(ids), self.width, LEAF_DOCS)
        sparse: dict[int, np.ndarray] = {}

        def table(leaf: int) -> np.ndarray:
            if leaf not in sparse:
                own = docs.members(leaf)
                at = slice(starts[own.start], starts[own.stop])
                sparse[leaf] = np.zeros((len(own), self.width), np.int64)
                sparse[leaf][owner[at] - own.start, columns[at]] = values[at]
            return sparse[leaf]

        stack = [(len(self.tree.levels) - 1, 0, len(docs.levels) - 1, 0, np.inf)]
        while stack:
            mine, item_node, theirs, doc_node, bound = stack.pop()
            if bound < self.floor(mine, item_node) or not bound:
                self.skipped += 1
                continue
            if not mine and not theirs:
                own = self.tree.members(item_node)
                for item in own:
                    self.score(item, docs.levels[0][doc_node], lambda: table(doc_node), docs.members(doc_node), ids)
                continue
            inner = self.tree.children(mine, item_node) if mine else range(item_node, item_node + 1)
            outer = docs.children(theirs, doc_node) if theirs else range(doc_node, doc_node + 1)
            mine, theirs = max(0, mine - 1), max(0, theirs - 1)
            bounds = self.tree.levels[mine][inner.start : inner.stop] @ docs.levels[theirs][outer.start : outer.stop].T
            bounds = np.where(bounds < EXACT, bounds, np.inf)
            # The most promising pair is taken last from the list, so it lies on top.
            for at in np.argsort(bounds, axis=None, kind="stable"):
                i, d = divmod(int(at), len(outer))
                stack.append((mine, inner[i], theirs, outer[d], bounds[i, d]))

    def score(self, item: int, maxima: np.ndarray, table, members: range, ids: list) -> None:
        columns, weight = self.items[item]
        bound = float(maxima[columns] @ weight)
        if not bound or bound < min(self.floors[item], EXACT):
            self.skipped += 1
            return
        self.scored += 1
        scores = table()[:, columns] @ weight
        good = np.flatnonzero(scores >= max(1, self.floors[item]))
        if len(good):
            found = self.best[item] + [(-int(scores[g]), ids[members.start + g]) for g in good]
            self.best[item] = sorted(found, key=by_score_and_id)[: self.k]
            if len(self.best[item]) == self.k:
                self.floors[item] = -self.best[item][-1][0]


def by_score_and_id(found: tuple) -> tuple:
    return found[0], found[1] is None, found[1] or 0


def alike_together(ids: list, sizes: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> tuple:
    """The documents sorted by their most telling terms, so that nodes hold documents alike."""
    held = np.bincount(columns, minlength=width) + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    telling = values * np.log2(2 * len(sizes) / held[columns])
    order = np.lexsort((-telling, owner))
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(columns)) - np.repeat(starts, sizes)
    first = [np.full(len(sizes), -1), np.full(len(sizes), -1)]
    for n in range(2):
        at = place == n
        first[n][owner[order][at]] = columns[order][at]
    turn = np.lexsort((first[1], first[0]))
    moved = np.argsort(turn)[owner]
    back = np.lexsort((columns, moved))
    return [ids[i] for i in turn], sizes[turn], columns[back], values[back]


def postings(docs: DataFrame, vocabulary: dict[str, int], doc_id: str, text: str) -> DataFrame:
    """Each document's id, its number of terms, and those in the vocabulary with their repeats."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    known = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for batch in batches:
            lengths, found, times, sizes = [], [], [], []
            for t in batch.column(1):
                counts = Counter(terms(t.as_py()))
                lengths.append(counts.total())
                own = sorted((place[w], n) for w, n in counts.items() if w in place)
                found += [c for c, _ in own]
                times += [n for _, n in own]
                sizes.append(len(own))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((found, pa.int32()), (times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], names=["id", "n", "terms", "times"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n long, terms array<int>, times array<long>")


def ranked_block(docs: DataFrame, items: list[tuple], k: int, doc_id: str, text: str) -> DataFrame:
    """``item`` (its number in the list), ``rank``, the document's id and ``score`` for some items."""
    counts = [Counter(terms(t)) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    rows = written(postings(docs, vocabulary, doc_id, text), "postings")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("words")).first()
    documents, words = total["n"], int(total["words"] or 0)
    holding = np.zeros(len(vocabulary), np.int64)
    shares = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("docs"))
    for r in shares.toLocalIterator():  # no more rows than the block's items have terms
        holding[r["term"]] = r["docs"]
    weight = weights(documents, holding)
    columns = [np.array(sorted(vocabulary[t] for t in c), np.int64) for c in counts]
    names = list(vocabulary)
    vectors = [(c, weight[c] * np.array([own[names[i]] for i in c], np.int64)) for c, own in zip(columns, counts, strict=True)]
    order = sorted(range(len(items)), key=lambda i: vectors[i][0][np.argsort(-vectors[i][1], kind="stable")][:2].tolist())
    width = max(1, len(vocabulary))
    shared = rows.sparkSession.sparkContext.broadcast([vectors[i] for i in order])
    size = max(LEAF_DOCS, min(BATCH_DOCS, BATCH_CELLS // width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, width, k)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                ids, lengths = part.column(0).to_pylist(), part.column(1).to_pylist()
                sizes = part.column(2).value_lengths().to_numpy()
                found, times = part.column(2).flatten().to_numpy().astype(np.int64), part.column(3).flatten().to_numpy()
                search.add(ids, sizes, found, impacts(times, lengths, sizes, documents, words))
        best = [(order[i], d, -s) for i, own in enumerate(search.best) for s, d in own]
        if best:
            item, ids, scores = zip(*best, strict=True)
            arrays = [pa.array(item, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", "id", "score"])

    found = rows.mapInArrow(run, f"item long, id {rows.schema['id'].dataType.simpleString()}, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Each item's ``k`` best documents: item id, ``rank`` from 1, document id, ``score``.

    Terms are runs of ASCII letters, digits and all other non-ASCII characters,
    A-Z lower-cased. Only scores above 0 count; equal scores rank by the
    document's id, a null id last. A null or empty text has no terms, so such items
    give no rows and such documents are never found. Repeated rows of documents
    are documents of their own; a repeated item (id and text) is one item,
    and one id with several texts is several items, each ranked from 1.
    Other columns are ignored. Items are served in blocks of about ``BLOCK_CHARS``
    characters, each in one pass over all documents.
    """
    asked = items.select(F.col(item_id).alias("_item"), F.col(text).cast("string").alias("_text")).distinct()
    asked = written(asked.withColumn("_size", F.coalesce(F.char_length("_text"), F.lit(0)).cast("long")), "items")
    blocks = -(-int(asked.agg(F.sum("_size")).first()[0] or 0) // BLOCK_CHARS)
    kinds = f"{item_id} {asked.schema['_item'].dataType.simpleString()}, rank int, {doc_id} {docs.schema[doc_id].dataType.simpleString()}, score long"
    out = None
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks)) == block)
        texts = [(r["_item"], r["_text"]) for r in own.select("_item", "_text").toLocalIterator()]
        names = docs.sparkSession.createDataFrame([(i, n) for n, (i, _) in enumerate(texts)], f"{item_id} {asked.schema['_item'].dataType.simpleString()}, item long")
        found = ranked_block(docs, texts, k, doc_id, text).join(F.broadcast(names), "item")
        found = found.select(item_id, "rank", F.col("id").alias(doc_id), "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], kinds)
