"""Near-duplicates by HyperMinHash.

A document is the set of its word shingles. Each of its 256 buckets keeps, of
the least hash that falls into it, the number of leading zeros and ten bits
behind them: 16 bits. An empty bucket borrows from the full one that comes first
in an order of its own. Bands of registers name the documents that may be alike.

Documents that share a band, directly or through others, are a family. Families
are compared in blocks: registers estimate the similarity, with the chance that
two registers agree by accident taken off, and pairs that may reach the
threshold are confirmed on their full sets. In a large family the members
outside its largest component so far meet all others, so that no link between
components is lost and no group of copies is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.chunks import forget, sliced
from freshet.llm.graph import components, written

BUCKETS, ROWS, BANDS = 256, 6, 42
MANTISSA = 10
BLOCK = 256  # members of a family in one block
BLOCK_SHINGLES = 1 << 18  # and their shingles
PIVOTS = 32  # members that a large family's blocks meet first
ERRORS = 5  # standard errors below the threshold at which a pair is still confirmed
CHANCE = 2.0**-MANTISSA / 3  # that two unlike registers agree
OUT_BYTES = 8 << 20
OUT = "doc_id long, n_shingles long, h1 long, h2 long, filled int, registers binary"
_ORDER = np.random.default_rng(17).permuted(np.tile(np.arange(1, BUCKETS + 1), (BUCKETS, 1)), axis=1)
np.fill_diagonal(_ORDER, 0)  # a full bucket is its own first choice


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words, A-Z lower-cased.

    A shorter text is one run of all its words; a text without words has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[at : len(words) - width + 1 + at])
    return np.unique(total)


def registers(hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Registers of a sorted set, and how many buckets it fills by itself."""
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    full, rest = bucket[first], hashes[first] << np.uint64(8)
    zeros = np.where(rest > 0, 64 - np.frexp(rest.astype(float))[1], 56).clip(0, 56).astype(np.uint64)
    values = (zeros << np.uint64(MANTISSA)) | ((rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA))
    if len(full) == BUCKETS:
        return values.astype(np.uint16), BUCKETS
    return values[_ORDER[:, full].argmin(1)].astype(np.uint16), len(full)


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One key per band of each row of registers."""
    used = rows[:, : ROWS * BANDS].reshape(len(rows), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), used.shape[:2])
    for at in range(ROWS):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + used[:, :, at])
    return total.view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """Set size, set hash and registers of every document (``id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = []
            for text in batch.column(1):
                hashes = shingles(text.as_py(), width)
                digest = xxhash.xxh3_128_digest(hashes.tobytes())
                held, filled = registers(hashes) if len(hashes) else (np.empty(0, np.uint16), 0)
                found.append((len(hashes), *np.frombuffer(digest, np.int64).tolist(), filled, held.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)] if found else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[n.split()[0] for n in OUT.split(", ")])

    return docs.mapInArrow(run, OUT)


def bands(rows: DataFrame) -> DataFrame:
    """``key`` and ``node`` for all bands of rows of ``node`` and ``registers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, BUCKETS)
            nodes = np.repeat(np.asarray(batch.column(0)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(band_keys(held).ravel()), pa.array(nodes)], names=["key", "node"])

    return rows.select("node", "registers").mapInArrow(run, "key long, node long")


def families(rows: DataFrame) -> DataFrame:
    """``node`` and ``family`` of the nodes that share a band with another one."""
    found = bands(rows)
    groups = found.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("most")).filter("pivot < most")
    edges = found.join(groups.select("key", "pivot"), "key").filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    return written(components(edges.distinct()).withColumnRenamed("component", "family"), "families")


def members(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Members of the families with their full sets and registers."""
    rows = docs.join(nodes.hint("merge"), docs["id"] == nodes["node"]).select("family", "node", "text")  # one plan at all sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            made = ((row, shingles(text.as_py(), width)) for row, text in enumerate(batch.column(2)))
            for part in sliced(((r, h) for r, h in made if len(h)), lambda m: m[1].nbytes + 512, OUT_BYTES):
                held = [registers(h) for _, h in part]
                at = pa.array([r for r, _ in part], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array([len(h) for _, h in part], pa.int64()),
                        pa.array([f for _, f in held], pa.int32()),
                        pa.array([r.tobytes() for r, _ in held], pa.binary()),
                        pa.array([h.tobytes() for _, h in part], pa.binary()),
                    ],
                    names=["family", "node", "n", "filled", "registers", "hashes"],
                )

    return rows.mapInArrow(run, "family long, node long, n long, filled int, registers binary, hashes binary")


def estimates(registers_: np.ndarray, filled: np.ndarray, one: np.ndarray, one_filled: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of one row of registers to others, and the least estimate worth confirming."""
    equal = (registers_ == one).mean(1)
    least = share - ERRORS * np.sqrt(share * (1 - share) / np.minimum(filled, one_filled))
    return (equal - CHANCE) / (1 - CHANCE), least


class Sets:
    """Which rows of a block are connected."""

    def __init__(self, names: list):
        self.parent = {n: n for n in names}

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a, b) -> None:
        self.parent[max(self.find(a), self.find(b))] = min(self.find(a), self.find(b))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def linker(percent: int):
    def links(table: pa.Table) -> pa.Table:
        """Links that join what is not joined yet, confirmed on the full sets: between
        rows of side 0 and side 1, or among all rows where side is 2."""
        forget()
        side, nodes, sizes, filled = (np.asarray(table[c]) for c in ("side", "node", "n", "filled"))
        held = np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(len(nodes), BUCKETS)
        sets = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        known, found = Sets(nodes.tolist()), []
        for node, part in zip(nodes.tolist(), table["part"].to_pylist(), strict=True):
            if part is not None:  # a component known before
                known.parent.setdefault(part, part)
                known.join(node, part)
        place = np.arange(len(nodes))
        for i in np.flatnonzero(side != 1):
            right = place[i + 1 :] if side[i] == 2 else np.flatnonzero(side == 1)
            sized = 100 * np.minimum(sizes[right], sizes[i]) >= percent * np.maximum(sizes[right], sizes[i])
            fits = right[sized & (nodes[right] != nodes[i])]
            guess, least = estimates(held[fits], filled[fits], held[i], filled[i], percent / 100)
            hopeful = guess >= least
            for j in fits[hopeful][np.argsort(-guess[hopeful])]:
                a, b = int(nodes[i]), int(nodes[j])
                if known.find(a) != known.find(b) and similar(sets[i], sets[j], percent):
                    known.join(a, b)
                    found.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return links


COLUMNS = ["family", "node", "part", "n", "filled", "registers", "hashes"]


def within(rows: DataFrame, percent: int) -> DataFrame:
    """Links between rows of one block."""
    whole = rows.select(*COLUMNS, "block", F.lit(2).alias("side"))
    return whole.groupBy("family", "block").applyInArrow(linker(percent), "a long, b long")


def between(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Links between rows of ``left`` and ``right`` of one family. Each pair of
    blocks is a group of its own, with a bound on its rows."""
    left_most = left.groupBy("family").agg(F.max("block").alias("l_most"))
    right_most = right.groupBy("family").agg(F.max("block").alias("r_most"))
    l_side = left.join(right_most, "family").select(
        *COLUMNS, F.lit(0).alias("side"), F.col("block").alias("l"), F.explode(F.sequence(F.lit(0), "r_most")).alias("r")
    )
    r_side = right.join(left_most, "family").select(
        *COLUMNS, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), "l_most")).alias("l"), F.col("block").alias("r")
    )
    return l_side.unionByName(r_side).groupBy("family", "l", "r").applyInArrow(linker(percent), "a long, b long")


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of each family dealt to blocks with a bound on rows and on shingles."""
    count = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = rows.groupBy("family").agg(count.alias("blocks"), F.count("*").alias("rows"))
    return rows.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))


def linked(docs: DataFrame, percent: int = 80, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Documents are linked if 100 times the shingles they share is at least
    ``percent`` times those of either, on full sets of runs of ``width`` words
    (words between ASCII white space, A-Z lower-cased; a shorter text is one
    run). ``component_id`` is the least id that links lead to, and ``kept`` tells
    the document that has it.

    A null or empty text, or one without words, has no shingles and is linked
    with nothing. A row with a null id is linked with nothing and has null
    results. Equal sets are linked; rows of one id are one document and are
    linked. Other columns are ignored; an empty table gives no rows. Ids are
    whole numbers. Shingles are told apart by 64-bit hashes.

    Sets that are equal meet once, as the least of their ids. A pair at the
    threshold shares no band with a chance of 3 in a million, and passes the
    estimate but for one in a million.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    signed = written(signatures(base, width), "signatures")
    held = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = written(held.groupBy("h1", "h2").agg(F.min("doc_id").alias("node")), "nodes")
    once = held.withColumnRenamed("doc_id", "node").join(nodes.select("node").hint("merge"), "node", "left_semi")
    family = families(once)
    found = written(members(base, family, width).withColumn("part", F.lit(None).cast("long")), "members")
    parts = components(links_of(in_blocks(found), percent))
    sets = signed.drop("registers", "filled").join(nodes, ["h1", "h2"], "left")
    named = sets.join(parts, "node", "left")
    lone = F.col("node").isNull() | F.col("doc_id").isNull()
    named = named.withColumn("component_id", F.when(lone, F.col("doc_id")).otherwise(F.coalesce("component", "node")))
    return named.select(F.col("doc_id").alias(doc_id), "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def links_of(rows: DataFrame, percent: int) -> DataFrame:
    """Links that connect the rows of all families (in blocks) as all their links would."""
    large = rows.filter("blocks > 1")
    links = written(within(rows, percent), "links")
    if large.isEmpty():
        return links
    pivots = large.filter(F.pmod(F.xxhash64("node", F.lit(1)), F.greatest(F.lit(1), F.expr(f"rows div {PIVOTS}"))) == 0)
    links = links.union(written(between(pivots.withColumn("block", F.lit(0)), large, percent), "links"))
    parts = components(links).withColumnRenamed("component", "known")
    known = written(large.drop("part").join(parts, "node", "left").withColumn("part", F.coalesce("known", "node")).drop("known"), "members")
    sizes = known.groupBy("family", "part").count()
    main = sizes.groupBy("family").agg(F.max(F.struct("count", "part")).alias("m")).select("family", F.col("m.part").alias("main"))
    others = known.join(main, "family").filter("part <> main").select(*COLUMNS)
    return links.union(written(between(in_blocks(others), known, percent), "links"))
