"""Alignment of two tokenizers' tokens by galloping intersection.

Both tokenizers spell the same bytes, so every token is known by the byte where
it ends. The two lists of ends rise. The shorter one drives a galloping search
into the longer: from where a neighbour was found, steps double until the end
is passed, then the last step is halved. Ends found in both lists cut the tokens
into groups; what lies between the ranks of two neighbouring ends is the range
of tokens that overlap.

How often a pair of ids is linked is counted over all documents. The most
frequent pairs, of a fixed number, are known to every task; all others are joined.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.bpe import WORDS
from freshet.llm.chunks import LETTERS, sliced
from freshet.llm.graph import written

FAN = 8  # ends that start their search from one found before
HEAD_PAIRS = 1 << 17  # most frequent pairs that every task knows; all others go through a join
TEXT_CHARS = 600_000  # characters of the texts that are aligned together
BLANKS = re.compile(r"\s{1000}")
_BOTH: dict = {}


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the rising ``short``, how many of the rising ``long`` lie below it.

    Every 8th of every 8th ... is searched first. The others gallop from the
    place of the one in front of them, all in step.
    """
    n, m = len(short), len(long)
    padded = np.append(long, np.iinfo(np.int64).max)
    place = np.zeros(n, np.int64)
    stride = 1
    while stride * FAN < n:
        stride *= FAN
    first = True
    while stride and n:
        at = np.arange(0, n, stride)
        if not first:
            at = at[at % (stride * FAN) > 0]
        low = np.zeros(len(at), np.int64) if first else place[at - at % (stride * FAN)]
        wanted, high, step = short[at], low.copy(), 1
        going = np.flatnonzero(padded[high] < wanted)
        while len(going):
            low[going] = high[going] + 1
            high[going] = np.minimum(low[going] + step, m)
            step *= 2
            going = going[padded[high[going]] < wanted[going]]
        while True:
            open_ = low < high
            if not open_.any():
                break
            middle = (low + high) >> 1
            below = open_ & (padded[middle] < wanted)
            low = np.where(below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        place[at] = low
        first, stride = False, stride // FAN
    return place


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which tokens of A and of B end where one of the other ends, and all pairs of
    tokens whose bytes overlap, as two lists of token numbers.

    Both lists must end at the same byte, and no token may be empty.
    """
    turned = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if turned else (ends_a, ends_b)
    last = gallop(short, long)  # the token of the other side in which an end lies
    meets = long[np.minimum(last, len(long) - 1)] == short if len(long) else np.zeros(0, bool)
    first = np.concatenate([[0], (last + meets)[:-1]]) if len(short) else last
    count = last - first + 1
    driver = np.repeat(np.arange(len(short)), count)
    other = np.arange(len(driver)) - np.repeat(np.cumsum(count) - count - first, count)
    also = np.zeros(len(long), bool)
    also[last[meets]] = True
    return (also, meets, other, driver) if turned else (meets, also, driver, other)


class ByteLevel:
    """Ids of a byte-level tokenizer file, its special tokens' strings being plain text.

    Where the merges rise with their ids, as usual, a faster library does the
    same. It can't take some texts with very long runs of blanks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        letters = {c: b for b, c in LETTERS.items()}
        size = max([*vocab.values(), *(a["id"] for a in content["added_tokens"])]) + 1
        self.labels = [b""] * size
        for token, i in vocab.items():
            self.labels[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.fast = self.quick(content, vocab)

    def quick(self, content: dict, vocab: dict[str, int]):
        merges = [m if isinstance(m, str) else " ".join(m) for m in content["model"]["merges"]]
        step = content["pre_tokenizer"] or {}
        known = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        made = [vocab[m.replace(" ", "")] for m in merges]
        singles = [i for t, i in vocab.items() if len(t) == 1]
        if not known or content.get("normalizer") or made != sorted(set(made)) or max(singles) > min(made, default=1 << 60):
            return None
        import tiktoken

        ranks = {self.labels[i]: i for i in vocab.values()}
        return tiktoken.Encoding("plain", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None and not BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids of a sentence-piece model, which puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.labels = [
            bytes([int(name[3:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Both:
    """The two tokenizers with the bytes of their tokens and the signs of the groups' text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.bytes_a, self.bytes_b = pa.array(self.a.labels, pa.binary()), pa.array(self.b.labels, pa.binary())
        self.size_a = np.array([len(x) for x in self.a.labels], np.int64)
        self.size_b = np.array([len(x) for x in self.b.labels], np.int64)
        self.width = len(self.size_b)
        signs = [f"{i}{s}".encode() for n, signs in ((len(self.size_a), ",|"), (self.width, ",;")) for s in signs for i in range(n)]
        self.signs = pa.array(signs, pa.large_binary())

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        ids_a, ids_b = np.array(self.a.encode(" " + text), np.int64), np.array(self.b.encode(text), np.int64)
        want = (" " + text).encode()
        if spelled(self.bytes_a, ids_a) != want or spelled(self.bytes_b, ids_b) != want:
            return none, none
        return ids_a, ids_b

    def align(self, texts: list[str | None]) -> dict:
        """Counts, digests and linked pairs of ids of some texts, as columns."""
        pairs = [self.tokens(t) for t in texts]
        docs = np.arange(len(texts))
        n_a, n_b = (np.array([len(p[i]) for p in pairs], np.int64) for i in (0, 1))
        a, b = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut_a, cut_b, link_a, link_b = overlaps(ends_a, ends_b)
        # Texts of groups: each side's ids stand behind those of the groups before on the other side.
        over_a, over_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        signs = np.empty(len(a) + len(b), np.int64)
        signs[np.arange(len(a)) + np.concatenate([[0], over_b + 1])[group_a]] = a + cut_a * len(self.size_a)
        signs[np.arange(len(b)) + (over_a + 1)[group_b] if len(b) else over_a] = b + 2 * len(self.size_a) + cut_b * self.width
        spelled_out = self.signs.take(pa.array(signs))
        places = np.frombuffer(spelled_out.buffers()[1], "<i8", len(signs) + 1)[np.concatenate([[0], np.cumsum(n_a + n_b)])]
        letters = memoryview(spelled_out.buffers()[2] or b"")
        digests = [
            hashlib.sha256(letters[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(places, places[1:], strict=False)
        ]
        doc_a = np.repeat(docs, n_a)
        codes = doc_a[link_a] * (len(self.size_a) * self.width) + a[link_a] * self.width + b[link_b]
        codes, times = np.unique(codes, return_counts=True)
        owner, codes = np.divmod(codes, len(self.size_a) * self.width)
        held = np.bincount(owner, minlength=len(texts))
        offsets = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
        count = lambda of: np.bincount(of, minlength=len(texts)).astype(np.int64)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": count(doc_a[over_a]),
            "n_links": count(doc_a[link_a]),
            "groups_sha256": digests,
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(codes)),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times)),
        }


def spelled(labels: pa.Array, ids: np.ndarray) -> bytes:
    return (labels.take(pa.array(ids)).buffers()[2] or pa.py_buffer(b"")).to_pybytes()


def both(path_a: str, path_b: str) -> Both:
    """The tokenizers of two paths, made once per Python worker."""
    if (path_a, path_b) not in _BOTH:
        _BOTH[path_a, path_b] = Both(path_a, path_b)
        gc.collect()
        gc.freeze()
    return _BOTH[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's id, counts, digest of groups, and its distinct linked pairs
    of ids (``a * width of B + b``) with how often each is linked."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    schema = (
        f"_id {rows.schema['_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pairs array<long>, times array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = both(path_a, path_b)
        for batch in batches:
            at = 0
            for part in sliced((t.as_py() for t in batch.column(1)), lambda t: len(t or "") + 1, TEXT_CHARS):
                columns = coders.align(part)
                yield pa.RecordBatch.from_pydict({"_id": batch.column(0).slice(at, len(part)), **columns})
                at += len(part)

    return rows.mapInArrow(run, schema)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """``pair``, the number of documents ``docs`` that link it, and whether it is
    ``best``: no pair of its A id is in more documents."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = written(counts.withColumn("a", F.expr(f"pair div {width}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))  # no more rows than A has ids
    return counts.join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Aligns the tokens of a byte-level tokenizer A and a sentence-piece model B.

    A reads a blank and the text, B the text. Gives the id, ``n_a`` and ``n_b``
    tokens, ``n_groups`` between common ends, ``n_links`` of overlapping tokens,
    ``n_best`` links whose pair is in most documents among those of its A id,
    ``count_sum`` of all links' document counts, and ``groups_sha256``, the digest
    of the groups' ids. Null and empty texts, and those that either tokenizer
    does not spell byte for byte, have zeros and an empty digest. Every row is
    a document: repeated rows and null ids stay and count. Other columns are
    ignored.
    """
    width = len(Pieces(path_b).labels)
    found = aligned(docs, path_a, path_b, doc_id, text).withColumn("_row", F.monotonically_increasing_id())
    rows = written(found, "aligned")
    counts = written(pair_counts(rows, width), "pair-shares")
    known = counts.orderBy(F.col("docs").desc(), "pair").limit(HEAD_PAIRS).toArrow().sort_by("pair")  # of fixed size
    head, head_docs, head_best = (known.column(c).to_numpy() for c in ("pair", "docs", "best"))
    head = np.append(head, np.iinfo(np.int64).max)
    kept = ["_row", "_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            sizes = batch.column("pairs").value_lengths().to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(head, pairs)
            hit = head[at] == pairs
            of, where, n = owner[hit], at[hit], times[hit]
            sums, best = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(sums, of, n * head_docs[where])
            np.add.at(best, of, n * head_best[where])
            rare = np.bincount(owner[~hit], minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(rare)]).astype(np.int32))
            out = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(best), pa.array(sums), *out],
                names=[*kept, "n_best", "count_sum", "pairs", "times"],
            )

    scored = rows.mapInArrow(run, f"{kinds}, n_best long, count_sum long, pairs array<long>, times array<long>")
    scored = written(scored, "aligned-head")
    rare = scored.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("_p")).select("_row", "_p.*")
    rest = rare.withColumnRenamed("pairs", "pair").join(counts, "pair").groupBy("_row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("docs")).alias("_sum")
    )
    joined = scored.drop("pairs", "times").join(rest, "_row", "left")
    return joined.select(
        F.col("_id").alias(doc_id),
        *("n_a", "n_b", "n_groups", "n_links"),
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
