"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as
many of the longest as fit, then the binary digits of the rest. Each piece is a
sequence of its own and goes to the bucket of its length. So no sequence holds
tokens of two documents and none needs padding.
"""

from __future__ import annotations

import gc
import json
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import ChunkCache, in_letters, sliced

LONGEST = 2048
OUT_BYTES = 8 << 20  # ids in one Arrow batch that goes back to Spark
_ENCODERS: dict[str, Encoder] = {}


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to n, in falling order, none above ``longest``."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Encoder:
    """Ids of texts by a tokenizer that drops white space and then looks at one word at a time.

    Such texts can be encoded chunk by chunk between ASCII white space. Chunks of
    Latin-1 letters are cut into words here, by the tokenizer's own pattern, and
    only unseen words reach its model; all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.pattern = regex.compile(plain_pattern(content)) if plain_pattern(content) else None
        self.special = [a["content"] for a in content["added_tokens"]]
        model = tokenizer.model
        self.whole = ChunkCache(lambda c: packed([tokenizer.encode(c.decode(), add_special_tokens=False).ids]))
        self.words = ChunkCache(lambda w: packed([[t.id for t in model.tokenize(in_letters(w))]]))
        self.chunks = ChunkCache(lambda c: b"".join(self.words.values(self.pattern.findall(c.decode("latin-1")))))

    def encode(self, text: bytes | None) -> bytes:
        """Ids as little-endian 32-bit integers; none for a null or empty text."""
        if not text:
            return b""
        if self.pattern:
            try:
                letters = text.decode()
                plain = letters.lower().encode("latin-1")  # normal form C, and lower case letter by letter
            except UnicodeEncodeError:
                plain = None
            if plain is not None and not any(s in letters for s in self.special):
                return b"".join(self.chunks.values(plain.split()))
        return b"".join(self.whole.values(text.split()))


def packed(ids: list[list[int]]) -> bytes:
    return b"".join(struct.pack(f"<{len(i)}I", *i) for i in ids)


def plain_pattern(content: dict) -> str | None:
    """The word pattern of a tokenizer file that composes, lowers and splits as
    this module can; None for any other."""
    steps = (content["normalizer"] or {}).get("normalizers", [])
    kinds = [s["type"] for s in steps]
    pieces = (content["pre_tokenizer"] or {}).get("pretokenizers", [])
    if kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pieces] != ["Split", "ByteLevel"]:
        return None
    split, letters = pieces
    if steps[1]["content"] != " " or steps[1]["pattern"] != {"Regex": "\\s+"} or letters["use_regex"]:
        return None
    if (split["behavior"], split["invert"], letters["add_prefix_space"]) != ("Removed", True, False):
        return None
    return split["pattern"].get("Regex")


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
        gc.collect()
        gc.freeze()  # later collections need not look at its tables
    return _ENCODERS[path]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    longest: int = LONGEST,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents, each a whole sequence.

    Columns: the document's id, ``start`` (its ids before the piece), ``length``,
    ``bucket`` (log2 of the length), ``ids`` (little-endian unsigned 32-bit
    integers), ``doc_tokens``, ``sequence_id`` and ``offset`` (always 0).
    ``tokenizer`` is the path of a tokenizer file that drops white space; every
    document ends with ``end_id``. There is no shuffle: a task numbers its own
    sequences, and its number is part of ``sequence_id``.

    A null or empty text is the end id alone. Repeated rows and rows with a null
    or repeated id are packed each on its own. Other columns are ignored. An
    empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField(doc_id, kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "bucket")]
        + [T.StructField("ids", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset")]
    )
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            names = batch.column(0)
            coded = ((i, coder.encode(t.as_py()) + end) for i, t in enumerate(batch.column(1)))
            for part in sliced(coded, lambda row: len(row[1]), OUT_BYTES):
                owner, start, length, ids, total = [], [], [], [], []
                for i, coded_text in part:
                    tokens, at = len(coded_text) // 4, 0
                    for n in lengths(tokens, longest):
                        owner.append(i)
                        start.append(at)
                        length.append(n)
                        ids.append(coded_text[4 * at : 4 * (at + n)])
                        total.append(tokens)
                        at += n
                count = len(owner)
                numbers = pa.array(range(number, number + count), pa.int64())
                number += count
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(owner, pa.int32())),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([n.bit_length() - 1 for n in length], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(total, pa.int64()),
                        numbers,
                        pa.array([0] * count, pa.int64()),
                    ],
                    names=schema.names,
                )

    return rows.mapInArrow(pieces, schema)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Writes the sequences to one folder per length, for batches of equal lengths."""
    packed.write.mode("errorifexists").partitionBy("bucket").parquet(path)
