"""Every word of texts with its count so far.

A row per word through a shuffle and a sort is what takes the time of such counts.
Here the words of a block of texts are put into buckets by hash and travel as one
value for each block and bucket, an Arrow table of ordinal, position and word.

In a batch, blocks are ranges of the order. For each word the blocks leave one
number each, the words before a block are sums of these, and each block and bucket is
counted on its own, so no call grows with the number of a word's occurrences.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import shared_path

# The word functions travel to the executors by value, so the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD_BUCKETS = 256
BLOCK_BYTES = 16_000_000  # text of one block
NULL_FIRST = -(1 << 63)  # stands for an ordinal that is null


def to_bytes(made: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, made.schema) as writer:
        writer.write_table(made)
    return sink.getvalue().to_pybytes()


def from_bytes(values: list) -> pa.Table:
    """Tables of one schema as one, the words coded alike."""
    return pa.concat_tables([pa.ipc.open_stream(v).read_all() for v in values]).unify_dictionaries().combine_chunks()


def coded(made: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's word, and the words."""
    words = made["word"].chunk(0) if made["word"].num_chunks else made["word"].combine_chunks()
    return words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)


def by_bucket(table: pa.Table, buckets: int) -> Iterator[tuple[int, pa.Table, pa.Table]]:
    """The words of texts by bucket: bucket, all of them with ordinal and position, and how often each is there."""
    table = table.filter(pc.is_valid(table["text"])).combine_chunks()
    if not table.num_rows:
        return
    lists = pc.split_pattern(table["text"].combine_chunks(), " ")
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy()
    words = pc.list_flatten(lists).dictionary_encode()
    seq = np.repeat(table["seq"].to_numpy(), sizes)
    position = (np.arange(len(seq)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    code = words.indices.to_numpy()
    place = np.array([zlib.crc32(w) % buckets for w in words.dictionary.cast(pa.binary()).to_pylist()], np.uint16)
    own = place[code]
    order = np.argsort(own, kind="stable")
    ends = np.searchsorted(own[order], np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(ends)).tolist():
        rows = order[ends[bucket] : ends[bucket + 1]]
        known, inner, count = np.unique(code[rows], return_inverse=True, return_counts=True)
        names = words.dictionary.take(pa.array(known))
        all_words = pa.DictionaryArray.from_arrays(pa.array(inner.astype(np.int32)), names)
        yield bucket, pa.table({"seq": seq[rows], "position": position[rows], "word": all_words}), pa.table({"word": names, "n": count.astype(np.int64)})


def pieces(batch: pa.RecordBatch, limit: int) -> Iterator[pa.Table]:
    """A batch in runs of rows of bounded text."""
    table = pa.Table.from_batches([batch])
    ends = np.cumsum(pc.fill_null(pc.binary_length(table["text"]), 0).to_numpy())
    start = 0
    while start < table.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield table.slice(start, stop - start)
        start = stop


def counted(made: pa.Table, before: pd.Series) -> tuple[pa.Table, pd.Series]:
    """The words in order with their counts so far, and the counts after them; ``before`` holds those of earlier rows."""
    code, names = coded(made)
    seq, position = made["seq"].to_numpy(), made["position"].to_numpy()
    order = np.lexsort((position, seq, code))
    sizes = np.bincount(code, minlength=len(names))
    at = before.index.get_indexer(pd.Index(names, dtype=object))
    begun = np.append(before.to_numpy(np.int64), 0)[at]
    count = np.arange(1, len(code) + 1) - np.repeat(np.cumsum(sizes) - sizes - begun, sizes)
    out = made.take(pa.array(order)).append_column("count", pa.array(count.astype(np.int64)))
    return out, pd.Series(begun + sizes, index=pd.Index(names, dtype=object))


def rows_of(made: pa.Table, seq: str) -> Iterator[pa.RecordBatch]:
    plain = made.set_column(2, "word", made["word"].cast(pa.string())).rename_columns([seq, "position", "word", "count"])
    yield from plain.to_batches(max_chunksize=100_000)


def texts_of(df: DataFrame, seq: str, text: str) -> DataFrame:
    return df.select(F.coalesce(F.col(seq).cast("long"), F.lit(NULL_FIRST)).alias("seq"), F.col(text).alias("text"))


def ordinals(made: DataFrame, df: DataFrame, seq: str) -> DataFrame:
    """The ordinals as they came."""
    return made.withColumn(seq, F.nullif(F.col(seq), F.lit(NULL_FIRST)).cast(df.schema[seq].dataType))


def running_words(df: DataFrame, seq: str, text: str, buckets: int = WORD_BUCKETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per word of the texts, split on single spaces: ``seq``, its position, the word and its count so far.

    Counts go by ``seq`` and position. Runs jobs: the texts are dealt to blocks, whose packed
    words go to the shared folder.
    """
    rows = texts_of(df, seq, text)
    blocks = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found)
        block = table["block"][0].as_py() if table.num_rows else 0
        for bucket, words, sums in by_bucket(table, buckets):
            one = {"block": [block], "bucket": [bucket], "words": [to_bytes(words)], "sums": [to_bytes(sums)]}
            yield pa.RecordBatch.from_pydict(one, schema=pa.schema({"block": pa.int64(), "bucket": pa.int32(), "words": pa.binary(), "sums": pa.binary()}))

    dealt = rows.repartitionByRange(blocks, "seq").withColumn("block", F.spark_partition_id().cast("long"))
    path = shared_path(df.sparkSession, "words")
    dealt.mapInArrow(pack, "block long, bucket int, words binary, sums binary").write.parquet(path)
    packed = df.sparkSession.read.parquet(path)

    def earlier(key, table):
        known, out = pd.Series([], index=pd.Index([], dtype=object), dtype="int64"), []
        table = table.sort_by("block")
        sums = [pa.ipc.open_stream(v.as_py()).read_all() for v in table["sums"]]
        names, ends = pa.concat_arrays([c for s in sums for c in s["word"].chunks]).dictionary_encode(), np.cumsum([s.num_rows for s in sums])
        code, n = names.indices.to_numpy(), np.concatenate([s["n"].to_numpy() for s in sums])
        total = np.zeros(len(names.dictionary), np.int64)
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            own = code[start:end]  # a block holds a word once
            seen = own[total[own] > 0]
            out.append(to_bytes(pa.table({"word": names.dictionary.take(pa.array(seen)), "n": total[seen]})))
            total[own] += n[start:end]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "before": pa.array(out, pa.binary())})

    sums = packed.select("block", "bucket", "sums")
    before = sums.groupBy("bucket").applyInArrow(earlier, "block long, bucket int, before binary")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, known in zip(batch["words"], batch["before"], strict=True):
                old = pa.ipc.open_stream(known.as_py()).read_all()
                held = pd.Series(old["n"].to_numpy(), index=pd.Index(old["word"].to_numpy(), dtype=object))
                yield from rows_of(counted(from_bytes([words.as_py()]), held)[0], seq)

    both = packed.select("block", "bucket", "words").join(before, ["block", "bucket"])
    return ordinals(both.mapInArrow(count, f"`{seq}` long, position int, word string, count long"), df, seq)
