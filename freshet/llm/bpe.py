"""Byte-pair encoding by a token automaton.

The automaton accepts exactly the token sequences that byte-pair encoding makes.
It starts as one state with a loop for every byte. A merge (u, v) -> w is worked
in by one gadget: the state after u is copied without its arc v, all arcs u lead
to the copy, and wherever u and then v could be read an arc w is added that leads
where v led. All arcs of one label lead to one state, so a state is written as
the label and the number of arcs it has lost, and its arcs need not be listed.

A word has one path through the automaton that spells it. The search goes
forward over a trie of the tokens, and the arcs met are kept in a table.
Decoding reads off the labels of the arcs.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.llm.chunks import LETTERS, ChunkCache, in_letters, sliced

OUT_BYTES = 8 << 20
# Fixed value: the word pattern of byte-level tokenizers.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Entries that one worker remembers.
CHUNKS, PLAIN_WORDS, OTHER_WORDS, TABLE_ENTRIES = 300_000, 800_000, 100_000, 500_000
_CODERS: dict = {}


class Automaton:
    """Which token may follow which, built from the merges in their order."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.born: dict[int, int] = {}  # the merge that made a token; 0 for single letters
        self.left: dict[int, int] = {}
        self.alias: dict[int, tuple[int, int]] = {}  # the state a token led to at first
        self.lost: dict[int, dict[int, int]] = {}  # by token, the arcs lost after it, numbered
        self.when: dict[int, list[int]] = {}  # and the merges by which they were lost
        self.table: dict[int, bool] = {}  # by the numbers of two tokens, whether the second may follow
        made = {u + v for u, v in merges}
        letters = [(s, i) for s, i in vocab.items() if len(s) == 1 and s not in made]
        self.born.update((i, 0) for _, i in letters)
        for number, (u, v) in enumerate(merges, 1):
            self.gadget(vocab[u], vocab[v], vocab[u + v], number)
        self.trie: dict = {}  # by letter the next node, by None the token that ends here
        self.whole = {s: i for s, i in vocab.items() if i in self.born}
        for s, i in self.whole.items():
            node = self.trie
            for letter in s:
                node = node.setdefault(letter, {})
            node[None] = i
        self.width = max(vocab.values()) + 1
        self.longest = max(map(len, self.whole))

    def gadget(self, u: int, v: int, w: int, number: int) -> None:
        if w in self.born:
            raise ValueError("two merges make the same token")
        if not self.allows(self.state(u), v):
            return  # u and v never meet
        after_v = self.state(v)
        self.lost.setdefault(u, {})[v] = len(self.when.setdefault(u, []))
        self.when[u].append(number)
        self.born[w], self.left[w], self.alias[w] = number, u, after_v

    def state(self, token: int) -> tuple[int, int]:
        return token, len(self.when.get(token, ()))

    def allows(self, state: tuple[int, int], token: int) -> bool:
        """Whether the state has an arc for the token."""
        label, losses = state
        while True:
            at = self.lost.get(label, {}).get(token)
            if at is not None and at < losses:
                return False
            number = self.born.get(token)
            if number is None:
                return False
            if number:
                before = bisect_right(self.when.get(label, ()), number, 0, losses)
                if before or label not in self.alias:  # the arc was added where its left part went out
                    token, losses = self.left[token], before
                    continue
            if label not in self.alias:
                return True
            label, losses = self.alias[label]

    def follows(self, before: int, token: int) -> bool:
        if len(self.table) >= TABLE_ENTRIES:
            self.table.clear()
        allowed = self.table[before * self.width + token] = self.allows(self.state(before), token)
        return allowed

    def encode(self, word: str) -> list[int]:
        """Tokens of one word in byte letters.

        Each beginning of the word has one path that spells it, so a position
        that was reached once need not be tried again. Longer arcs come first.
        """
        if not word:
            return []
        if word in self.whole:
            return [self.whole[word]]  # one arc spells it, so it is the only path
        known, width, n = self.table.get, self.width, len(word)
        path: list[int] = []
        reached, untried = set(), []
        end = 0
        while end < n:
            node, found, at = self.trie, [], end
            for letter in word[end : end + self.longest]:
                node = node.get(letter)
                if node is None:
                    break
                at += 1
                if None in node:
                    found.append((at, node[None]))
            untried.append(found)
            while True:
                while not untried[-1]:
                    untried.pop()
                    if not path:
                        raise ValueError("the word has letters that are not in the vocabulary")
                    path.pop()
                end, token = untried[-1].pop()
                if end in reached:
                    continue
                if path:
                    allowed = known(path[-1] * width + token)
                    if not (self.follows(path[-1], token) if allowed is None else allowed):
                        continue
                break
            path.append(token)
            reached.add(end)
        return path


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def content_of(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


class Encoder:
    """Ids of whole texts with a byte-level tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        content = content_of(path)
        model = content["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.special = {a["content"]: a["id"] for a in content["added_tokens"]}
        names = sorted(self.special, key=len, reverse=True)
        self.apart = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.presplit = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        step = content["pre_tokenizer"]
        known = step["type"] == "ByteLevel" and step["use_regex"] and not step["add_prefix_space"]
        self.pattern = regex.compile(WORDS) if known else None
        self.words = ChunkCache(lambda w: packed(self.automaton.encode(w)), OTHER_WORDS)
        self.plain = ChunkCache(lambda w: packed(self.automaton.encode(in_letters(w))), PLAIN_WORDS)
        self.chunks = ChunkCache(self.chunk, CHUNKS)

    def exact(self, text: str) -> bytes:
        """Ids of any text, without the cache of chunks.

        Texts of Latin-1 letters are cut into words here, others by the
        tokenizer's library, whose tables of letters may be of another age.
        """
        out = []
        for part in self.apart.split(text) if self.apart else [text]:
            if part in self.special:
                out.append(packed([self.special[part]]))
            elif self.pattern and (part.isascii() or max(part) < "\u0100"):
                out += self.plain.values(self.pattern.findall(part))
            elif part:
                out += self.words.values([w for w, _ in self.presplit(part)])
        return b"".join(out)

    def chunk(self, chunk: str) -> bytes | bool:
        """Ids of a chunk that stands behind a blank, or behind the line end it
        begins with; False if it can't be told from the chunk alone."""
        line = chunk[:1] == "\n"
        body = chunk[1:] if line else chunk
        if not body or body[0].isspace() or body[-1].isspace():
            return False
        return self.exact(chunk if line else " " + chunk)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian 32-bit integers.

        Between two characters that are not white space, one blank or one line
        end always begins a new word. So such texts are encoded chunk by chunk;
        texts with other white space between words are encoded whole.
        """
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        if first and not first[0].isspace() and not first[-1].isspace():
            values = self.chunks.values(rest)
            if False not in values:
                return self.exact(first) + b"".join(values)
        return self.exact(text)


class Decoder:
    """Texts of ids: the labels of their arcs, one after the other."""

    def __init__(self, path: str):
        content = content_of(path)
        vocab = content["model"]["vocab"]
        special = {a["content"]: a["id"] for a in content["added_tokens"]}
        letters = {c: b for b, c in LETTERS.items()}
        labels = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for s, i in vocab.items():
            labels[i] = bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode()
        for s, i in special.items():
            labels[i] = s.encode()
        self.labels = pa.array(labels, pa.large_binary())

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """A text for each list; the labels taken lie end to end already."""
        bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
        taken = pc.fill_null(self.labels.take(ids.flatten()), b"")
        ends = np.frombuffer(taken.buffers()[1], "<i8", len(taken) + 1)[bounds]
        texts = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends.tobytes()), taken.buffers()[2]])
        try:
            return texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # not UTF-8 throughout
            return pa.array([t.as_py().decode("utf-8", "replace") for t in texts], pa.large_string())


def kept(kind: type, path: str):
    """The coder of a path, made once per Python worker."""
    if (kind, path) not in _CODERS:
        _CODERS[kind, path] = kind(path)
        gc.collect()
        gc.freeze()  # later collections need not look at its tables
    return _CODERS[kind, path]


def replaced(df: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema.fields if f.name != column), T.StructField(column, kind)])


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document's id and ``ids``, the tokens of its whole text.

    ``tokenizer`` is the path of a byte-level tokenizer file; special tokens in
    a text are recognised as its library does. A null or empty text has no ids.
    Every row is encoded on its own, so repeated rows, ties and null ids keep
    their rows. Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(Encoder, tokenizer)
        for batch in batches:
            coded = (coder.encode(t.as_py()) for t in batch.column(1))
            at = 0
            for part in sliced(coded, len, OUT_BYTES):
                flat = pa.array(np.frombuffer(b"".join(part), "<i4"))
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in part])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), ids], names=schema.names)
                at += len(part)

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", doc_id)


def decode(coded: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text of the ids; no ids or null give an empty text.

    Bytes that are no UTF-8 become the replacement character, as in the
    tokenizer's library; a null element stands for no text.
    """
    schema = replaced(coded, out, T.StringType())
    rows = coded.drop(out)
    place = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(Decoder, tokenizer)
        for batch in batches:
            lists = batch.column(place)
            step = max(1, len(lists) * OUT_BYTES // max(1, 8 * len(lists.flatten())))
            for at in range(0, len(lists), step):
                part = batch.slice(at, step)
                texts = coder.decode(part.column(place)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    return rows.mapInArrow(run, schema)
