"""Chat formatting by token-level assembly.

Every segment of a turn (its role's mark, a role without a mark of its own, its
text, its end) is encoded apart, and the marks are ids reserved above the
tokenizer's own, so no text can make one. Control strings inside texts are
escaped as well, so the formatted text can be read back as safely as the ids.
Lengths of segments, summed up, give the places where the loss mask begins and ends.

Turns are encoded where they lie. Then the ids of a conversation meet, are
put in order and joined to sequences; a very long conversation continues in
further parts, so none is ever held whole.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.aligning import ByteLevel
from freshet.llm.chunks import sliced

# The template. A mark opens a turn of its role; any other role
# is spelled out between the two marks for it. The escape sign goes before each control string.
MARKS = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
OTHER, BODY, END = "### Role: ", " ### Text: ", " </turn>\n"
ESCAPE = "\\"
LEARNED = "assistant"  # texts of this role carry the loss

CONTROL = [*MARKS.values(), OTHER, BODY, END]
# In a text a control string counts without its outer blanks too.
ESCAPED = re.compile("|".join(re.escape(c.strip()) for c in [ESCAPE, *CONTROL]))
PLAIN = re.compile(re.escape(ESCAPE) + "(.)", re.DOTALL)
SIGNS = re.compile("|".join([re.escape(ESCAPE) + "(?:.)", *map(re.escape, CONTROL)]), re.DOTALL)
PART_TOKENS = 1 << 18  # a longer conversation continues in another part
OUT_BYTES = 8 << 20
_CODERS: dict = {}


def escaped(text: str) -> str:
    """The text with the escape sign before each control string and escape sign."""
    return ESCAPED.sub(lambda m: ESCAPE + m.group(), text)


def unescaped(text: str) -> str:
    return PLAIN.sub(r"\1", text)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text, by its control strings alone."""
    roles = {m: r for r, m in MARKS.items()}
    turns, role, start = [], None, 0
    for sign in SIGNS.finditer(formatted):
        if sign.group() in roles:
            role, start = roles[sign.group()], sign.end()
        elif sign.group() == OTHER:
            start = sign.end()
        elif sign.group() == BODY:
            role, start = unescaped(formatted[start : sign.start()]), sign.end()
        elif sign.group() == END:
            turns.append((role, unescaped(formatted[start : sign.start()])))
    return turns


class Template:
    """Ids of turns, and turns of ids."""

    def __init__(self, path: str):
        self.coder = ByteLevel(path)
        self.first = len(self.coder.labels)
        self.ids = {c: self.first + i for i, c in enumerate(CONTROL)}
        self.roles = {self.ids[m]: r for r, m in MARKS.items()}
        self.labels = pa.array([*self.coder.labels, *(c.encode() for c in CONTROL)], pa.binary())
        self.kind = np.dtype("<u2" if len(self.labels) <= 1 << 16 else "<u4")

    def turn(self, role: str | None, text: str | None) -> tuple[bytes, int, int]:
        """The turn's ids, and where the loss begins and ends among them."""
        role, text = role or "", text or ""
        if role in MARKS:
            segments = [[self.ids[MARKS[role]]]]
        else:
            segments = [[self.ids[OTHER]], self.coder.encode(escaped(role)), [self.ids[BODY]]]
        segments += [self.coder.encode(escaped(text)), [self.ids[END]]]
        ends = np.cumsum([len(s) for s in segments])  # the mask begins and ends where the text does
        begin, end = (int(ends[-3]), int(ends[-2])) if role == LEARNED else (0, 0)
        return np.concatenate(segments).astype(self.kind).tobytes(), begin, end

    def text(self, ids: np.ndarray) -> str:
        """The formatted text."""
        letters = self.labels.take(pa.array(ids.astype(np.int64))).buffers()[2]
        return (letters or pa.py_buffer(b"")).to_pybytes().decode("utf-8", "replace")

    def read(self, ids: np.ndarray) -> tuple[str, str]:
        """Role and text of one turn's ids."""
        if ids[0] in self.roles:
            return self.roles[ids[0]], unescaped(self.text(ids[1:-1]))
        body = int(np.flatnonzero(ids == self.ids[BODY])[0])
        return unescaped(self.text(ids[1:body])), unescaped(self.text(ids[body + 1 : -1]))


def template(path: str) -> Template:
    """The template over a tokenizer file, made once per Python worker."""
    if path not in _CODERS:
        _CODERS[path] = Template(path)
        gc.collect()
        gc.freeze()
    return _CODERS[path]


def encoded(turns: DataFrame, tokenizer: str, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn's ids as bytes, where they lie, and the place of the loss in them."""
    names = {conv_id: "_conv", turn: "_turn", role: "_role", text: "_text"}
    rows = turns.select(*(F.col(c).alias(n) for c, n in names.items()))
    kinds = {n: rows.schema[n].dataType.simpleString() for n in rows.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = template(tokenizer)
        for batch in batches:
            at = 0
            made = (coder.turn(r.as_py(), t.as_py()) for r, t in zip(batch.column(2), batch.column(3), strict=True))
            for part in sliced(made, lambda x: len(x[0]), OUT_BYTES):
                ids, begin, end = zip(*part, strict=True)
                own = batch.slice(at, len(part))
                arrays = [own.column(0), own.column(1), own.column(2), pa.array(ids, pa.binary()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["_conv", "_turn", "_role", "ids", "loss_start", "loss_end"])
                at += len(part)

    return rows.mapInArrow(
        run, f"_conv {kinds['_conv']}, _turn {kinds['_turn']}, _role {kinds['_role']}, ids binary, loss_start long, loss_end long"
    )


def assembled(turns: DataFrame, tokenizer: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Sequences of whole turns: the conversation's id, ``part`` (0, or more for
    very long conversations), ``ids``, ``loss`` (one for each id) and ``turns``, their number.

    Turns go by ``turn``, nulls first; equal ones by role and ids, and repeated rows are
    repeated turns. A null role is an empty one, a null text is empty. Rows
    without a conversation id are one conversation. Other columns are ignored.
    """
    rows = encoded(turns, tokenizer, conv_id, turn, role, text)
    kind = rows.schema["_conv"].dataType.simpleString()
    inside = rows.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "ids")
    names = ["_conv", "part", "ids", "loss", "turns"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = template(tokenizer).kind
        here, part, pieces, masks, size, held = None, 0, [], [], 0, 0
        done: list[tuple] = []

        def close() -> None:
            ids = np.frombuffer(b"".join(pieces), kind).astype(np.int32)
            edges = np.zeros(len(ids) + 1, np.int8)  # +1 where the loss begins, -1 where it ends
            np.add.at(edges, [at for at, _ in masks], [change for _, change in masks])
            done.append((here[0], part, ids, np.cumsum(edges[:-1]).astype(bool), len(pieces)))

        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            conv, parts, ids, loss, turns = zip(*done, strict=True)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (ids, loss)]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(conv, batch.schema.field(0).type), pa.array(parts, pa.int64()), *lists, pa.array(turns, pa.int64())], names=names
            )

        last = None
        for batch in batches:
            last = batch
            for conv, ids, begin, end in zip(*(batch.column(i) for i in (0, 3, 4, 5)), strict=True):
                conv, ids, begin, end = (conv.as_py(),), ids.as_py(), begin.as_py(), end.as_py()
                if pieces and (conv != here or size >= PART_TOKENS):
                    close()
                    held += 5 * size
                    part, pieces, masks, size = (part + 1 if conv == here else 0), [], [], 0
                    if held >= OUT_BYTES:
                        yield out(batch)
                        held = 0
                here = conv
                pieces.append(ids)
                masks += [(size + begin, 1), (size + end, -1)]
                size += len(ids) // kind.itemsize
        if pieces:
            close()
        if done:
            yield out(last)

    made = inside.mapInArrow(run, f"_conv {kind}, part long, ids array<int>, loss array<boolean>, turns long")
    return made.withColumnRenamed("_conv", conv_id)


def read_back(sequences: DataFrame, tokenizer: str, conv_id: str = "conv_id", together: bool = False) -> DataFrame:
    """Digests of what the sequences hold: the conversation's id, ``n_turns``,
    ``turns_sha256`` of roles and texts, ``loss_chars`` and ``loss_sha256`` of all that the
    loss mask covers, without escapes, and ``formatted_chars``.

    The parts of a conversation are read one after the other; only digests are
    kept. ``together`` says that they lie so already, as they leave ``assembled``.
    """
    rows = sequences.select(F.col(conv_id).alias("_conv"), "part", "ids", "loss")
    kind = rows.schema["_conv"].dataType.simpleString()
    inside = rows if together else rows.repartition("_conv").sortWithinPartitions("_conv", "part")
    names = ["_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = template(tokenizer)
        end = coder.ids[END]
        here, told = None, None

        def result() -> tuple:
            n, said, chars, learned, formatted = told
            return here[0], n, said.hexdigest(), chars, learned.hexdigest(), formatted

        for batch in batches:
            done = []
            columns = [batch.column(i) for i in (0, 2, 3)]
            for at in range(len(batch)):
                conv = (columns[0][at].as_py(),)
                if conv != here:
                    if told:
                        done.append(result())
                    here, told = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids, loss = columns[1][at].values.to_numpy(), columns[2][at].values.to_numpy(zero_copy_only=False)
                start = 0
                for stop in (np.flatnonzero(ids == end) + 1).tolist():
                    own, covered = ids[start:stop], loss[start:stop]
                    role, text = coder.read(own)
                    learned = unescaped(coder.text(own[covered]))
                    told[0] += 1
                    told[1].update(f"{role}\n{text}\n".encode())
                    told[2] += len(learned)
                    told[3].update(learned.encode())
                    told[4] += len(coder.text(own))
                    start = stop
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types(batch), strict=True)], names=names)
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(result(), types(batch), strict=True)], names=names)

    def types(batch: pa.RecordBatch) -> list:
        return [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    made = inside.mapInArrow(
        run, f"_conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return made.withColumnRenamed("_conv", conv_id)
