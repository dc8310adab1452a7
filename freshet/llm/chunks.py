"""Encoding texts chunk by chunk through a bounded cache."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterator

CACHE_ENTRIES = 700_000  # chunks remembered by one Python worker
LONGEST_KEY = 64  # longer chunks are encoded each time
_CACHES: weakref.WeakSet = weakref.WeakSet()  # of this Python worker


class ChunkCache:
    """Values of chunks, computed when first seen; none of them may be None.

    Two dictionaries take turns: when the newer one is full, the older one is
    given up. So memory does not follow the corpus and frequent chunks stay.
    """

    def __init__(self, compute: Callable, entries: int = CACHE_ENTRIES):
        self.compute, self.entries = compute, entries // 2
        self.known, self.older = {}, {}
        _CACHES.add(self)

    def value(self, chunk):
        found = self.known.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            if found is None:
                found = self.compute(chunk)
            if len(chunk) <= LONGEST_KEY:
                if len(self.known) >= self.entries:
                    self.known, self.older = {}, self.known
                self.known[chunk] = found
        return found

    def values(self, chunks: list) -> list:
        found = list(map(self.known.get, chunks))
        if None in found:
            found = [self.value(c) if v is None else v for c, v in zip(chunks, found, strict=True)]
        return found


def forget() -> None:
    """Gives up the chunks that operators remember in this worker.

    Workers outlive the operators they served, so tasks of operators that
    remember nothing call this first; their memory would come on top.
    """
    for cache in _CACHES:
        cache.known, cache.older = {}, {}


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others are numbered from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


def in_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(LETTERS)


def sliced(rows: Iterator, size: Callable, limit: int) -> Iterator[list]:
    """Rows in lists whose sizes add up to ``limit`` or a little more."""
    taken, total = [], 0
    for row in rows:
        taken.append(row)
        total += size(row)
        if total >= limit:
            yield taken
            taken, total = [], 0
    if taken:
        yield taken


def unused(columns: list[str], name: str) -> str:
    """The name, or one made of it, that is none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
