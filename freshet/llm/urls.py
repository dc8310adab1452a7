"""URL filters by a cascade of Bloom filters.

The first filter holds the listed keys. Over the complete set of keys that the
corpus has, some keys that are not listed pass it by chance; the second filter
holds those. The third holds the listed keys that pass the second, and so on
until no key of either kind is left over. For every key of the corpus the level
at which it first fails then tells exactly whether it is listed, and rows are
judged without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import shared_path

FIRST_BITS = 32  # bits per listed key in the first filter
LATER_BITS = 16  # and per key in the later ones
MOST_BITS = 1 << 26  # of one filter, 8 MiB; more listed keys than that allows are an error
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host and the beginning of a path, such as ``net/``, and what it says."""

    text: str
    verdict: str

    @property
    def labels(self) -> int:
        return self.text.partition("/")[0].count(".") + 1

    @property
    def path(self) -> str:
        return self.text[len(self.text.partition("/")[0]) :]


def host_of(url: str | Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: str, path: str, rules: Iterable[Rule]) -> Column:
    """All keys of a url that a rule could have, the longest first.

    A key is the last labels of the host and the beginning of the path. Only as
    many labels and such lengths as the rules have are tried, so the number of
    keys follows the rules and not the url.
    """
    shapes = sorted({(r.labels, len(r.path)) for r in rules})
    keys = [
        f"CASE WHEN size(split({host}, '[.]')) >= {labels} AND char_length({path}) >= {length} "
        f"THEN concat(substring_index({host}, '.', -{labels}), substring({path}, 1, {length})) END"
        for labels, length in shapes
    ]
    found = f"array_compact(array({', '.join(keys)}))" if keys else "cast(array() AS array<string>)"
    return F.expr(f"transform(array_sort(transform({found}, k -> struct(-length(k) AS n, k AS k))), s -> s.k)")


@dataclass(frozen=True)
class Bloom:
    """Bits as 32-bit words, and how many of them a key sets."""

    words: tuple[int, ...]
    hashes: int
    level: int

    def may_have(self, key: str) -> str:
        """SQL for whether all bits of a key are set; the words are folded to one constant."""
        words = f"cast(split('{','.join(map(str, self.words))}', ',') AS array<bigint>)"
        bit = place(key, len(self.words) * 32, self.level)
        return f"forall(sequence(0, {self.hashes - 1}), i -> (get({words}, cast({bit} div 32 AS int)) & shiftleft(1L, cast({bit} % 32 AS int))) != 0)"


def place(key: str, bits: int, level: int) -> str:
    """SQL for the i-th bit of a key; each level has hash functions of its own."""
    return f"((pmod(xxhash64({key}, {2 * level}), {bits}L) + i * pmod(xxhash64({key}, {2 * level + 1}), {bits}L)) % {bits}L)"


def built(keys: DataFrame, count: int, per_key: int, level: int) -> Bloom:
    """A filter of ``count`` distinct keys; the words are gathered, at most ``MOST_BITS`` bits."""
    bits = max(64, 1 << math.ceil(math.log2(count * per_key)))
    if bits > MOST_BITS:
        raise ValueError(f"{count} keys do not fit a filter of {MOST_BITS} bits")
    hashes = max(1, min(20, round(0.69 * bits / count)))
    bit = keys.select(F.explode(F.expr(f"transform(sequence(0, {hashes - 1}), i -> {place('key', bits, level)})")).alias("bit"))
    words = bit.groupBy(F.expr("cast(bit div 32 AS int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 AS int)))").alias("set"))
    filled = {r["word"]: r["set"] for r in words.collect()}
    return Bloom(tuple(filled.get(w, 0) for w in range(bits // 32)), hashes, level)


class Cascade:
    """Exact membership in a list for all keys of a universe."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def listed(self, key: str) -> str:
        """SQL for whether the key is listed: true if the first filter it fails is at an odd level."""
        tests = [f"WHEN NOT {filter_.may_have(key)} THEN {depth % 2 == 1}" for depth, filter_ in enumerate(self.levels)]
        last = f"{len(self.levels) % 2 == 1}"
        return f"CASE {' '.join(tests)} ELSE {last} END" if tests else last


def cascade(
    spark: SparkSession, listed: list[str], universe: DataFrame, first_bits: int = FIRST_BITS, later_bits: int = LATER_BITS
) -> Cascade:
    """The cascade of a list over the ``key`` column of ``universe``.

    Keys that pass the first filter by chance are written to the shared folder;
    later levels work on those and on the list alone.
    """
    names = sorted(set(listed))
    if not names:
        return Cascade([])
    inside = spark.createDataFrame([(n,) for n in names], "key string")
    levels = [built(inside, len(names), first_bits, 0)]
    passing = universe.select("key").filter(F.col("key").isNotNull() & F.expr(levels[0].may_have("key")))
    path = shared_path(spark, "cascade")
    passing.distinct().join(F.broadcast(inside), "key", "left_anti").write.parquet(path)
    sides = [inside, spark.read.parquet(path)]
    while True:
        depth = len(levels)
        rest = sides[depth % 2]
        for level in range(1 - depth % 2, depth, 2):  # filters that hold the other side
            rest = rest.filter(levels[level].may_have("key"))
        count = rest.count()
        if not count:
            return Cascade(levels)
        levels.append(built(rest, count, later_bits, depth))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", otherwise: str = "allow", **bits: int) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains, if the path of the url starts with
    the rule's path. The longest fitting rule gives the verdict (the first in
    the alphabet if two are equally long); without one, ``rule`` is null and the
    verdict is ``otherwise``: keys that are in no list are let through. Verdicts
    are plain words.

    A null url, or one without ``://``, has an empty host and path. Rows are
    judged one by one, so repeated rows and ties keep theirs. Columns with the
    names of the results are replaced. Two rules of one text must agree.
    """
    by_verdict: dict[str, list[str]] = {}
    for rule in rules:
        by_verdict.setdefault(rule.verdict, []).append(rule.text)
    if len({r.text for r in rules}) < len({(r.text, r.verdict) for r in rules}):
        raise ValueError("two rules of one text disagree")
    split = pages.drop("rule", "verdict").withColumns({"host": host_of(url), "path": path_of(url)})
    keyed = split.withColumn("_keys", candidate_keys("host", "path", rules))
    universe = keyed.select(F.explode("_keys").alias("key"))
    cascades = {v: cascade(pages.sparkSession, texts, universe, **bits) for v, texts in by_verdict.items()}

    said = " ".join(f"WHEN {filters.listed('k')} THEN '{verdict}'" for verdict, filters in cascades.items())
    told = f"transform(_keys, k -> struct(k AS rule, {f'CASE {said} END' if said else 'cast(NULL AS string)'} AS verdict))"
    first = F.expr(f"get(filter({told}, t -> t.verdict IS NOT NULL), 0)")
    judged = keyed.withColumn("_first", first)
    return judged.select(
        *split.columns,
        F.col("_first.rule").alias("rule"),
        F.coalesce(F.col("_first.verdict"), F.lit(otherwise)).alias("verdict"),
    )
