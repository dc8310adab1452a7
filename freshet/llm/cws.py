"""Document fingerprints by consistent weighted sampling.

For each sample and each term, draws from two gamma distributions and a uniform
one are made from a hash of term and sample. They turn the term's weight into a
level and a rank, and the term of least rank is the sample. Two documents have
the same sample with a chance equal to their generalised Jaccard similarity, the
sum of the smaller weights over the sum of the larger ones.

Everything is a DataFrame or SQL expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freshet.llm.graph import written

SAMPLES = 32
TOGETHER = 8  # samples that one row computes
BLOCK_DOCS = 500  # documents in one block of neighbours
LN_2 = math.log(2)
SPREAD = 2654435761  # an odd factor; levels stay below 2 ** 25
MOST_BLOCKS = 1 << 16  # beyond these blocks grow
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def weighted_terms(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the words of a text, A-Z lower-cased, as hashes with the places where
    their runs begin and end among all words in the order of their hashes."""
    lowered = f"translate({text}, '{UPPER}', '{LOWER}')"
    words = f"filter(split({lowered}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    begins = "filter(sequence(0, size(_h) - 1), i -> i = 0 OR get(_h, i) != get(_h, i - 1))"
    sorted_words = df.withColumn("_h", F.expr(f"sort_array(transform({words}, w -> xxhash64(w)))"))
    found = sorted_words.withColumn("_b", F.expr(f"CASE WHEN size(_h) = 0 THEN cast(array() AS array<int>) ELSE {begins} END"))
    runs = "cast(arrays_zip(array_distinct(_h), _b, array_append(slice(_b, 2, size(_b)), size(_h))) AS array<struct<term: bigint, start: int, stop: int>>)"
    zipped = found.withColumn(out, F.expr(f"CASE WHEN size(_h) > 0 THEN {runs} END"))
    return zipped.drop("_h", "_b")


def sample(number: int) -> str:
    """SQL for one sample of a row with ``term``, ``times`` and ``part``: the rank in
    the high 32 bits, and the sampled term and level, mixed, in the low ones."""
    first = f"xxhash64(xxhash64(term, part), {2 * number})"
    second = f"xxhash64(xxhash64(term, part), {2 * number + 1})"
    def number_of(bits: str) -> str:  # whole bits, as the middle of their interval
        return f"(({bits}) + 0.5D)"

    # Bits are numbers below 2 ** 21 or 2 ** 32; the logarithms of these factors are taken off at the end.
    r = f"({42 * LN_2!r}D - ln({number_of(f'{first} & 2097151L')} * {number_of(f'shiftrightunsigned({first}, 21) & 2097151L')}))"
    beta = f"({number_of(f'shiftrightunsigned({first}, 42) & 2097151L')} * {2.0**-21!r}D)"
    log_c = f"ln({64 * LN_2!r}D - ln({number_of(f'{second} & 4294967295L')} * {number_of(f'shiftrightunsigned({second}, 32)')}))"
    level = f"floor(ln(times) / {r} + {beta})"
    rank = f"({log_c} - {r} * ({level} - {beta}) - {r})"  # between -70 and 4
    return f"shiftleft(cast(({rank} + 128D) * 8388608D AS bigint), 32) | ((term ^ ({level} * {SPREAD}L)) & 4294967295L)"


def fingerprints(rows: DataFrame, keys: list[str], terms: str, keep: dict[str, Column] | None = None, samples: int = SAMPLES) -> DataFrame:
    """One row per key with ``fingerprint``: a hexadecimal number of eight digits for
    each sample, or an empty text for a document without terms.

    ``keep`` has further numbers of the key. A task reduces its documents' terms
    to the least ranks before anything is shuffled.
    """
    keep = keep or {}
    parts = -(-samples // TOGETHER)
    each = rows.select(*keys, *(c.alias(n) for n, c in keep.items()), F.inline_outer(terms))
    each = each.withColumn("times", F.col("stop") - F.col("start")).drop("start", "stop")
    each = each.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    names = [f"_s{i}" for i in range(TOGETHER)]
    ranked = each.select(*keys, *(F.when(F.col("part") == 0, F.col(n)).alias(n) for n in keep), "part", "term", *(F.expr(sample(i)).alias(n) for i, n in enumerate(names)))
    least = ranked.groupBy(*keys, "part").agg(F.count("term").alias("_terms"), *(F.min(n).alias(n) for n in names), *(F.max(n).alias(n) for n in keep))
    digits = F.concat(*(F.lower(F.lpad(F.hex(F.col(n).bitwiseAND(F.lit(4294967295))), 8, "0")) for n in names))
    text = least.select(*keys, *keep, F.struct("part", F.when(F.col("_terms") > 0, digits).otherwise("").alias("digits")).alias("piece"))
    joined = text.groupBy(*keys).agg(F.sort_array(F.collect_list("piece")).alias("pieces"), *(F.max(n).alias(n) for n in keep))
    whole = F.substring(F.array_join(F.transform("pieces", lambda p: p["digits"]), ""), 1, 8 * samples)
    return joined.select(*keys, *keep, whole.alias("fingerprint"))


def likeness(left: str, right: str, samples: int = SAMPLES) -> Column:
    """The share of samples that agree; 1 for two texts without terms, 0 if one has none."""
    same = f"size(filter(sequence(0, {samples - 1}), i -> substring({left}, 8 * i + 1, 8) = substring({right}, 8 * i + 1, 8)))"
    return F.expr(f"CASE WHEN {left} = '' OR {right} = '' THEN cast({left} = {right} AS double) ELSE {same} / {samples}D END")


def with_next(docs: DataFrame) -> DataFrame:
    """Documents (``block``, ``id``, ``text``, ``h``) with id, hash and text of the next one by
    falling id and hash; after the last comes the first. Rows that repeat are one.

    Documents are dealt to blocks of the id's range, the text moves once, and
    only the first document of each block is looked up for its neighbour.
    """
    spark = docs.sparkSession
    count = docs.filter("id IS NOT NULL").count()
    blocks = min(MOST_BLOCKS, max(1, -(-count // BLOCK_DOCS)))
    shares = [i / blocks for i in range(1, blocks)]
    bounds = []
    if shares:
        bounds = sorted(set(docs.agg(F.percentile_approx("id", shares, max(10_000, 20 * blocks)).alias("b")).first()["b"]))
    placed = docs.withColumn("block", block_of(bounds))
    firsts = placed.groupBy("block").agg(F.max(F.struct("id", "h")).alias("first")).collect()  # one row per block
    order = sorted(firsts, key=lambda r: r["block"])
    after = {r["block"]: order[(i + 1) % len(order)]["first"] for i, r in enumerate(order)}
    edges = spark.createDataFrame([(b, f["id"], f["h"]) for b, f in after.items()], "edge_block int, edge_id long, edge_h long")
    # The edges are one row per block, at most MOST_BLOCKS and one for null ids.
    same = placed["id"].eqNullSafe(edges["edge_id"]) & (placed["h"] == edges["edge_h"])
    texts = placed.join(F.broadcast(edges), same).groupBy("edge_block").agg(F.max("text").alias("edge_text"), F.max("edge_id").alias("edge_id"), F.max("edge_h").alias("edge_h"))
    window = Window.partitionBy("block").orderBy(F.desc_nulls_last("id"), F.desc("h"))
    repeated = F.lag("id").over(window).eqNullSafe(F.col("id")) & (F.lag("h").over(window) == F.col("h"))
    once = placed.withColumn("_again", F.coalesce(repeated, F.lit(False))).filter("NOT _again").drop("_again")
    led = once.withColumns({"next_id": F.lead("id").over(window), "next_h": F.lead("h").over(window), "next_text": F.lead("text").over(window)})
    joined = led.join(texts, led["block"] == texts["edge_block"], "left")
    last = F.col("next_h").isNull()
    return joined.select(
        "block",
        "id",
        "h",
        "text",
        F.when(last, F.col("edge_id")).otherwise(F.col("next_id")).alias("next_id"),
        F.when(last, F.col("edge_h")).otherwise(F.col("next_h")).alias("next_h"),
        F.when(last, F.col("edge_text")).otherwise(F.col("next_text")).alias("next_text"),
    )


def block_of(bounds: list[int]) -> Column:
    """How many bounds are above the id, by halving; null ids come behind all."""
    if not bounds:
        return F.expr("CASE WHEN id IS NULL THEN 1 ELSE 0 END")
    falling = ",".join(str(b) for b in sorted(bounds, reverse=True))
    array = f"cast(split('{falling}', ',') AS array<bigint>)"
    steps = ",".join(str(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1))
    above = f"aggregate(array({steps}), 0, (p, s) -> CASE WHEN p + s <= {len(bounds)} AND get({array}, p + s - 1) > id THEN p + s ELSE p END)"
    return F.expr(f"CASE WHEN id IS NULL THEN {len(bounds) + 1} ELSE {above} END")


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they are.

    The edit replaces the last half of the text's code points (rounded down) by
    the first as many, or all, of the next document's, by falling id; after the
    last comes the first. Returns the id, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    Terms are words between ASCII white space, A-Z lower-cased, weighted by their
    counts. A null or empty text, or one without words, has an empty
    fingerprint, which is like another empty one only. Documents of one id
    follow each other by a hash of their texts; rows that repeat id and text are
    one document and give one row. Null ids come last. A single document is its
    own next. Other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    pairs = with_next(base.withColumn("h", F.xxhash64("text")))
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) AS int))"), F.substring("next_text", F.lit(1), half))
    rows = pairs.withColumns({"edited": edited, "n_chars": chars.cast("long")})
    sha = F.sha2(F.col("edited").cast("binary"), 256)
    words = {f"sha{i}": F.expr(f"cast(conv(substring(_sha, {16 * i + 1}, 16), 16, -10) AS bigint)") for i in range(4)}
    rows = rows.withColumn("_sha", sha).withColumns(words).drop("_sha", "next_text")
    kinds = rows.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("kind"))
    kinds = kinds.withColumn("body", F.when(F.col("kind") == 0, F.col("text")).otherwise(F.col("edited"))).drop("text", "edited")
    numbers = ["n_chars", "next_id", "next_h", *words]
    keep = {n: F.when(F.col("kind") == 0, F.col(n)) for n in numbers}
    # Rows lie by block since their neighbours were found, so nothing below moves them again.
    marked = fingerprints(weighted_terms(kinds, "body", "terms"), ["block", "id", "h", "kind"], "terms", keep, samples)
    joined = marked.groupBy("block", "id", "h").agg(
        *(F.max(n).alias(n) for n in numbers),
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    falling = Window.partitionBy("block").orderBy(F.desc_nulls_last("id"), F.desc("h"))
    both = written(joined.withColumn("next_fingerprint", F.lead("fingerprint").over(falling)), "fingerprints")
    # The last document of a block is followed by the first of the next: one row per block, at most MOST_BLOCKS and one.
    lasts = both.filter("next_fingerprint IS NULL").select(F.col("block").alias("l_block"), F.col("next_id").alias("l_id"), F.col("next_h").alias("l_h"))
    firsts = both.join(F.broadcast(lasts), F.col("id").eqNullSafe(F.col("l_id")) & (F.col("h") == F.col("l_h")))
    edges = firsts.select("l_block", F.col("fingerprint").alias("edge_fingerprint"))
    met = both.join(F.broadcast(edges), both["block"] == edges["l_block"], "left")
    met = met.withColumn("next_fingerprint", F.coalesce("next_fingerprint", "edge_fingerprint"))
    hexed = F.concat(*(F.lower(F.lpad(F.hex(n), 16, "0")) for n in words))
    return met.select(
        F.col("id").alias(doc_id),
        "n_chars",
        hexed.alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"),
        likeness("fingerprint", "next_fingerprint", samples).alias("near_next"),
    )
