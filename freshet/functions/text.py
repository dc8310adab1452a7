"""Text labelling and tokens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.rules import label
from freshet.functions.scalars import as_column

KNOWN_WORDS = 200_000  # scored words that may be sent to all tasks


def contains_any(lowered: Column, words: Sequence[str]) -> Column:
    """Whether a lower-case text holds one of the words anywhere in it."""
    return reduce(or_, (lowered.contains(w.lower()) for w in words))


def keyword_label(
    df: DataFrame, text: str, lists: Sequence[tuple[str, Sequence[str]]], out: str, default: str
) -> DataFrame:
    """Labels a text by the first list with a word in it.

    The text is put in lower case once, in a column of its own.
    """
    lowered = df.withColumn("_lowered", F.lower(text))
    rules = [(contains_any(F.col("_lowered"), words), name) for name, words in lists]
    return lowered.withColumn(out, label(rules, default)).drop("_lowered")


def tokens(df: DataFrame, text: str, out: str = "word", position: str | None = None) -> DataFrame:
    """One row per token of the text, split on single spaces."""
    parts = F.split(F.col(text), " ", -1)
    if position is None:
        return df.withColumn(out, F.explode(parts))
    return df.select("*", F.posexplode(parts).alias(position, out))


def lexicon_label(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    out: str = "sentiment",
    high: float = 0.1,
    low: float = -0.1,
) -> DataFrame:
    """Mean lexicon score per text, then POSITIVE, NEGATIVE or NEUTRAL.

    ``lexicon`` has columns word and score, one row per word in either case.
    A list of at most ``KNOWN_WORDS`` is counted and sent to all tasks, so no word is
    shuffled, and the scores of a text are added up in its task; a longer list
    is joined. Means are rounded to
    twelve decimals, so that the order of adding decides no label. Texts without a
    scored word are neutral.
    """
    words = df.select(key, F.explode(F.split(F.lower(text), " ", -1)).alias("word"))
    scores = lexicon.select(F.lower("word").alias("word"), F.col("score").cast("double").alias("score"))
    if lexicon.limit(KNOWN_WORDS + 1).count() <= KNOWN_WORDS:
        scores = F.broadcast(scores)
    found = words.join(scores, "word").select(key, "score")
    every = df.select(key, F.lit(None).cast("double").alias("score"))
    means = every.union(found).groupBy(key).agg(F.round(F.avg("score"), 12).alias("polarity"))
    return means.withColumn(out, polarity_label("polarity", high, low))


def polarity_label(polarity: str, high: float = 0.1, low: float = -0.1) -> Column:
    score = F.col(polarity)
    return label([(score > high, "POSITIVE"), (score < low, "NEGATIVE")], "NEUTRAL")


def polarity(text: str | Column, lexicon: Mapping[str, float]) -> Column:
    """Mean lexicon score of each text, null without a scored word.

    For streams, where a grouping per text would need state, and for word lists
    small enough to be part of the plan.
    """
    scores = {w.lower(): float(s) for w, s in lexicon.items()}
    if not scores:
        return F.lit(None).cast("double")
    known = F.create_map(*(F.lit(v) for pair in scores.items() for v in pair))
    words = F.split(F.lower(as_column(text)), " ", -1)
    found = F.filter(F.transform(words, lambda w: F.try_element_at(known, w)), lambda s: s.isNotNull())
    total = F.aggregate(found, F.lit(0.0), lambda a, s: a + s)
    return F.when(F.size(found) > 0, total / F.size(found))
