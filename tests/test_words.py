"""Running word counts in packed blocks."""

from collections import Counter

from freshet.operators.words import running_words
from freshet.plans.catalog import PLANS

TEXTS = [(5, "a b  a"), (2, None), (9, ""), (1, "é a\ta é"), (7, "a a a a"), (None, "b a"), (3, "b " * 40), (8, "a")]


def test_running_words_over_many_blocks(spark):
    df = spark.createDataFrame(TEXTS, "n int, text string")
    seen, want = Counter(), []
    for n, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        for position, word in enumerate(text.split(" ") if text is not None else []):
            seen[word] += 1
            want.append((n, position, word, seen[word]))
    for size in (4, 10_000):
        got = running_words(df, "n", "text", buckets=3, block_bytes=size)
        assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "string", "bigint"]
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_no_row_of_a_word_is_sorted_or_shuffled(spark):
    texts = spark.createDataFrame([(1, "a b a")], "offset long, text string")
    plan = PLANS["running_word_counts"].run(texts)._jdf.queryExecution().analyzed().toString()
    assert "Window" not in plan  # it was a window over all words
