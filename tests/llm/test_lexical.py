"""Ranked lexical search against SQL and plain loops."""

import math
from collections import Counter

import numpy as np
import oracle
import pytest

from freshet.llm import lexical, queries
from freshet.session import ship_package

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    got = queries.QUERIES["op13_dual_tree"](spark, SF)
    assert oracle.difference(oracle.connect(SF), got, queries.ORACLE["op13_dual_tree"]) is None


def plainly(docs, items, k):
    texts = [(i, Counter(lexical.terms(t))) for i, t in docs]
    n, words = sum(1 for _, c in texts if c), sum(c.total() for _, c in texts)
    holding = Counter(t for _, c in texts for t in c)
    rows = []
    for item, text in items:
        found = []
        for i, c in texts:
            m = 25 + 75 * c.total() * n // max(words, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in lexical.terms(text)
                if c[t]
            )
            if score:
                found.append((-score, i is None, i or 0))
        rows += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(rows, key=str)


@pytest.mark.parametrize("chars", [200_000, 40])
def test_search_against_loops(spark, monkeypatch, chars):
    ship_package(spark)
    monkeypatch.setattr(lexical, "BLOCK_CHARS", chars)  # small blocks take several passes
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)] + ["É", "漢字", "Zu"]
    docs = [(i, " ".join(draw.choice(words, draw.integers(1, 30)))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in (400, 401, 401, None)] + [(500, None), (501, ""), (502, "!? ..."), (503, "w1 " * 40_000)]
    items = [(i, " ".join(draw.choice(words, 5))) for i in range(12)] + [(20, None), (21, ""), (22, "absent"), (None, "w1 w1"), (23, docs[7][1])]
    left = spark.createDataFrame([(i, t, 1, 1) for i, t in docs], "doc_id long, text string, score int, item long").repartition(3)
    right = spark.createDataFrame([(i, t, "x") for i, t in items] + [(0, items[0][1], "y")], "item_id long, text string, id string")
    got = lexical.search(left, right, k=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plainly(docs, items, 4)
    assert lexical.search(left.limit(0), right).isEmpty() and lexical.search(left, right.limit(0)).isEmpty()


def test_whole_batches_are_pruned():
    draw = np.random.default_rng(1)
    items = [(np.array([8 * i, 8 * i + 1]), np.array([50, 70])) for i in range(16)]
    search = lexical.Search(items, 128, 2)

    def batch(base, low, high):
        sizes = np.full(256, 2)
        columns = np.repeat(np.arange(256) % 16 * 8, 2) + np.tile([0, 1], 256)
        return [base + i for i in range(256)], sizes, columns, draw.integers(low, high, 512)

    search.add(*batch(0, 900, 1000))
    before = search.scored
    search.add(*batch(1000, 1, 100))
    assert search.scored == before  # none of its nodes reached a kth best score
    assert before < 16 * 8  # and not all leaves of the first did
