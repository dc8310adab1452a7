"""Alignment of two tokenizers against plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from freshet.llm import aligning, queries
from freshet.session import ship_package

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    (1, "plain words, plain words"),
    (1, "plain words, plain words"),
    (None, "ünïcode — 漢字 🙂 <s>x</s> <0x41> <|endoftext|>"),
    (2, None),
    (3, ""),
    (4, "holds ▁ that B spells otherwise"),
    (5, " \n\t  two  blanks\r\n"),
    (6, " " * 5000 + "x"),
    (7, "plain " * 4000),
]


@given(st.lists(st.integers(1, 60), max_size=90), st.lists(st.integers(1, 60), max_size=90))
@settings(max_examples=200, deadline=None)
def test_gallop_counts_what_lies_below(short, long):
    short, long = (np.array(sorted(set(x)), np.int64) for x in (short, long))
    assert aligning.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.lists(st.integers(1, 5), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_overlaps_are_all_pairs_that_share_a_byte(one, two):
    gap = sum(one) - sum(two)
    one, two = one + [-gap] * (gap < 0), two + [gap] * (gap > 0)
    ends = [np.cumsum(x) for x in (one, two)]
    cut_a, cut_b, link_a, link_b = aligning.overlaps(*ends)
    starts = [e - x for e, x in zip(ends, (one, two), strict=True)]
    want = [
        (i, j)
        for i in range(len(one))
        for j in range(len(two))
        if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]
    ]
    assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want
    assert cut_a.tolist() == [e in ends[1] for e in ends[0]] and cut_b.tolist() == [e in ends[0] for e in ends[1]]


def plainly(texts):
    """The contract's rows by loops, with the tokenizers' own libraries."""
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: b for b, c in aligning.LETTERS.items()}
    names = {i: t for t, i in first.get_vocab().items()}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    found = []
    for i, text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        spelled = [[bytes(letters[c] for c in names[x]) for x in a], [bytes_b(x) for x in b]]
        if any(b"".join(s) != (" " + (text or "")).encode() for s in spelled):
            a, b, spelled = [], [], [[], []]
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, links, at, j, k = [], Counter(), 0, 0, 0
        for x, e in enumerate(ends[0]):
            s = e - len(spelled[0][x])
            while k < len(b) and ends[1][k] <= s:
                k += 1
            y = k
            while y < len(b) and ends[1][y] - len(spelled[1][y]) < e:
                links[a[x], b[y]] += 1
                y += 1
            if e in (here := set(ends[1][y - 1 : y])) and here:
                groups.append((a[at : x + 1], b[j:y]))
                at, j = x + 1, y
        found.append((i, a, b, groups, links))
    counts = Counter(p for *_, links in found for p in links)
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for i, a, b, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(n for p, n in links.items() if counts[p] == most[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        rows.append((i, len(a), len(b), len(groups), sum(links.values()), best, total, digest))
    return sorted(rows, key=str)


@pytest.mark.parametrize("known", [1 << 17, 5])
def test_alignment_against_loops(spark, monkeypatch, known):
    ship_package(spark)
    monkeypatch.setattr(aligning, "HEAD_PAIRS", known)  # with few pairs known, the others are joined
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, pairs string, _row long")
    got = aligning.align(docs.repartition(3), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plainly(TEXTS)
    assert aligning.align(docs.limit(0), A, B).isEmpty()


def test_query_against_loops(spark):
    folder = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.QUERIES["op11_alignment"](spark, folder).collect()
    assert sorted((tuple(r) for r in got), key=str) == plainly(texts)
