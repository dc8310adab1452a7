"""The parts of the operators that need no Spark, against libraries and brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from freshet.llm import ann, blobs, bpe, lbl, neardup, packing, quality, warc

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXT = st.text(st.sampled_from(list("abceéñ  \n\t'’sStTIİſKΣς\x1c\x85\xa0　́ﬁ12²!#&日🙂\r<|>")), max_size=40)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(WORDS)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.booleans())
def test_automaton_encodes_as_the_library(byte_tokenizer, text, special):
    text += "<|endoftext|> x" if special else ""
    ids = np.frombuffer(bpe.kept(bpe.Encoder, BYTES).encode(text), "<i4").tolist()
    assert ids == byte_tokenizer.encode(text, add_special_tokens=False).ids
    decoded = bpe.kept(bpe.Decoder, BYTES).decode(pa.array([ids], pa.list_(pa.int32())))
    assert decoded.to_pylist() == [byte_tokenizer.decode(ids, skip_special_tokens=False)]


def test_automaton_on_long_runs(byte_tokenizer):
    for text in ("a" * 5000, "-" * 3001, " " * 500, "ab" * 2000, "é" * 999):
        ids = np.frombuffer(bpe.kept(bpe.Encoder, BYTES).encode(text), "<i4").tolist()
        assert ids == byte_tokenizer.encode(text, add_special_tokens=False).ids


def test_automaton_accepts_what_merging_makes():
    """All strings over a small alphabet against merging by hand."""
    merges = [("a", "b"), ("b", "c"), ("a", "a"), ("ab", "c"), ("aa", "ab"), ("c", "c"), ("bc", "a")]
    names = ["a", "b", "c", *("".join(m) for m in merges)]
    vocab = {n: i for i, n in enumerate(names)}
    automaton = bpe.Automaton(vocab, merges)
    for number in range(3**7):
        word = "".join("abc"[number // 3**k % 3] for k in range(7))
        parts = list(word)
        for u, v in merges:
            at = 0
            while at < len(parts) - 1:
                if (parts[at], parts[at + 1]) == (u, v):
                    parts[at : at + 2] = [u + v]
                at += 1
        assert [names[i] for i in automaton.encode(word)] == parts


@settings(max_examples=300, deadline=None)
@given(TEXT, st.booleans())
def test_chunks_encode_as_the_whole(word_tokenizer, text, special):
    text += "x<|endoftext|>y" if special else ""
    ids = np.frombuffer(packing.encoder(WORDS).encode(text.encode()), "<u4").tolist()
    assert ids == word_tokenizer.encode(text, add_special_tokens=False).ids


@given(st.integers(0, 100_000))
def test_lengths_are_powers_of_two(n):
    found = packing.lengths(n)
    assert sum(found) == n and found == sorted(found, reverse=True) and max(found, default=1) <= 2048
    assert all(k & (k - 1) == 0 for k in found) and len([k for k in found if k < 2048]) == len({k for k in found if k < 2048})


def test_findings_and_redaction():
    text = 'é PassWord = "abc" api_key:xyz123 AKIA' + "A1" * 9 + " " + "0f" * 12 + " token=short toKen: " + "a" * 24
    found = blobs.findings(text)
    assert [(k, text[a:b]) for k, a, b in found] == [
        ("assign", "api_key:xyz123"),
        ("access", "AKIA" + "A1" * 9),
        ("hex", "0f" * 12),
        ("assign", "toKen: " + "a" * 24),
        ("hex", "a" * 24),
    ]
    assert blobs.redact("0123456789", [(2, 4), (3, 6), (8, 9)], "#") == "01#67#9"
    assert blobs.findings("ſecret=abcdefgh") == []  # letters of either case are ASCII


def test_shingle_sets_and_registers():
    assert len(neardup.shingles(b"a b c", 4)) == 1 and not len(neardup.shingles(b" \t", 4)) and not len(neardup.shingles(None, 4))
    assert len(neardup.shingles(b"a b c d e d e d e", 2)) == 5
    assert np.array_equal(neardup.shingles(b"A b\x0bC d", 4), neardup.shingles(b"a B c D", 4))
    draw = np.random.default_rng(0)
    for share, n in ((0.8, 2000), (0.9, 300), (0.8, 40)):
        errors = []
        for _ in range(30):
            both = round(n * 2 * share / (1 + share))
            a, b = (np.unique(np.r_[k, draw.integers(0, 2**63, n - both).astype(np.uint64) * np.uint64(2)]) for k in [draw.integers(0, 2**63, both).astype(np.uint64) * np.uint64(2)] * 2)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            (ra, fa), (rb, fb) = neardup.registers(a), neardup.registers(b)
            guess, least = neardup.estimates(rb[None], np.array([fb]), ra, fa, 0.8)
            errors.append(guess[0] - true)
            assert guess[0] >= least[0] or true < 0.8
        assert abs(np.mean(errors)) < 0.03


def test_terms_of_style():
    assert not len(quality.terms(None)[0]) and not len(quality.terms(b"")[0])
    numbers, counts = quality.terms(b"se se se se")
    assert counts[numbers == quality.TERMS - 1] == 3 * quality.REPEAT_WEIGHT


def test_hadamard_keeps_lengths_and_tables_are_right():
    rows = np.random.default_rng(1).standard_normal((5, 16))
    matrix = np.array([[(-1) ** bin(i & j).count("1") for j in range(16)] for i in range(16)]) / 4
    assert np.allclose(ann.hadamard(rows), rows @ matrix)
    near = ann.axes(ann.unit(rows), 3, 4)
    assert near.shape == (3, 5, 4)
    turned = ann.rotated(ann.unit(rows), ann.signs(16, 3, ann.SEED)[0])
    assert np.array_equal(near[0][:, 0], np.argmax(np.concatenate([turned, -turned], 1), 1))


def test_normalisers_sum_to_one():
    draw = np.random.default_rng(2)
    size, d = 40, lbl.DIMENSIONS
    model = lbl.Model(*(draw.standard_normal(s).astype(np.float32) * 0.3 for s in ((size, d), (size, d), (d, d), (d, d), (size,))))
    tables = lbl.Tables(model)
    for far, near in ((0, 0), (3, 17), (39, 1)):
        whole = np.exp(tables.log_probability(np.full(size, far), np.full(size, near), np.arange(size))).sum()
        assert abs(whole - 1) < 1e-4


def test_chunks_carry_running_digests():
    payload = random.Random(1).randbytes(1000)
    found = list(warc.chunks(payload, 300))
    assert [len(p) for _, p, _, _ in found] == [300, 300, 300, 100] and [last for *_, last, _ in found] == [False] * 3 + [True]
    assert found[-1][3] == warc.sha1_base32(hashlib.sha1(payload).digest())


@pytest.mark.parametrize("cut", [1, 7, 4096])
def test_archives_parse_in_any_pieces(cut):
    bodies = ["", "x\r\n\r\nWARC/1.1\r\n\r\ny", "tail\r\n", "\r\n\r\n", "é" * 700]
    whole = b"".join(
        r + warc.BREAK for i, b in enumerate(bodies) for r in warc.records(i, "u\nv" if i else None, hashlib.sha1(b.encode()).hexdigest(), b.encode(), None, 256)
    )
    rows = list(warc.parsed(whole[i : i + cut] for i in range(0, len(whole), cut)))
    assert [(r["id"], r["bytes"]) for r in rows] == [(f"<urn:page:{i}>", len(b.encode())) for i, b in enumerate(bodies)]
    assert [r["chunks"] for r in rows] == [1, 1, 1, 1, 6]


class Tasks:
    """Stands for a DataFrame: runs a function over one batch, as a worker would."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch

    def mapInArrow(self, run, schema) -> list[pa.RecordBatch]:  # noqa: N802
        return list(run(iter([self.batch])))


def test_near_duplicates_remember_no_words():
    neardup.shingles(b"some words", 5)
    tracemalloc.start()
    try:
        for at in range(100):
            neardup.shingles(" ".join(f"word{at}x{i}" for i in range(1000)).encode(), 5)
        assert tracemalloc.get_traced_memory()[0] < 1 << 20
    finally:
        tracemalloc.stop()


def test_near_duplicates_give_up_what_packing_remembers():
    coder = packing.encoder(WORDS)
    ids = coder.encode(b"five words of one text")
    caches = (coder.chunks, coder.words)
    assert all(c.known for c in caches)
    neardup.signatures(Tasks(pa.record_batch({"id": pa.array([1]), "text": pa.array([b"another text"])})), 5)
    assert not any(c.known or c.older for c in caches)
    assert coder.encode(b"five words of one text") == ids
