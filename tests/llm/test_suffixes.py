"""Suffix sorting and removal of repeated strings against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import suffixes


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 4))
def test_suffix_array(block, times):
    text = block * times
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_array_of_a_long_text():
    r = random.Random(1)
    text = [r.randrange(100) for _ in range(3000)] + [7] * 500 + [r.randrange(2) for _ in range(3000)]
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_every_window_has_one_anchor():
    r = np.random.default_rng(2)
    data = r.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 10, 1200, 1239, 1280, 5000])
    a, first, last, _ = suffixes.anchors(data, offsets, 40)
    starts = [s for f, e in zip(first, last) for s in range(f, e + 1)]
    assert starts == [s for b, e in zip(offsets, offsets[1:]) for s in range(b, e - 39)]
    of = {data[s:s + 40].tobytes(): x - s for x, f, e in zip(a, first, last) for s in range(f, e + 1)}
    assert all(0 <= x - s == of[data[s:s + 40].tobytes()] <= 30 for x, f, e in zip(a, first, last)
               for s in range(f, e + 1))


def brute(docs, length):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(hash(d[s:s + length]) for d in data for s in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(docs, data):
        gone = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[hash(d[s:s + length])] > 1:
                gone[s:s + length] = b"1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for run in bytes(gone).split(b"\0") if run)
        out.append((i, len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, length, **more):
    return sorted(map(tuple, suffixes.without_repeats(df, length, **more).collect()), key=str)


def corpus(seed, letters, n=60):
    r = random.Random(seed)
    passages = ["".join(r.choice(letters) for _ in range(r.randrange(10, 90))) for _ in range(8)]
    docs = []
    for i in range(n):
        t = "".join(r.choice([r.choice(passages), "".join(r.choice(letters) for _ in range(r.randrange(60)))])
                    for _ in range(r.randrange(5)))
        k = r.randrange(len(t) + 1)
        docs.append((i, t[:k] + r.choice(["", "#", "é", passages[0][5:40]]) + t[k:]))
    return docs + docs[:6] + [(1, "other text"), (200, "ab" * 60), (201, "ab" * 61 + "c"), (202, "z" * 90)]


@pytest.mark.parametrize("seed, letters, length, hot", [
    (1, "abcdefghij é", 20, 4096), (2, "ab", 20, 4096), (3, "abcdefghij é", 33, 1), (4, "ab", 12, 3), (5, "xyz", 3, 2)])
def test_equals_all_strings(spark, docs_of, seed, letters, length, hot):
    docs = corpus(seed, letters)
    assert run(docs_of(docs), length, hot=hot) == brute(docs, length)


def test_hot_core_is_taken_apart(spark, docs_of):
    r = random.Random(5)
    noise = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(60))
    common = noise()[:50]
    docs = [(i, noise() + common + noise()) for i in range(80)]
    want = brute(docs, 40)
    assert run(docs_of(docs), 40, hot=5) == want == run(docs_of(docs), 40)
    assert all(row[2] >= 50 for row in want)


def test_production_length_and_defined_cases(spark, docs_of):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(5000)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, long = text(200), text(250_000)
    docs = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, shared + text(50)), (5, text(30) + shared[:399]),
            (6, text(30) + shared[7:407] + text(5)), (None, shared), (7, long[:5000] + "!" + long[5000:]),
            (8, long), (9, "é" * 500), (10, long[1_100_000:1_100_500])]
    got = run(docs_of(docs), suffixes.LENGTH)
    assert got == brute(docs, suffixes.LENGTH)


def test_empty_table(spark, docs_of):
    assert run(docs_of([]), 20) == []
