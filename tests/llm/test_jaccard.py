import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import common, jaccard


def word_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """doc_id -> (sizes, smallest reachable id) by comparing all pairs."""
    sets = [(i, word_sets(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[x + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    return sorted(((i, len(word_sets(t)), None if i is None else root(i)) for i, t in rows), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def variant(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"z{r.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, n=160):
    r = random.Random(seed)
    bases = [[f"w{r.randrange(400)}" for _ in range(r.choice([6, 30, 120, 300]))] for _ in range(12)]
    shared = " ".join(f"s{i}" for i in range(40))
    rows = []
    for i in range(n):
        t = variant(r, r.choice(bases), r.randrange(0, 5))
        if r.random() < 0.4:
            t = f"{t}\t{shared}" if r.random() < 0.5 else f"{shared}\n{t}"
        rows.append((i * 3, t.upper() if r.random() < 0.2 else t))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(docs_of, seed):
    rows = corpus(seed)
    assert got(jaccard.jaccard_groups(docs_of(rows))) == brute(rows)


def test_small_tiles_and_split_hot_runs_give_the_same(docs_of, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(jaccard, "TILE", 7)
    monkeypatch.setattr(jaccard, "HOT", 5)
    assert got(jaccard.jaccard_groups(docs_of(rows))) == brute(rows)


def test_odd_rows(docs_of):
    rows = [(9, None), (8, ""), (7, " \n\t"), (6, "a b"), (5, "A  b"), (4, "a b c"), (3, "a b c d e f"),
            (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, None), (1, "x " * 3000),
            (11, "é ü x y z w"), (12, "Q W E R T Y"), (2, "q w e r t y")]
    want = dict((i, c) for i, _, c in brute([r for r in rows if r != (2, "q w e r t y")]))
    out = jaccard.jaccard_groups(docs_of(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == (2 if r.doc_id == 12 else want.get(r.doc_id))


def test_threshold_is_inclusive(docs_of):
    # 7 shared shingles of 8 and 8 (7/9), and 6 of 7 and 7 (6/8 = 0.75), and 5 of 6 and 6 (5/7)
    for n, linked in ((12, True), (11, True), (10, False)):
        a = [f"u{n}_{i}" for i in range(n)]
        rows = [(1, " ".join(a)), (2, " ".join([*a[:-1], "x"]))]
        assert got(jaccard.jaccard_groups(docs_of(rows)))[1][2] == (1 if linked else 2)


def test_empty_table(docs_of):
    assert jaccard.jaccard_groups(docs_of([(1, "a")]).where("false")).count() == 0


@given(st.sets(st.integers(0, 2**63), max_size=300), st.sets(st.integers(0, 2**63), max_size=300),
       st.sets(st.integers(0, 2**63), max_size=300))
@settings(max_examples=100, deadline=None)
def test_bitmaps_never_differ_in_more_bits_than_the_sets(common, a, b):
    x, y = (np.array(sorted(common | s), np.uint64) for s in (a, b))
    if len(x) and len(y):
        p, q = (np.frombuffer(jaccard.bitmap(s), np.uint64) for s in (x, y))
        while len(p) > len(q):
            p = p[:len(p) // 2] ^ p[len(p) // 2:]
        while len(q) > len(p):
            q = q[:len(q) // 2] ^ q[len(q) // 2:]
        assert int(np.bitwise_count(p ^ q).sum()) <= len(set(x.tolist()) ^ set(y.tolist()))


def test_whole_table(spark):
    from tidemark.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert got(jaccard.query(spark, "/root/testdata/sf0.001")) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_rounds_take_few_exchanges(spark, monkeypatch):
    """Every exchange is a stage with a task a partition, so a run's time on a small table is their number."""
    seen, keep = [], common.stored

    def stored(df, name, codec="snappy"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append((name, len(re.findall(r"\bExchange ", plan))))
        return keep(df, name, codec)

    monkeypatch.setattr(jaccard, "stored", stored)
    monkeypatch.setattr(common, "stored", stored)
    words = [f"w{k}" for k in range(60)]
    rows = [(d, " ".join(words[:50 - d % 7] + [f"x{d % 7}"])) for d in range(40)] + [(99, "alone here")]
    out = jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in out if r.doc_id != 99} == {0}
    assert sum(n for _, n in seen) <= 85, seen
