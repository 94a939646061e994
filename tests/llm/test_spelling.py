"""Spelling variants against all pairs in plain Python."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from tidemark.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    rows, forms = {}, {}
    for w, c in words.items():
        near = [v for v in words if one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * c:
            forms[w] = best
        rows[w] = len(near)
    out = []
    for w, c in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, c, rows[w], words[forms[w]] if w in forms else None))
    return sorted(out)


def run(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect())


def corpus(seed, size=40, letters="abcdeéÿ×"):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randrange(6, 10))) for _ in range(size)]

    def edited(w):
        k = r.randrange(len(w))
        return r.choice([w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1:]])
    words = [w for w in base for _ in range(r.choice([5, 8, 30, 160]))]
    words += [v for w in base for v in [edited(w)] * r.choice([1, 5, 6])]
    words += [v for w in base for v in [edited(edited(w))] * 5]
    r.shuffle(words)
    return [(i, " ".join(r.choice([w, w.capitalize()]) for w in words[i::50])) for i in range(50)]


@pytest.mark.parametrize("seed, tile", [(1, 1 << 15), (2, 40)])
def test_equals_all_pairs(spark, docs_of, monkeypatch, seed, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    docs = corpus(seed)
    want = brute(docs)
    assert sum(form is not None for _, form, *_ in want) > 10
    assert run(docs_of(docs)) == want


def test_chains_end_in_one_root(spark, docs_of):
    chain = ["aaaaaa" + "b" * k for k in range(5)]
    docs = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(5 ** (k + 1))))]
    got = {r[0]: r for r in run(docs_of(docs))}
    assert run(docs_of(docs)) == brute(docs)
    assert got["aaaaaa"][2] == "aaaaaabbbb"


def test_defined_cases(spark, docs_of):
    long = "q" * 70_000
    docs = [(1, None), (2, ""), (None, "Straße " * 5 + "STRASSE " * 4 + "strasse"), (3, "x" * 5), (4, "ÀÉÈabc " * 6),
            (4, "ÀÉÈabc " * 6), (5, f"{long} " * 5 + f"{long}r " * 25), (6, "nummer1nummer " * 7), (7, "àéèabc " * 5),
            (8, "tieone " * 5 + "tietwo " * 5 + "tiexne " * 25 + "tieyne " * 25)]
    got = run(docs_of(docs))
    assert got == brute(docs)
    assert {r[0]: r[1] for r in got}["tieone"] == "tiexne"
    assert run(docs_of([])) == [] == run(docs_of([(1, None)]))


def test_counting_hands_on_full_counters(spark, docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    docs = corpus(3)
    df = docs_of(docs).select("doc_id", "text").coalesce(1)
    batches = df.toArrow().to_batches(max_chunksize=7)
    total = Counter()
    for batch in spelling._count(iter(batches)):
        for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[w] += n
    assert {w: n for w, n in total.items() if n >= 5} == {r.word: r.n for r in spelling.word_counts(df).collect()}
