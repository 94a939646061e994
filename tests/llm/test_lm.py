import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import lm


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def brute(rows):
    """Counts, base scores and exact (unquantised) bigram scores."""
    count, pairs, docs = Counter(), Counter(), 0
    for i, t in rows:
        if not lm.held_out(i):
            w = tokens(t)
            count.update(w)
            pairs.update(zip(["<s>", *w], w))
            docs += 1
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in rows:
        w = tokens(t)
        base = [(count[x] + 1) / (n + v + 1) for x in w]
        score = 0.0
        for left, x, p in zip(["<s>", *w], w, base):
            before = docs if left == "<s>" else count[left]
            c = pairs[left, x]
            c = min((3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0, before, count[x])
            score += math.log10((c + lm.PRIOR * p) / (before + lm.PRIOR))
        out[i] = (lm.held_out(i), len(w), sum(count[x] > 0 for x in w), n, sum(map(math.log10, base)), score)
    return out


def compare(got, want, exact):
    assert len(got) == len(want)
    for r in got:
        h, n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if exact:
            assert r.score == pytest.approx(score, rel=0.02, abs=0.1)     # false positives of the filter


def test_whole_table_against_plain_counts(spark):
    from tidemark.llm.common import table

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    compare(lm.query(spark, sf).collect(), brute(rows), True)


def test_odd_rows(docs_of):
    rows = [(i, t) for i, t in enumerate(["a b a b", None, "", " \n", "A\tB", "é x", "a b a b", "w " * 4000])]
    rows += [(None, "only here")]
    compare(lm.score(docs_of(rows)).collect(), brute(rows), True)


def test_empty_and_untrained(docs_of):
    assert lm.score(docs_of([(1, "a")]).where("false")).count() == 0
    held = next(i for i in range(100) if lm.held_out(i))
    r = lm.score(docs_of([(held, "a b")])).first()
    assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def filtered(pairs, counts):
    """Counts read back from a filter of these bigrams, and the exact quantised counts."""
    import pyarrow as pa

    rows = pa.table({"range": pa.array([0], pa.int32()),
                     "pairs": pa.array([pairs.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()], pa.binary()),
                     "counts": pa.array([counts.astype(np.uint32).tobytes()], pa.binary())})
    made = lm._segment(1 << 24)(rows).to_pylist()[0]
    table = lm.Filter(1, [(0, made["size"], made["bits"])])
    return table, table.count(pairs << np.uint64(24)), lm.level_count(lm.levels(counts))


@given(st.dictionaries(st.integers(0, 2**40 - 1), st.integers(1, 5000), min_size=1, max_size=400))
@settings(max_examples=50, deadline=None)
def test_filter_never_reads_less_than_the_count(counts):
    pairs = np.array(sorted(counts), np.uint64)
    _, read, exact = filtered(pairs, np.array([counts[int(p)] for p in pairs]))
    assert (read >= exact).all()


def test_filter_seldom_reads_more_than_the_count():
    """A share only means something over many bigrams: 20,000 in the filter and as many that are not."""
    r = np.random.default_rng(5)
    pairs = np.unique(r.integers(0, 2**40, 40_000).astype(np.uint64))
    held, other = pairs[::2].copy(), pairs[1::2].copy()
    table, read, exact = filtered(held, r.geometric(0.3, len(held)))
    assert (read == exact).mean() > 0.98
    assert (table.count(other << np.uint64(24)) == 0).mean() > 0.98


def test_a_full_segment_drops_the_rarest_bigrams():
    import pyarrow as pa

    pairs = np.arange(100, dtype=np.uint64)
    rows = pa.table({"range": pa.array([0], pa.int32()),
                     "pairs": pa.array([pairs.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()], pa.binary()),
                     "counts": pa.array([np.where(pairs < 90, 1, 8).astype(np.uint32).tobytes()], pa.binary())})
    made = lm._segment(12 * 50)(rows).to_pylist()[0]
    assert made["least"] == 2 and made["size"] == 12 * 40


def test_bigrams_beat_the_base_on_held_out_text(spark):
    rows = [r for r in lm.query(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_no_bigram_is_dropped_however_many_there_are(docs_of, monkeypatch):
    """Scores follow the exact counts, singletons too, where a filter of 2^14 bits would be full."""
    monkeypatch.setattr(lm, "FILTER_BITS", 1 << 14, raising=False)
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in r.integers(0, 300, 400))) for i in range(40)]
    compare(lm.score(docs_of(rows)).collect(), brute(rows), True)


def test_a_range_answers_for_every_bigram_it_was_sent():
    """200,000 singletons in one range: more than 2^20 bits held; bigrams only asked for read as 0."""
    import pyarrow as pa

    r = np.random.default_rng(4)
    pairs = np.unique(r.integers(0, 2**40, 220_000).astype(np.uint64))
    held = np.arange(len(pairs)) % 11 > 0
    sent = [pairs, pairs[held]]
    counts = [held.astype(np.uint32), np.ones(held.sum(), np.uint32)]
    rows = pa.table({"range": pa.array([7, 7], pa.int32()), "block": pa.array([1, 2], pa.int64()),
                     "pairs": pa.array([p.copy().view(np.uint8).reshape(-1, 8)[:, :5].tobytes() for p in sent], pa.binary()),
                     "counts": pa.array([c.tobytes() for c in counts], pa.binary())})
    one, two = (np.frombuffer(x["levels"], np.uint8) for x in lm._reply_bigrams(rows).to_pylist())
    assert (one[held] >= 2).all() and (two >= 2).all() and (one[held] == 2).mean() > 0.98
    assert (one[~held] == 0).mean() > 0.98
