import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import toxicity

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string, score double"
TEXTS = pa.chunked_array([pa.array(["a bad word here", "all fine", "", None, "x", "Über nice day " * 30 + "bad"])])


def test_gradients_match_finite_differences(monkeypatch):
    net = toxicity.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    v = toxicity.Vocabulary(TEXTS)
    places, _ = v.windows()
    label = (np.arange(len(places)) % 2).astype(float)

    def loss():
        z = net.forward(net.inputs(net.vectors(v)), places).astype(np.float64)
        return np.mean(np.logaddexp(0, z) - label * z)
    found = net.gradients(v, places, label)
    r = np.random.default_rng(1)
    for name, g in found.items():
        flat = np.flatnonzero(np.abs(g).ravel() > 1e-4)
        for i in r.choice(flat, min(4, len(flat)), replace=False):
            at = np.unravel_index(i, g.shape)
            old, step = net.p[name][at], 1e-3
            net.p[name][at] = old + step
            up = loss()
            net.p[name][at] = old - step
            down = loss()
            net.p[name][at] = old
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=2e-5), name


def test_a_vocabulary_of_blocks_is_that_of_all_texts(monkeypatch):
    rows = pa.table({"text": TEXTS})
    monkeypatch.setattr(toxicity, "blocks", lambda batches, limit: (rows.slice(i, 2) for i in range(0, len(TEXTS), 2)))
    a, b = toxicity.Vocabulary(TEXTS), toxicity.Vocabulary.of_rows(rows)
    for name in ("hash", "word", "piece", "piece_first", "place", "first"):
        assert np.array_equal(getattr(a, name), getattr(b, name)), name


def test_windows_cover_every_word_and_overlap():
    v = toxicity.Vocabulary(pa.chunked_array([pa.array([" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 24, 25, 100)])]))
    places, doc = v.windows()
    for d, n in enumerate((0, 1, 24, 25, 100)):
        own = places[doc == d]
        assert len({p for p in own.ravel() if p < len(v.word)}) == n
        assert len(own) == max(1, -(-(n - 24) // 16) + 1)


def test_a_text_scores_the_same_in_any_block():
    net = toxicity.Network(3)
    whole = net.score(TEXTS)
    alone = [net.score(TEXTS.slice(i, 1))[0] for i in range(len(TEXTS))]
    assert np.allclose(whole, alone, atol=1e-6)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = toxicity.query(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    print("auc", auc, sorted(pos), sorted(neg)[-5:])
    assert auc > 0.85, auc
    assert np.mean([(s >= 0.5) == t for s, t in held]) > 0.9


def test_odd_rows(spark, docs_of):
    rows = [(i, f"plain words number {i} " + ("you idiot" if i % 3 == 0 else "and friends")) for i in range(1, 90)]
    rows += [(100, None), (101, ""), (None, "idiot"), (102, "y" * 100_000), (103, "calm " * 20_000 + "you idiot"), (3, "z")]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0), "x", 0.0) for i in range(1, 90)]
                                   + [(None, 1, 1, "", 0.0), (100, 1, None, "", 0.0)], LABELS)
    out = {r.doc_id: r for r in toxicity.score(docs_of(rows), labels).collect()}
    assert len(out) == len(rows) - 1
    assert out[103].predicted == 1 and out[101].predicted == 0 and out[100].score == out[101].score
    kept = toxicity.accepted(docs_of(rows), labels)
    assert kept.columns == docs_of(rows).columns
    assert {103, 6}.isdisjoint({r.doc_id for r in kept.collect()})


def test_one_kind_of_label_and_empty(spark, docs_of):
    docs = docs_of([(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), none).count() == 0
