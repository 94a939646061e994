import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import quality

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string, score double"


def labels_of(spark, rows):
    return spark.createDataFrame([(i, q, 0, "x", 0.0) for i, q in rows], LABELS)


@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 9)), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_isotonic_is_the_closest_non_decreasing_fit(rows):
    count = np.array([c for c, _ in rows], float)
    ones = np.array([min(o, c) for c, o in rows], float)
    level = quality.isotonic(count, ones)
    assert (np.diff(level) >= -1e-12).all()
    # max-min formula of isotonic regression
    n = len(rows)
    for i in range(n):
        want = max(min(ones[a:b + 1].sum() / count[a:b + 1].sum() for b in range(i, n)) for a in range(i + 1))
        assert level[i] == pytest.approx(want)


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.query(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    assert auc > 0.95, auc
    assert np.mean([(s >= 0.3) == t for s, t in held]) > 0.9


def test_partition_sums_equal_one_sum(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stats = quality.with_statistics(docs)
    a = quality.fit(stats.repartition(7), labels)
    b = quality.fit(stats.coalesce(1), labels)
    assert np.allclose(a.weights, b.weights, atol=1e-6)


def test_odd_rows(spark, docs_of):
    rows = [(i, f"some words of text {i} and more." if i % 2 else "##!! " * i) for i in range(1, 60)]
    rows += [(100, None), (101, ""), (None, "text"), (102, "x" * 200_000), (3, "again"), (103, " \n \n")]
    labels = labels_of(spark, [(i, i % 2) for i in range(1, 60)] + [(None, 1), (100, None), (3, 0), (999, 1)])
    out = quality.score(docs_of(rows), labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.doc_id: r.held_out for r in out}[None] is False
    kept = quality.accepted(docs_of(rows), labels)
    assert kept.columns == docs_of(rows).columns and 0 < kept.count() < len(rows)


def test_without_labels_and_empty(spark, docs_of):
    docs = docs_of([(1, "a b c"), (2, None)])
    assert {r.score for r in quality.score(docs, labels_of(spark, []))
            .collect()} == {0.5}
    assert quality.score(docs.where("false"), labels_of(spark, [(1, 1)])).count() == 0
