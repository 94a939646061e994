import numpy as np
import pytest

from tidemark.llm import forest

DDL = "vec_id long, embedding array<float>, label int, leaf long, weight double"
CLOSE = 0.93


def brute(rows):
    """vec_id -> (links, component) by comparing all pairs."""
    good = [(i, np.array(x, np.float32).astype(float), c) for i, x, c in rows
            if i is not None and c is not None and x and None not in x
            and np.isfinite(np.array(x, float)).all() and any(x)]
    up, links = {i: i for i, *_ in rows}, {i: 0 for i, *_ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for n, (i, x, c) in enumerate(good):
        for j, y, d in good[n + 1:]:
            if c == d and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= CLOSE:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((root(i), root(j)))
                up[hi] = lo
    return {i: (links[i], root(i) if i is not None else None) for i, *_ in rows}


def run(spark, rows):
    df = spark.createDataFrame([(i, x, c, 1, 2.0) for i, x, c in rows], DDL).repartition(3)
    return {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(df).collect()}


def clusters(seed, n=600, dim=24):
    r = np.random.default_rng(seed)
    centers = r.standard_normal((60, dim))
    rows = []
    for i in range(n):
        x = centers[r.integers(60)] + r.standard_normal(dim) * r.choice([0.05, 0.25])
        rows.append((i, [float(v) for v in x.astype(np.float32)], int(r.integers(2))))
    return rows


@pytest.mark.parametrize("leaf,tile", [(512, 1024), (40, 16)])
def test_against_all_pairs(spark, monkeypatch, leaf, tile):
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "TILE", tile)
    rows = clusters(1)
    want, got = brute(rows), run(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in want)            # no link below the threshold
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    if leaf == 512:
        assert got == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (7, None, 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 1),
            (10, [1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.0], 1), (13, [-1.0, -0.0], 1), (14, [1.0, 0.01], 1)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert forest.near_duplicates(spark.createDataFrame([], DDL)).count() == 0


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.query(spark, sf).collect()}
    want = brute(rows)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values())
    assert got == want


def test_recall_with_production_parameters_where_trees_split(spark):
    """8,000 vectors of one label: depth 4 at LEAF 512, pairs just above the threshold."""
    r = np.random.default_rng(8)
    n, dim = 8000, 64
    x = r.standard_normal((n, dim))
    x[n // 2:] = x[:n // 2] + 0.38 * r.standard_normal((n // 2, dim))     # cosine about 0.935
    x = x.astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = np.zeros(n, np.int64)
    for s in range(0, n, 1000):
        close[s:s + 1000] = (unit[s:s + 1000] @ unit.T >= CLOSE).sum(1) - 1
    assert close.sum() > 4000
    got = run(spark, [(i, [float(v) for v in row], 1) for i, row in enumerate(x)])
    links = np.array([got[i][0] for i in range(n)])
    assert (links <= close).all()
    assert links.sum() / close.sum() >= 0.99
