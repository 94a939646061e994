"""Product quantisation against a plain-Python version."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import codes

DDL = "vec_id long, embedding array<double>, label string, code int, part string, n double"


def brute(rows, rounds=codes.ROUNDS):
    kept = [(i, x, c) for i, x, c in rows if x is not None and None not in x and all(map(math.isfinite, x))]
    width = -(-max((len(x) for _, x, _ in kept), default=0) // 4)
    cut = [[math.floor(1024 * v) for v in x] + [0] * (4 * width - len(x)) for _, x, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    part = lambda k, p: cut[k][p * width:(p + 1) * width]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[part(k, p) for k in order[:256]] for p in range(4)]
    near = lambda k, p: min((far(part(k, p), e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(4):
            own = {}
            for k in range(len(kept)):
                own.setdefault(near(k, p)[1], []).append(part(k, p))
            new.append([[sum(c) // len(own[i]) for c in zip(*own[i])] if i in own else e
                        for i, e in enumerate(books[p])])
        books = new
    errors = [sum(near(k, p)[0] for p in range(4)) for k in range(len(kept))]
    by_label = {}
    for (_, _, c), e in zip(kept, errors):
        by_label[c] = by_label.get(c, 0) + e
    text = ",".join(str(v) for book in books for e in book for v in e)
    return sorted(((i, "".join(f"{near(k, p)[1]:02x}" for p in range(4)), errors[k], by_label[c],
                    hashlib.sha256(text.encode()).hexdigest()) for k, (i, _, c) in enumerate(kept)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, x, c, 1, "p", 0.5) for i, x, c in rows], DDL).repartition(3)
    coded, books = codes.compress(df)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, codes.digest(books))
                   for r in codes.with_label_errors(coded).collect()), key=str)


@pytest.mark.parametrize("width, scale", [(16, 1000), (5, 3), (1, 10), (3, 2 ** 30), (16, 2 ** 40), (33, 5000)])
def test_nearest_equals_brute_force(width, scale):
    r = np.random.default_rng(width)
    a, b = r.integers(-scale, scale, (150, width)), r.integers(-scale, scale, (90, width))
    b[50] = b[3]
    a[7] = b[3]
    far = ((a[:, None].astype(object) - b[None].astype(object)) ** 2).sum(2)
    index, distance = codes.nearest(a, b)
    want = [min((d, i) for i, d in enumerate(row)) for row in far]
    assert list(zip(map(int, distance), map(int, index))) == want


def test_transform_keeps_squared_lengths_and_orders_by_sign_changes():
    for width in (1, 2, 3, 16, 17):
        h = codes.hadamard(width)
        assert (h @ h.T == h.shape[1] * np.eye(width, dtype=int)).all()
    assert list((np.diff(codes.hadamard(16).T, axis=1) != 0).sum(1)) == list(range(16))


def test_equals_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in r.standard_normal(8).round(2)], "abc"[i % 3]) for i in r.permutation(400)]
    assert run(spark, rows) == brute(rows)


def test_defined_cases(spark):
    nan, inf = math.nan, math.inf
    rows = [(3, [1.0, 2.0, 3.0, 4.0, 5.0], "a"), (3, [1.0, 2.0, 3.0, 4.0, 5.0], None), (1, [-0.5, -0.0003], None),
            (2, [], "a"), (None, [0.1] * 5, "a"), (4, None, "a"), (5, [1.0, None], "a"), (6, [nan], "a"),
            (7, [inf, 1.0], "b"), (8, [3.0e5] * 5, "big"), (9, [-4.0e13, 0.0], "big")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert len(got) == 7


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, "a")]) == []
    assert [r[:4] for r in run(spark, [(1, [], "a"), (2, [], None)])] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
