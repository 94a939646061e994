import random

import pytest

from tidemark.llm import common


def brute(edges):
    """node -> smallest reachable, for nodes that reach a smaller one."""
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        up[hi] = lo
    return {i: root(i) for i in up if root(i) != i}


def links(seed, n=1500):
    r = random.Random(seed)
    names = r.sample(range(-10**9, 10**15), n)
    chain = list(zip(names[:500], names[1:500], strict=False))
    star = [(names[500], x) for x in names[501:800]]
    rest = [(r.choice(names[800:]), r.choice(names[800:])) for _ in range(500)]
    edges = chain + star + rest + rest[:50]
    r.shuffle(edges)
    return [e if r.random() < 0.5 else e[::-1] for e in edges]


@pytest.mark.parametrize("limit", [common.LINKS, 200, 20])
def test_equals_union_find(spark, monkeypatch, limit):
    """With small limits, star rounds and passes take turns until all nodes have their smallest."""
    monkeypatch.setattr(common, "LINKS", limit)
    monkeypatch.setattr(common, "BATCH_ROWS", 50)
    edges = links(7)
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = common.components(df, "a", "b").collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == brute(edges)


def test_no_links(spark):
    assert common.components(spark.createDataFrame([(1, 1)], "a long, b long"), "a", "b").count() == 0


def test_few_links_take_no_exchange(spark, monkeypatch):
    """Every exchange is a stage of as many tasks as there are partitions, however few the links are."""
    seen, keep = [], common.stored

    def stored(df, name, codec="snappy"):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, name, codec)

    monkeypatch.setattr(common, "stored", stored)
    df = spark.createDataFrame(links(3), "a long, b long")
    common.components(df, "a", "b").collect()
    assert seen and not any("Exchange " in plan for plan in seen)
