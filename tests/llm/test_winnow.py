import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import winnow

ITEMS = "item_id long, text string, words string, print long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, own = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    own |= windows[tuple(w[k:k + n])]
        names = ",".join(sorted(map(str, own)))
        out.append((d, len(w), len(hit), len(own), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    items = [(i, " ".join(f"v{r.randrange(30)}" for _ in range(r.choice([10, 11, 25, 60])))) for i in range(12)]
    items += [(20, "one two three"), (21, "solo!"), (22, ""), (23, None), (None, "v1 v2 v3"), (24, items[3][1]),
              (25, "aa " * 14), (26, "A-b_c.d É")]
    docs = []
    for d in range(60):
        w = [f"v{r.randrange(30)}" for _ in range(r.randrange(0, 80))]
        for _ in range(r.randrange(0, 3)):
            src = words(r.choice(items)[1])
            a = r.randrange(0, max(1, len(src)))
            k = r.randrange(0, len(w) + 1)
            w[k:k] = src[a:a + r.randrange(3, 30)]
        docs.append((d, r.choice([" ", ", ", "\n"]).join(w).upper()))
    docs += [(100, None), (101, ""), (102, "Solo"), (103, "aa " * 30), (104, "x one two three y"), (None, items[0][1]),
             (105, items[1][1]), (105, items[1][1]), (105, "other"), (106, "a B c, D é")]
    docs += [(107, "w " * 20_000 + items[2][1] + " z" * 20_000)]
    return docs, items


@pytest.mark.parametrize("part", [250_000, 40])
def test_equals_all_windows(spark, docs_of, monkeypatch, part):
    monkeypatch.setattr(winnow, "PART", part)
    docs, items = corpus(4)
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    assert got(winnow.contamination(docs_of(docs), bench)) == brute(docs, items)


def test_clean_keeps_rows_without_hits(spark, docs_of):
    docs, items = corpus(5)
    bench = spark.createDataFrame([(*i, "x", 1) for i in items], ITEMS)
    kept = winnow.clean(docs_of(docs), bench)
    assert kept.columns == docs_of(docs).columns
    want = sorted([d for d, t in docs if not brute([(d, t)], items)[0][5]], key=str)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == want


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], ITEMS)
    docs = docs_of([(1, "a b"), (2, None)])
    assert got(winnow.contamination(docs, bench)) == brute([(1, "a b"), (2, None)], [])
    assert winnow.contamination(docs.where("false"), bench).count() == 0


def test_no_python_in_the_plan(spark, docs_of):
    bench = spark.createDataFrame([(1, "a b c", "x", 1)], ITEMS)
    plan = winnow.contamination(docs_of([(1, "a")]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


@given(st.lists(st.integers(0, 5), min_size=10, max_size=40), st.lists(st.integers(0, 5), min_size=10, max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_shared_span_holds_a_common_fingerprint(a, b):
    def hashes(x):
        return [hash(tuple(x[i:i + 5])) for i in range(len(x) - 4)]

    def prints(x):
        h = hashes(x)
        return {min(h[i:i + 6]) for i in range(len(h) - 5)}
    shared = {tuple(a[i:i + 10]) for i in range(len(a) - 9)} & {tuple(b[i:i + 10]) for i in range(len(b) - 9)}
    for s in shared:
        assert prints(a) & set(hashes(list(s))) & set(hashes(b))


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got(winnow.query(spark, sf)) == brute(docs, items)


def test_fingerprint_places_are_the_first_least_of_every_window(spark):
    """From hashes that carry their places, so that a window is cut out once and not searched again."""
    r, low = random.Random(5), -(2**63)
    rows = [(k, [r.choice([low, -4096, 0, 4096, r.randrange(low, 2**63) // 4096 * 4096]) for _ in range(n)])
            for k, n in enumerate([0, 1, 5, 6, 7, 300, winnow.PIECE + winnow.SPAN - winnow.GRAM])]
    df = spark.createDataFrame(rows, "k long, h array<bigint>").withColumn("p", winnow.placed_hashes(F.col("h")))
    got = {x.k: x.places for x in df.select("k", winnow.fingerprint_places(F.col("p"), 6).alias("places")).collect()}
    assert winnow.PLACES > winnow.PIECE + winnow.SPAN
    for k, h in rows:
        want = [i + h[i:i + 6].index(min(h[i:i + 6])) for i in range(len(h) - 5)]
        assert got[k] == sorted(set(want))
