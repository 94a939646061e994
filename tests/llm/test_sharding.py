import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import sharding


def naive(sizes, capacity):
    room, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        if fits:
            b = min(fits)[1]
        else:
            b = len(room)
            room.append(max(capacity, sizes[i]))
        room[b] -= sizes[i]
        out[i] = b
    return out


@given(st.lists(st.integers(1, 60), max_size=60), st.integers(20, 90))
@settings(max_examples=200, deadline=None)
def test_tree_packs_as_a_scan_of_all_bins(sizes, capacity):
    assert sharding.best_fit_decreasing(sizes, capacity) == naive(sizes, capacity)


def test_pack_is_near_equal_beside_a_giant():
    r = random.Random(3)
    sizes = [50_000] + [r.randint(1, 90) for _ in range(3000)]
    load = defaultdict(int)
    for s, b in zip(sizes, sharding.pack(sizes, 24), strict=True):
        load[b] += s
    rest = sorted(load.values())[:-1]
    assert len(load) == 24 and max(load.values()) == 50_000 and max(rest) - min(rest) <= 90


def check(docs, rows, shards=24):
    got = docs.collect()
    assert len(got) == len(rows)
    size = {i: len((t or "").encode()) + 8 for i, t in rows}
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    of_text, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    texts = dict(rows)
    for r in got:
        assert r["size"] == size[r.doc_id] and r.text_crc32 == crc[r.doc_id] and 0 <= r.shard < shards
        of_text[texts[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_groups_stay_and_slots_have_no_gaps(docs_of):
    r = random.Random(5)
    rows = [(i, "w" * r.randint(1, 400)) for i in range(900)] + [(1000, None), (1001, ""), (1002, "é" * 40)]
    rows += [(2000 + i, "hot text") for i in range(400)]
    check(sharding.shard(docs_of(rows)), rows)


def test_sizes_are_near_equal(spark):
    from tidemark.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    load = check(sharding.shard(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert max(load.values()) <= 1.02 * min(load.values())


def test_null_ids_and_empty_table(docs_of):
    assert sharding.shard(docs_of([(None, "a"), (None, "a"), (None, None)])).count() == 3
    assert sharding.shard(docs_of([(1, "a")]).where("false")).count() == 0
