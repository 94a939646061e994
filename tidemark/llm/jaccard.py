"""N-gram Jaccard join: documents whose sets of 5-word shingles have a Jaccard
similarity of at least 0.75, as connected groups.

1. One pass over the texts gives each set's size, digest and hashed bitmap (each
   shingle flips one bit; the width follows the size), and a fixed-size table of
   approximate shingle frequencies. Equal sets become one class.
2. A second pass deals each class's prefix - its rarest quarter of shingles, which two
   similar sets must share - to buckets. A bucket's run of sets with one shingle, in
   order of size, breaks into bands where sizes are too far apart to link. Neighbours in
   a band are compared first; these links join nearly all copies.
3. What remains of each run are pairs in different groups. A run with one group left is
   done; the others are compared in tiles of bounded size. In the first rounds each set
   is checked with the most similar set of another group only, which joins the groups of
   a family in a few rounds; the last round checks all pairs that are left.
Each comparison first bounds the overlap from above: the bitmaps of two sets differ in
no more bits than the sets differ in elements. Only pairs within the bound have
their texts fetched for the exact intersection of the sorted arrays. Every pair that
can link shares a prefix shingle and is compared in step 2 or 3 or lies within one
group, so no link between groups is lost.

A shingle shared by very many sets is known from the frequency table before the
shuffle, and its run is dealt to several buckets.

Defined cases: a null text, or one without words, has an empty set and no links (its
component is its own id). A null doc_id links with nothing and has a null component.
Rows with the same doc_id are one node and link by any of their texts. Shingles are
compared by 64-bit hash. Texts of any length are read whole; an empty table gives no rows. The
operator gives groups, not links: within a group not all pairs are compared. Only doc_id and
text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (NOT_SPACE, blocks, components, key_bitmap, marked, mix, shingles, signed, split_words, stored,
                     table)

SHINGLE = 5
SKETCH_BITS = 18          # the frequency table has 2 ** 18 counts
SKETCH_CHUNKS = 16
POSTINGS = 100_000        # prefix shingles that a bucket is wanted to hold
HOT = 20_000              # sets with one shingle that go to one bucket, at least
ABOVE = 4                 # times the mean count of the frequency table that a frequent shingle must reach too
FLUSH = 500_000           # postings that a task holds before it deals them out
TILE = 512                # sets on either side of a tile
ROUNDS = 1                # rounds with the most similar set only


def text_sets(column, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    words = split_words(column, NOT_SPACE)
    hashes = shingles(words.hash, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashes[a:b - size + 1]))
        else:
            out.append(shingles(words.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def width(n: int) -> int:
    """Bits of the bitmap of a set of n shingles."""
    return max(64, 4 << (n - 1).bit_length())


def bitmap(own: np.ndarray) -> bytes:
    w = width(len(own))
    flips = np.bincount((own >> np.uint64(7)).astype(np.int64) & (w - 1), minlength=w)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(n1, n2, differing):
    """False only if the sets surely miss 100 * intersection >= 75 * union."""
    return 7 * differing <= n1 + n2


def links(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _signatures(batches):
    """Rows of kind 0 for documents; of kind 1 for the pieces of this task's frequency table."""
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()), ("d1", pa.int64()),
                        ("d2", pa.int64()), ("bits", pa.binary())])
    for block in blocks(batches):
        sets = text_sets(block.column("text"))
        d1, d2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
        for i, s in enumerate(sets):
            d1[i], d2[i] = np.sum(mix(s), dtype=np.uint64), np.sum(mix(~s), dtype=np.uint64)
        if len(sets):
            sketch += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                  minlength=len(sketch))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.zeros(len(sets), np.int32)), block.column("doc_id").combine_chunks().cast(pa.int64()),
            pa.array([len(s) for s in sets], pa.int32()), pa.array(signed(d1)), pa.array(signed(d2)),
            pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary())], schema=schema)
    pieces = np.split(sketch, SKETCH_CHUNKS)
    yield pa.RecordBatch.from_arrays([
        pa.array([1] * SKETCH_CHUNKS, pa.int32()), pa.array(range(SKETCH_CHUNKS), pa.int64()),
        pa.array([0] * SKETCH_CHUNKS, pa.int32()), pa.array([int(sketch[:8].sum())] * SKETCH_CHUNKS, pa.int64()),
        pa.array([0] * SKETCH_CHUNKS, pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())],
        schema=schema)


def _sum_pieces(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in rows.column("bits"))
    return pa.table({"chunk": rows.column("chunk")[:1], "part": rows.column("part")[:1],
                     "bits": pa.array([total.tobytes()], pa.binary())})


def frequencies(read: DataFrame) -> np.ndarray:
    """The summed frequency table (2 MB): pieces are added in two rounds of groups."""
    rows = read.where("kind = 1").select(F.col("doc_id").alias("chunk"),
                                         F.pmod(F.col("d1"), F.lit(32)).alias("part"), "bits")
    schema = "chunk long, part long, bits binary"
    rows = rows.groupBy("chunk", "part").applyInArrow(_sum_pieces, schema)
    rows = rows.groupBy("chunk").applyInArrow(_sum_pieces, schema)
    pieces = {r["chunk"]: np.frombuffer(r["bits"], np.int64) for r in rows.collect()}
    if not pieces:
        return np.zeros(1 << SKETCH_BITS, np.int64)
    return np.concatenate([pieces[c] for c in range(SKETCH_CHUNKS)])


def hot_count(counts: np.ndarray) -> int:
    """The count in the frequency table from which a shingle's sets are dealt to several buckets.

    The table has a fixed size, so in a large corpus all its counts are sums over many shingles;
    only one well above their mean tells of a frequent shingle."""
    return max(HOT, int(ABOVE * counts.mean()))


def _postings(shared, buckets: int):
    """Deals (shingle, doc_id, set size) of every prefix to buckets, packed by bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary()), ("sizes", pa.binary())])

    def deal(keys, docs, sizes, counts, hot):
        keys, docs, sizes = np.concatenate(keys), np.concatenate(docs), np.concatenate(sizes)
        ways = 1 + counts[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] // hot
        salt = mix(docs.view(np.uint64)) % ways.astype(np.uint64)
        bucket = (mix(keys + salt) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, docs, sizes, bucket = keys[order], docs[order], sizes[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
            *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (keys, docs, sizes))],
            schema=schema)

    def run(batches):
        counts = shared.value
        hot = hot_count(counts)
        keys, docs, sizes, held = [], [], [], 0
        for block in blocks(batches):
            for doc, own in zip(block.column("doc_id").to_pylist(), text_sets(block.column("text")), strict=True):
                n = len(own)
                if not n or doc is None:
                    continue
                often = np.minimum(counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], (1 << 24) - 1)
                rank = often.astype(np.uint64) << np.uint64(40) | own >> np.uint64(24)
                prefix = own[np.argsort(rank, kind="stable")[:n - -(-3 * n // 4) + 1]]
                keys.append(prefix)
                docs.append(np.full(len(prefix), doc, np.int64))
                sizes.append(np.full(len(prefix), n, np.int32))
                held += len(prefix)
                if held >= FLUSH:
                    yield deal(keys, docs, sizes, counts, hot)
                    keys, docs, sizes, held = [], [], [], 0
        if held:
            yield deal(keys, docs, sizes, counts, hot)
    return run


RUN_DDL = "kind int, run long, salted boolean, a long, b long, n int"


def _runs(shared):
    """Per bucket: pairs of neighbours (kind 0: a, b) and the members of each distinct run of
    three or more sets, or of part of a hot run (kind 1: run, a, n)."""
    def run(rows: pa.Table) -> pa.Table:
        counts = shared.value
        keys, docs, sizes = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in rows.column(name)])
                             for name, kind in (("keys", np.uint64), ("docs", np.int64), ("sizes", np.int32)))
        order = np.lexsort((docs, sizes, keys))
        keys, docs, sizes = keys[order], docs[order], sizes[order]
        again = np.zeros(len(keys), bool)      # the same id with one shingle in two of its texts
        again[1:] = (keys[1:] == keys[:-1]) & (docs[1:] == docs[:-1]) & (sizes[1:] == sizes[:-1])
        keys, docs, sizes = keys[~again], docs[~again], sizes[~again]
        hot = counts[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= hot_count(counts)
        new = np.ones(len(keys), bool)
        apart = 3 * sizes[1:].astype(np.int64) > 4 * sizes[:-1].astype(np.int64)
        new[1:] = (keys[1:] != keys[:-1]) | (apart & ~hot[1:])
        band = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(keys)))
        near = np.flatnonzero(~new[1:] & ~(apart & hot[1:]))
        pairs = np.unique(np.stack([np.minimum(docs[near], docs[near + 1]),
                                    np.maximum(docs[near], docs[near + 1])], 1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        # equal runs (the same sets share many shingles) are kept once
        member = mix(docs.view(np.uint64) ^ sizes.astype(np.uint64) << np.uint64(40))
        names = mix(np.add.reduceat(member, start)) if len(start) else np.zeros(0, np.uint64)
        names = np.where(hot[start], keys[start], names)
        kept = np.zeros(len(start), bool)
        _, first = np.unique(names, return_index=True)
        kept[first] = True
        kept |= hot[start]
        rest = np.flatnonzero((kept & ((count > 2) | hot[start]))[band])
        m, k = len(pairs), len(rest)
        null = np.zeros(m, np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([0, 1], [m, k]).astype(np.int32)),
            "run": pa.array(np.concatenate([null, signed(names)[band[rest]]])),
            "salted": pa.array(np.concatenate([np.zeros(m, bool), hot[rest]])),
            "a": pa.array(np.concatenate([pairs[:, 0], docs[rest]])),
            "b": pa.array(np.concatenate([pairs[:, 1], docs[rest]])),
            "n": pa.array(np.concatenate([null.astype(np.int32), sizes[rest]]))})
    return run


def _near_bitmaps(batches):
    """Pairs (a, b) whose bitmaps let them link."""
    for batch in batches:
        out_a, out_b = [], []
        for a, b, na, nb, x, y in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            x, y = (np.frombuffer(v, np.uint64) for v in (x, y))
            while len(x) > len(y):
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            while len(y) > len(x):
                y = y[:len(y) // 2] ^ y[len(y) // 2:]
            if may_link(na, nb, int(np.bitwise_count(x ^ y).sum())):
                out_a.append(a)
                out_b.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])


def _exact(batches):
    for batch in batches:
        for block in blocks([batch], "x"):
            keep = [links(x, y) for x, y in zip(text_sets(block.column("x")), text_sets(block.column("y")), strict=True)]
            yield from block.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).to_batches()


def near_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that may link by their bitmaps."""
    bits = sets.select(F.col("doc_id").alias("id"), "n", "bits")
    both = (pairs.join(bits.withColumnsRenamed({"id": "a", "n": "na", "bits": "x"}), "a")
            .join(bits.withColumnsRenamed({"id": "b", "n": "nb", "bits": "y"}), "b"))
    return both.select("a", "b", "na", "nb", "x", "y").mapInArrow(_near_bitmaps, "a long, b long")


def verified(near: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that link, by exact intersection. Texts are fetched for pairs only
    that have passed the bitmaps."""
    near = stored(near, "near-pairs")
    ids = near.select(F.col("a").alias("id")).union(near.select("b")).distinct()
    texts = (marked(docs, F.col("doc_id"), key_bitmap(F.col("id"), ids), "left_semi")
             .join(ids, F.col("doc_id") == F.col("id"), "left_semi"))
    two = (near.join(texts.withColumnsRenamed({"doc_id": "a", "text": "x"}), "a")
           .join(texts.withColumnsRenamed({"doc_id": "b", "text": "y"}), "b"))
    return two.select("a", "b", "x", "y").mapInArrow(_exact, "a long, b long")


def _compare_tile(docs, sizes, groups, sides, bits, nearest):
    """Pairs of one tile that are in different groups and pass the bitmaps, or the most similar
    of each set's. A tile off the diagonal has two sides and compares only across them."""
    order = np.lexsort((docs, sizes))
    docs, sizes, groups, sides = docs[order], sizes[order].astype(np.int64), groups[order], sides[order]
    bits = [bits[i] for i in order]
    long = np.array([len(x) for x in bits])
    own = {w: np.stack([np.frombuffer(x, np.uint64) for x in bits if len(x) == w]) for w in set(long.tolist())}
    place = np.zeros(len(docs), np.int64)
    for w in own:
        place[long == w] = np.arange(len(own[w]))
    folded = {w: m[:, :m.shape[1] // 2] ^ m[:, m.shape[1] // 2:] for w, m in own.items() if w > 8}
    two_sided = len(np.unique(sides)) > 1
    for i in range(len(docs) - 1):
        stop = np.searchsorted(sizes, 4 * sizes[i] // 3, side="right")
        j = np.arange(i + 1, stop)
        j = j[(groups[j] != groups[i]) & (docs[j] != docs[i])]
        if two_sided:
            j = j[sides[j] != sides[i]]
        found, share = [], []
        for w in np.unique(long[j]):
            k = j[long[j] == w]
            mine = own[long[i]][place[i]]
            theirs = (own if w == long[i] else folded)[w][place[k]]
            differing = np.bitwise_count(theirs ^ mine).sum(1, dtype=np.int64)
            ok = may_link(sizes[i], sizes[k], differing)
            found.append(docs[k[ok]])
            share.append(differing[ok] / (sizes[i] + sizes[k[ok]]))
        found = np.concatenate(found or [docs[:0]])
        if nearest and len(found):
            found = found[[np.concatenate(share).argmin()]]
        for d in found.tolist():
            yield min(int(docs[i]), d), max(int(docs[i]), d)


def _tiles(nearest: bool):
    """For rows sorted by (run, i, j): compares the members of each tile."""
    def compare(t):
        keys = np.stack([t.column(c).to_numpy() for c in ("run", "i", "j")], 1)
        cut = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        found = set()
        for a, b in zip(cut, np.append(cut[1:], len(keys)), strict=True):
            part = t.slice(a, b - a)
            found.update(_compare_tile(*(part.column(c).to_numpy() for c in ("doc", "n", "component", "side")),
                                       part.column("bits").to_pylist(), nearest))
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            keys = [t.column(c).to_numpy() for c in ("run", "i", "j")]
            ends = np.flatnonzero((keys[0] != keys[0][-1]) | (keys[1] != keys[1][-1]) | (keys[2] != keys[2][-1]))
            done = int(ends[-1]) + 1 if len(ends) else 0      # the last tile may go on in the next batch
            if done:
                yield compare(t.slice(0, done))
            held = t.slice(done)
        if held is not None and held.num_rows:
            yield compare(held)
    return run


def tile_pairs(members: DataFrame, groups: DataFrame, sets: DataFrame, nearest: bool) -> DataFrame:
    """Pairs that share a run, are in different groups and pass the bitmaps (or only each set's
    most similar in a tile)."""
    rows = (members.join(groups.select(F.col("node").alias("doc"), "component"), "doc", "left")
            .withColumn("component", F.coalesce("component", "doc")))
    mixed = (rows.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count("*").alias("count"))
             .where("lo < hi").select("run", F.ceil(F.col("count") / TILE).cast("int").alias("ways")))
    rows = stored(rows.join(mixed, "run"), "jaccard-tiles")
    side = F.pmod(F.xxhash64("doc"), F.col("ways")).cast("int")
    rows = (rows.join(sets.select(F.col("doc_id").alias("doc"), F.col("n").alias("size"), "bits"), "doc")
            .where("n = size").withColumn("side", side)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
            .select("run", "doc", "n", "component", "side", "bits", F.least("side", "other").alias("i"),
                    F.greatest("side", "other").alias("j")))
    return (rows.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j")
            .mapInArrow(_tiles(nearest), "a long, b long").distinct())


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = stored(docs.mapInArrow(_signatures, "kind int, doc_id long, n int, d1 long, d2 long, bits binary"),
                  "jaccard-sets")
    counts = spark.sparkContext.broadcast(frequencies(read))        # 2 MB
    own = read.where("kind = 0")
    full = own.where("n > 0 and doc_id is not null")
    classes = stored(full.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("first"), F.first("bits").alias("bits")),
                     "jaccard-classes")
    sets = classes.select(F.col("first").alias("doc_id"), "n", "bits")
    # ids that are a copy in every class of theirs need no comparison
    copies = (full.join(classes.select("d1", "d2", "n", "first"), ["d1", "d2", "n"]).where("doc_id > first")
              .select(F.col("doc_id").alias("id")).distinct()
              .join(sets.select(F.col("doc_id").alias("id")), "id", "left_anti"))
    copies = stored(copies, "jaccard-copies")
    flags = key_bitmap(F.col("id"), copies)
    firsts = (marked(docs, F.col("doc_id"), flags, "left_semi")
              .join(copies, F.col("doc_id") == F.col("id"), "left_anti")
              .unionByName(marked(docs, F.col("doc_id"), flags, "left_anti")))
    prefixes = sets.agg(F.sum(F.col("n") - F.ceil(F.col("n") * 0.75) + 1)).first()[0] or 0
    packed = firsts.mapInArrow(_postings(counts, max(64, -(-int(prefixes) // POSTINGS))), "bucket int, keys binary, docs binary, sizes binary")
    runs = stored(packed.groupBy("bucket").applyInArrow(_runs(counts), RUN_DDL), "jaccard-runs")
    members = stored(runs.where("kind = 1").select("run", "salted", F.col("a").alias("doc"), "n").distinct(),
                     "jaccard-members")
    # neighbouring parts of a hot run are linked by their first members
    part = F.pmod(F.xxhash64("doc"), F.lit(64))
    bridge = members.where("salted").groupBy("run", part.alias("part")).agg(F.min("doc").alias("doc"))
    center = bridge.groupBy("run").agg(F.min("doc").alias("to"))
    bridge = bridge.join(center, "run").where("doc <> to").select(F.col("to").alias("a"), F.col("doc").alias("b"))
    pairs = runs.where("kind = 0").select("a", "b").unionByName(bridge).distinct()
    found = stored(verified(near_pairs(pairs, sets), docs), "jaccard-links")
    groups = components(found, "a", "b")
    for last in [False] * ROUNDS + [True]:
        more = stored(verified(tile_pairs(members, groups, sets, not last), docs), "jaccard-links")
        # the stars so far and the new links
        stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = components(stars.unionByName(more), "a", "b")
    of_set = classes.select("d1", "d2", "n", "first").join(
        groups.withColumnRenamed("node", "first"), "first", "left")
    of_set = of_set.select("d1", "d2", "n", F.coalesce("component", "first").alias("component"))
    out = own.join(of_set, ["d1", "d2", "n"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _with_keys(docs: DataFrame) -> DataFrame:
    """Adds ``_row_key``: the doc_id, but a hash of id and text where an id has several texts."""
    own = F.xxhash64("text")
    several = stored(docs.groupBy(F.col("doc_id").alias("_id")).agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
                     .where("lo <> hi").select("_id"), "jaccard-several")
    flags = key_bitmap(F.col("_id"), several)
    maybe = marked(docs, F.col("doc_id"), flags, "left_semi").join(several, F.col("doc_id") == F.col("_id"), "left")
    key = F.when(F.col("_id").isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", own))
    return (maybe.withColumn("_row_key", key).drop("_id")
            .unionByName(marked(docs, F.col("doc_id"), flags, "left_anti").withColumn("_row_key", F.col("doc_id"))))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of each group, all columns kept: that with the smallest doc_id. Rows that share an
    id but not their text are judged apart (by a hash in place of the id), so a text goes only
    if one of its own group stays; of rows that repeat id and text one stays. Rows with a
    null doc_id stay. Texts of rows that surely stay are not shuffled."""
    known = _with_keys(docs.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")))
    out = stored(jaccard_groups(known.select(F.col("_row_key").alias("doc_id"), "text")), "jaccard-out")
    gone = out.where("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    again = out.groupBy(F.col("doc_id").alias("_id")).count().where("count > 1").select("_id")
    either = stored(gone.withColumn("_gone", F.lit(True)).unionByName(again.withColumn("_gone", F.lit(False)))
                    .groupBy("_id").agg(F.max("_gone").alias("_gone")), "jaccard-gone")
    flags = key_bitmap(F.col("_id"), either)
    maybe = marked(known, F.col("_row_key"), flags, "left_semi").join(either, F.col("_row_key") == F.col("_id"), "left")
    untouched = maybe.where("_id is null").drop("_id", "_gone")
    first = maybe.where("not _gone").drop("_id", "_gone").dropDuplicates(["_row_key"])
    stay = marked(known, F.col("_row_key"), flags, "left_anti").unionByName(untouched).unionByName(first)
    return stay.select(docs.columns).unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))
