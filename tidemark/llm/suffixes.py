"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts elsewhere.

Suffixes are sorted by linear grouping (``suffix_array``): suffixes start in groups by their
first symbol and end in groups by their Lyndon prefix. Groups are taken in descending
order; each of a group's suffixes points to the nearest earlier suffix of a smaller group,
and these are split from their own groups, those pointed to more often ending higher. One
ascending pass over the groups then places every suffix, following the same pointers from
each suffix already placed to the ones that end in it. Nothing is renamed or sorted again.

Around that, Spark deals the corpus out so that equal strings meet, and no group does whole:

1. Every window of ``length`` bytes has an anchor, its last smallest hash of a quarter of
   that length, so equal windows have equal anchors at equal offsets. Anchors whose string
   occurs once in the corpus (counts are combined before the shuffle) are left out.
2. The windows of an anchor are cut by offset into pieces. All windows of a piece share its
   core, and equal windows lie in pieces of equal cores; so a piece is a core's 128-bit
   digest and up to 62 bytes on either side. Equal pieces are counted, not gathered.
3. Windows within one piece differ, so a piece that is alone with its core is decided by its
   count. Different pieces of one core are dealt into buckets by core; a bucket is one
   integer text (the core being one symbol of it) whose suffixes are sorted, and windows
   that share their whole length in that order are equal. A core with more than ``hot``
   different pieces is taken apart window by window, again counted before the shuffle.
4. The verdicts go back to the texts that hold the pieces, which are cut there.

A text is known by 128 bits of its SHA-256, so copies of a text share anchors and verdicts.

Defined cases: null text is the empty text; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other (each loses the whole text if long enough); null
doc_ids are rows like others; an empty table gives no rows; very long texts are read in
overlapping stretches of ``STRETCH`` windows. Of ties between equal smallest hashes in a
window the last counts. Only doc_id and text are read, other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTES, _powers, blocks, key_bitmap, marked, mix, signed, stored, table, text_bytes

LENGTH = 400
STRETCH = (1 << 20) - 1024   # windows hashed at once
HOT = 4096                   # different pieces of one core that are sorted together at most
BUCKET = 1 << 16             # symbols of a bucket, about
TASK = 1 << 18               # symbols that a task sorts, about
PLACE_BITS = 21              # of an anchor's key: its place in the stretch, to take the last of equals


def _width(length: int) -> int:
    """Offsets of a piece: its windows are bits of a long."""
    return max(1, min(63, length // 2))


# --- suffix sorting ------------------------------------------------------------------------------

def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes in ascending order; a suffix comes before those that it begins."""
    n = len(text)
    rank = {symbol: g for g, symbol in enumerate(sorted(set(text)), 1)}
    group = [rank[symbol] for symbol in text]
    group.append(0)                                   # the end, in a group of its own
    members: list[list[int]] = [[] for _ in range(len(rank) + 1)]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    above = [*range(1, len(members)), -1]             # groups in order, as a linked list
    below = list(range(-1, len(members) - 1))
    smaller = [-1] * (n + 1)                          # the nearest earlier suffix of a smaller group
    known = [False] * (n + 1)

    def split(g: int, part: list[int]) -> None:
        """Moves ``part`` out of group g into a new group next above it."""
        new, up = len(members), above[g]
        members.append(part)
        size.append(len(part))
        size[g] -= len(part)
        above.append(up)
        below.append(g)
        above[g] = new
        if up >= 0:
            below[up] = new
        for i in part:
            group[i] = new

    g = len(members) - 1
    while g >= 0:
        pointed: list[list[int]] = []                 # [suffix, pointers to it], ascending
        for i in members[g]:
            if group[i] != g:                         # has moved on
                continue
            j = i - 1
            while j >= 0 and known[j]:
                j = smaller[j]
            smaller[i] = j
            known[i] = True
            if j >= 0:
                if pointed and pointed[-1][0] == j:
                    pointed[-1][1] += 1
                else:
                    pointed.append([j, 1])
        if len(pointed) == 1:
            j = pointed[0][0]
            if size[group[j]] > 1:
                split(group[j], [j])
        elif pointed:
            for times in sorted({c for _, c in pointed}, reverse=True):
                parts: dict[int, list[int]] = {}
                for j, c in pointed:
                    if c == times:
                        parts.setdefault(group[j], []).append(j)
                for old, part in parts.items():
                    if size[old] > len(part):
                        split(old, part)
        g = below[g]

    free, at, g = [0] * len(members), 0, 0            # each group's next place
    while g >= 0:
        free[g] = at
        at += size[g]
        g = above[g]
    order, placed = [n] * (n + 1), [False] * (n + 1)
    for k in range(n + 1):
        i = order[k] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            order[free[g]] = i
            free[g] += 1
            placed[i] = True
            i = smaller[i]
    return order[1:]


# --- anchors and pieces --------------------------------------------------------------------------

def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window, hash of the anchor's string) of every run of windows
    of ``length`` bytes with one anchor; windows do not cross the ``offsets`` of texts."""
    gram = max(1, length // 4)
    wide = length - gram + 1                          # anchors that a window can have
    n = len(data)
    grams = n - gram + 1
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64),)
    powers, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:n], out=total[1:])
    value = mix((total[gram:] - total[:grams]) * inverse[:grams])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    key = (value & ~mask) | (mask - np.arange(grams, dtype=np.uint64))
    key = np.append(key, np.full(-grams % wide, ~np.uint64(0))).reshape(-1, wide)
    ahead = np.minimum.accumulate(key, 1).ravel()
    behind = np.minimum.accumulate(key[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - length + 1
    least = np.minimum(behind[:starts], ahead[wide - 1:wide - 1 + starts])
    anchor = (mask - (least & mask)).astype(np.int64)
    crossing = np.zeros(n + 1, np.int64)
    np.add.at(crossing, np.maximum(offsets[:-1], offsets[1:] - length + 1), 1)
    np.add.at(crossing, offsets[1:], -1)
    anchor[np.cumsum(crossing)[:starts] > 0] = -1
    first = np.flatnonzero(np.diff(anchor, prepend=-2))
    last = np.append(first[1:], starts) - 1
    real = anchor[first] >= 0
    first, last = first[real], last[real]
    return anchor[first], first, last, value[anchor[first]]


def _anchors(length):
    def run(batches):
        for block in blocks(batches):
            data, offsets = text_bytes(block.column("text"))
            for s in range(0, max(1, len(data)), STRETCH):
                end = min(len(data), s + STRETCH + length - 1)
                a, first, last, value = anchors(data[s:end], np.clip(offsets, s, end) - s, length)
                doc = np.searchsorted(offsets, first + s, "right") - 1
                move = s - offsets[doc]
                yield pa.RecordBatch.from_arrays(
                    [block.column("tid").combine_chunks().take(pa.array(doc)), pa.array(signed(value)),
                     *(pa.array((x + move).astype(np.int32)) for x in (a, first, last))],
                    names=["tid", "gram", "anchor", "first", "last"])
    return run


def _pieces(length):
    """Rows (piece, core, before, after, tid, at): the windows of shared anchors, cut by offset."""
    width = _width(length)

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for tid, text, found in zip(*(batch.column(c) for c in ("tid", "text", "found")), strict=True):
                tid, data = tid.as_py(), text.as_py().encode()
                for f in found.as_py():
                    anchor, first, last = f["anchor"], f["first"], f["last"]
                    for j in range((anchor - last) // width, (anchor - first) // width + 1):
                        head = anchor - j * width               # the last window's start, the core's too
                        tail = head - width + 1 + length        # the first window's end, the core's too
                        u, v = max(first, head - width + 1), min(last, head)
                        core = hashlib.blake2b(data[head:tail], digest_size=16).digest()
                        before, after = data[u:head], data[tail:v + length]
                        piece = hashlib.blake2b(core + bytes([len(before)]) + before + after, digest_size=16).digest()
                        for column, x in zip(out, (piece, core, before, after, tid, u), strict=True):
                            column.append(x)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.binary()) for c in out[:5]), pa.array(out[5], pa.int32())],
                                             names=["piece", "core", "before", "after", "tid", "at"])
    return run


def repeated_windows(pieces: list[tuple[int, bytes, bytes, int]], width: int) -> list[int]:
    """For each (core, before, after, occurrences) the windows, as bits, that occur twice or more
    among all of them."""
    text: list[int] = []
    start, owner, bit = [], [], []
    for k, (core, before, after, _) in enumerate(pieces):
        for t in range(len(before) + 1 + len(after) - width + 1):
            start.append(len(text) + t)
            owner.append(k)
            bit.append(t)
        text += [b + 1 for b in before]
        text.append(257 + core)
        text += [b + 1 for b in after]
        text.append(0)
    window = np.full(len(text), -1)
    window[start] = np.arange(len(start))
    order = window[suffix_array(text)]
    order = order[order >= 0]
    symbols, begin = np.array(text, np.int64), np.array(start)[order]
    new = np.ones(len(order), bool)
    for s in range(1, len(order), 1 << 15):
        rows = slice(s, s + (1 << 15))
        here = symbols[begin[rows, None] + np.arange(width)]
        there = symbols[begin[s - 1:s - 1 + len(here), None] + np.arange(width)]
        new[rows] = (here != there).any(1)
    kind = np.cumsum(new) - 1
    owner, bit = np.array(owner)[order], np.array(bit, np.uint64)[order]
    times = np.bincount(kind, np.array([p[3] for p in pieces], float)[owner])
    hit = times[kind] >= 2
    bits = np.zeros(len(pieces), np.int64)
    np.bitwise_or.at(bits, owner[hit], (np.uint64(1) << bit[hit]).view(np.int64))
    return bits.tolist()


def _sorted(width):
    def run(rows: pa.Table) -> pa.Table:
        cores = rows.column("core").combine_chunks().dictionary_encode().indices.to_pylist()
        pieces = list(zip(cores, rows.column("before").to_pylist(), rows.column("after").to_pylist(),
                          rows.column("n").to_pylist(), strict=True))
        return pa.table({"piece": rows.column("piece").cast(pa.binary()),
                         "bits": pa.array(repeated_windows(pieces, width), pa.int64())})
    return run


def _hot_windows(pieces: DataFrame, width: int) -> DataFrame:
    """(piece, bits) like ``_sorted``, a row per window: it is known by its core, what stands before and after."""
    each = pieces.withColumn("bit", F.explode(F.sequence(
        F.lit(0), F.length("before") + F.length("after") + 1 - width)))
    before = F.expr("substring(before, bit + 1, length(before))")
    after = F.expr(f"substring(after, 1, bit + {width} - 1 - length(before))")
    same = F.struct(*(F.xxhash64(F.lit(salt), "core", before, F.lit(salt), after) for salt in (1, 2)))
    each = each.select("piece", "bit", "n", same.alias("same"))
    often = each.groupBy("same").agg(F.sum("n").alias("times")).where("times >= 2").select("same")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return each.join(often, "same").groupBy("piece").agg(F.bit_or(bit).alias("bits"))


# --- the operator --------------------------------------------------------------------------------

def _text_id(df: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return df.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("sha")).withColumn(
        "tid", F.unhex(F.substring("sha", 1, 32)))


def repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(tid, found): for each text with repeated windows the lists of (at, bits), bit k standing
    for the window that starts at byte at + k. ``tid`` is the first half of the text's SHA-256."""
    width = _width(length)
    docs = _text_id(documents).where(F.octet_length("text") >= length).select("tid", "text")
    marks = stored(docs.mapInArrow(_anchors(length), "tid binary, gram long, anchor int, first int, last int"),
                   "suffix-anchors", "zstd")
    # stored ahead of the join, as Spark splits a skewed join of two plain exchanges only
    shared = stored(marks.groupBy("gram").count().where("count > 1").select("gram"), "suffix-shared")
    places = stored(marks.join(shared, "gram").groupBy("tid")
                    .agg(F.collect_set(F.struct("anchor", "first", "last")).alias("found")), "suffix-places", "zstd")
    some = marked(docs, F.col("tid"), key_bitmap(F.col("tid"), places), "left_semi")
    pieces = stored(some.join(places, "tid").mapInArrow(
        _pieces(length), "piece binary, core binary, before binary, after binary, tid binary, at int"),
        "suffix-pieces", "zstd")
    kinds = stored(pieces.groupBy("piece").agg(F.count("*").alias("n"), *(
        F.first(c).alias(c) for c in ("core", "before", "after"))), "suffix-kinds", "zstd")
    mixed = stored(kinds.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1"), "suffix-mixed", "zstd")
    groups = stored(kinds.join(mixed, "core"), "suffix-groups", "zstd")
    few, many = groups.where(F.col("kinds") <= hot), groups.where(F.col("kinds") > hot)
    symbols, n_many = groups.agg(F.sum(F.when(F.col("kinds") <= hot, F.length("before") + F.length("after") + 2)),
                                 F.count_if(F.col("kinds") > hot)).first()
    buckets, tasks = (-(-(symbols or 0) // n) or 1 for n in (BUCKET, TASK))
    # dealt to a stated number of tasks: by their bytes too many would go together
    verdicts = (few.withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(buckets))).repartition(tasks, "bucket")
                .groupBy("bucket").applyInArrow(_sorted(width), "piece binary, bits long"))
    if n_many:
        verdicts = verdicts.unionByName(_hot_windows(many, width))
    # equal pieces are copies in all their windows
    windows = F.length("before") + F.length("after") + 2 - width
    whole = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), F.lit(64) - windows)
    copied = kinds.where("n > 1").select("piece", whole.alias("bits"))
    verdicts = stored(verdicts.unionByName(copied).groupBy("piece").agg(F.bit_or("bits").alias("bits"))
                      .where("bits <> 0"), "suffix-verdicts", "zstd")
    return (pieces.select("piece", "tid", "at").join(verdicts, "piece").groupBy("tid")
            .agg(F.collect_set(F.struct("at", "bits")).alias("found")))


def _cut(length):
    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, sha, found in zip(*(batch.column(c) for c in ("doc_id", "text", "sha", "found")),
                                                strict=True):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                if not found.is_valid:
                    out.append((doc_id.as_py(), len(data), 0, 0, sha.as_py()))
                    continue
                at, bits = (np.array([f[c] for f in found.as_py()], np.int64) for c in ("at", "bits"))
                row, bit = np.nonzero(bits[:, None] >> np.arange(63) & 1)
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, at[row] + bit, 1)
                np.add.at(edge, at[row] + bit + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                kept = data[~gone].tobytes()
                out.append((doc_id.as_py(), len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def without_repeats(documents: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    found = stored(repeats(documents, length, hot), "suffix-found", "zstd")
    docs, bitmap = _text_id(documents), key_bitmap(F.col("tid"), found)
    kind = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}"
    none = F.lit(0).cast("long")
    cut = marked(docs, F.col("tid"), bitmap, "left_semi").join(found, "tid", "left").mapInArrow(
        _cut(length), f"{kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = marked(docs, F.col("tid"), bitmap, "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    return cut.unionByName(whole)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


#: Every 400-byte string by its position, as hex cut into stretches; runs of removed bytes and of kept ones by row.
ORACLE = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x
    FROM documents),
stretches AS (SELECT r, s, substr(x, 2 * s + 1, 2 * (512 + {LENGTH - 1})) AS x FROM (
    SELECT r, x, unnest(range(0, length(x) // 2 - {LENGTH - 1}, 512)) AS s FROM docs WHERE length(x) >= {2 * LENGTH})),
starts AS MATERIALIZED (SELECT r, s + k AS s, md5(substr(x, 2 * k + 1, {2 * LENGTH})) AS h
    FROM (SELECT r, s, x, unnest(range(length(x) // 2 - {LENGTH - 1})) AS k FROM stretches)),
hits AS MATERIALIZED (SELECT r, s FROM starts WHERE h IN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS before FROM hits),
grouped AS (SELECT r, s, sum(CASE WHEN before IS NULL OR s > before + {LENGTH} THEN 1 ELSE 0 END)
    OVER (PARTITION BY r ORDER BY s) AS g FROM marked),
spans AS MATERIALIZED (SELECT r, min(s) AS a, max(s) + {LENGTH} AS b FROM grouped GROUP BY r, g),
edges AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS from_ FROM spans),
kept AS (SELECT e.r, count(*) AS n_spans, CAST(sum(e.b - e.a) AS BIGINT) AS n_removed,
    string_agg(substr(d.x, 2 * e.from_ + 1, 2 * (e.a - e.from_)), '' ORDER BY e.a)
      || substr(first(d.x), 2 * max(e.b) + 1) AS x
    FROM edges e JOIN docs d ON d.r = e.r GROUP BY e.r)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.r = d.r"""
