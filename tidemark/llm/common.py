"""Helpers shared by the corpus operators: blocks of texts, word hashes, key
bitmaps of a fixed size, connected components, and scratch tables.

Hashes are computed a block at a time with numpy: a word's hash is a polynomial
in random 64-bit byte values, taken from one running sum over the block, so no
Python code runs per word.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

BLOCK_BYTES = (1 << 20) - 1    # texts handled at once in a Python worker
BATCH_ROWS = 500               # rows read, or sent to a Python worker, at once: documents are long
BITMAP_WORDS = 1 << 18         # rows of a key bitmap; 63 bits each, 4 MB in all
LINKS = 1 << 20                # links that a task turns into stars at once

SPACE = np.zeros(256, bool)    # \x20 and \x09-\x0D
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
WORD_BYTE = np.zeros(256, bool)  # 0-9, a-z after lower-casing, and all non-ASCII bytes
WORD_BYTE[0x30:0x3A] = WORD_BYTE[0x61:0x7B] = WORD_BYTE[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches between Spark and its Python workers by rows, as buffers of the usual
    10,000 documents take hundreds of MB a task on either side; and the batches of Parquet readers,
    whose vectors of 4,096 texts grow by doubling."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH_ROWS))


def give_back() -> None:
    """Returns memory that is free in this process to the system: Spark keeps idle workers, and what
    each has once used would count beside the executor's own."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to a new folder under spark.checkpoint.dir and read back:
    later jobs reread the files, also after executors are lost."""
    small_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Rows regrouped so that the texts of one block hold about ``limit`` bytes
    (a longer text is a block of its own). After the last one free memory is given back."""
    yield from _blocks(batches, column, limit)
    give_back()


def _blocks(batches, column, limit):
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, size, start = [], 0, i
            size += n
        if len(lengths) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def text_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, n + 1 offsets) of a string column; null is empty."""
    a = pc.fill_null(column, "").combine_chunks()
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0) if a.num_chunks else pa.array([], column.type)
    a = a.cast(pa.large_binary())
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]   # powers of the base and of its inverse


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of each; those a usual block needs are kept, longer tables are not."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    size, made = 1 << (n - 1).bit_length(), []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        made.append(np.multiply.accumulate(p, out=p))
    if size <= BLOCK_BYTES + 1:
        _POWERS[:] = made
    return made[0], made[1]


class Words(NamedTuple):
    data: np.ndarray    # the block's bytes, A-Z lower-cased
    start: np.ndarray   # of each word in data
    stop: np.ndarray
    first: np.ndarray   # n + 1: document d has the words first[d] .. first[d + 1]
    hash: np.ndarray    # 64 bits a word


def split_words(column: pa.ChunkedArray, of_word: np.ndarray) -> Words:
    """Words of every text: the longest runs of the bytes marked in ``of_word``."""
    raw, offsets = text_bytes(column)
    data = LOWER[raw]
    inside = of_word[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    stop = np.flatnonzero(inside & ~after) + 1
    powers, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:len(data)], out=total[1:])
    value = mix((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64))
    return Words(data, start, stop, np.searchsorted(start, offsets), value)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position (those that cross the end are left out)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = mix(out + words[j:j + n] + np.uint64(j + 1))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return x.view(np.int64)


# --- key bitmaps -----------------------------------------------------------------------------

def _slot(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    word = F.pmod(h, F.lit(BITMAP_WORDS)).cast("int")
    return word, F.pmod(F.shiftright(h, 20), F.lit(63)).cast("int")


def key_bitmap(keys: Column, df: DataFrame) -> DataFrame:
    """Rows (word, bits) that mark the hashes of all keys: at most BITMAP_WORDS
    rows whatever the input, so the result may be broadcast."""
    word, bit = _slot(keys)
    return (df.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
            .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))


def marked(df: DataFrame, key: Column, bitmap: DataFrame, how: str) -> DataFrame:
    """Rows whose key may be in the bitmap ('left_semi'), or surely is not ('left_anti')."""
    word, bit = _slot(key)
    b = F.broadcast(bitmap)
    on = (word == b["_word"]) & (F.call_function("shiftright", b["_bits"], bit).bitwiseAND(F.lit(1)) != 0)
    return df.join(b, on, how)


# --- connected components --------------------------------------------------------------------

def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = np.flatnonzero(x != y)
        if not len(apart):
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _contract(batches):
    """Rewrites each LINKS links of a task: every node to the smallest that it reaches by them."""
    def stars(held):
        nodes, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        at = at.reshape(2, -1)
        root = roots(len(nodes), at[0], at[1])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])

    held, size = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in ("u", "v")]))
        size += batch.num_rows
        if size >= LINKS:
            yield stars(held)
            held, size = [], 0
    if size:
        yield stars(held)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that reaches a smaller one.

    Passes without an exchange turn what a task reads of the links, LINKS at once, into stars,
    as long as that leaves fewer; once no more than LINKS are left one of them is the last.
    Otherwise a round of alternating star contraction links every node to the smallest of its
    neighbourhood, first for the larger neighbours, then for the smaller, and the passes follow
    again. Rounds grow with the logarithm of the longest chain; the links are rewritten to
    shared scratch in each. A node with very many links is a hot join key, which adaptive
    execution splits.
    """
    u, v = F.col("u"), F.col("v")

    def contracted(links):
        return stored(links.mapInArrow(_contract, "u long, v long"), "links")

    links = contracted(edges.where(F.col(a) != F.col(b))
                       .select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")))
    before = None
    while (count := links.count()) > LINKS:
        if before is None or 4 * count < 3 * before:
            links, before = contracted(links.coalesce(-(-count // LINKS))), count
            continue
        # links run from the larger node u to v
        both = links.unionByName(links.select(v.alias("u"), u.alias("v")))
        nodes = stored(both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")), "nodes")
        # in stars each node has larger neighbours only, or one that is smaller
        if not nodes.agg(F.count_if((F.col("low") < u) & (F.col("low") != F.col("high")))).first()[0]:
            return nodes.where(F.col("low") < u).select(u.alias("node"), F.col("low").alias("component"))
        # each larger neighbour u of v moves to v's least
        large = (links.join(nodes.select(u.alias("v"), F.least("low", u).alias("m")), "v")
                 .select("u", F.col("m").alias("v")).where(u != v))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
                 .unionByName(smallest.select("u", F.col("m").alias("v"))))
        links, before = stored(small.repartition("u"), "links"), None
    return contracted(links.coalesce(1)).select(u.alias("node"), v.alias("component"))
