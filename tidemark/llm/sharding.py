"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group that stays together. Packing runs in two
levels, so that no task sees all groups. First the groups, dealt out by hash, are
packed into tiles of a fixed capacity (a small fraction of a shard); there are at
most about 2 * shards * TILES tiles, plus one open tile a task. Then the tiles, of
which only id and size come to the driver, are packed into the shards. Both levels
are best-fit decreasing: sorted by size, each item enters the bin with the least
room that still holds it, found in a balanced search tree over the remaining room.
The second level searches the smallest capacity at which the items fit into the
wanted number of shards. An item above an even share takes a shard alone, and the
rest is packed evenly into the other shards.

Defined cases: null text counts as '' and is in its group (size 8, the crc32 of
no bytes). Null doc_ids are rows like others, and so are repeated rows. A text of any length is
one row of its size. An empty table gives no rows. Only doc_id and text are read, other
columns may have any name.
"""

from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

TILES = 256              # tiles of a shard's size: the grain of the final packing
ROW_BYTES = 8            # besides the text
SLOT_CHUNK = 100_000     # rows numbered together


class RoomTree:
    """Treap over (room, bin): the bin with the least room of at least ``size``."""

    def __init__(self):
        self.root = None
        self.random = random.Random(1)

    def add(self, room: int, bin_: int) -> None:
        node, key = [(room, bin_), self.random.random(), None, None], (room, bin_)
        left, right = self._split(self.root, key)
        self.root = self._join(self._join(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the tightest (room, bin) that holds ``size``."""
        best, node = None, self.root
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best:
            left, rest = self._split(self.root, best)
            _, right = self._split(rest, (best[0], best[1] + 1))
            self.root = self._join(left, right)
        return best

    def _split(self, node, key):
        """(nodes below key, the others)."""
        if not node:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, left, right):
        if not left or not right:
            return left or right
        if left[1] < right[1]:
            left[3] = self._join(left[3], right)
            return left
        right[2] = self._join(left, right[2])
        return right


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each item (an item above the capacity has a bin alone); None if
    more than ``most`` bins are needed."""
    tree, bins, out = RoomTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if not found:
            if bins == most:
                return None
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        out[i] = found[1]
        if found[0] > sizes[i]:
            tree.add(found[0] - sizes[i], found[1])
    return out


def pack(sizes: list[int], shards: int) -> list[int]:
    """Shards of near equal size: items above an even share of what is left alone,
    the others at the smallest capacity that fits."""
    out, left, rest = [0] * len(sizes), shards, sum(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    while order and left > 1 and sizes[order[0]] * left > rest:
        i = order.pop(0)
        left -= 1
        out[i], rest = left, rest - sizes[i]
    if not order:
        return out
    items = [sizes[i] for i in order]
    low, high = max(-(-rest // left), items[0]), 2 * max(-(-rest // left), items[0])
    best = best_fit_decreasing(items, high, left)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(items, middle, left)
        if found:
            best, high = found, middle
        else:
            low = middle + 1
    for i, b in zip(order, best, strict=True):
        out[i] = b
    return out


def _tiles(capacity: int):
    """Packs the groups of one partition into tiles; a tile's id holds the partition."""
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        groups = pa.Table.from_batches(list(batches)) if batches else None
        if groups is None or not groups.num_rows:
            return
        sizes = groups.column("bytes").to_pylist()
        tile = [part << 32 | b for b in best_fit_decreasing(sizes, capacity)]
        for batch in groups.append_column("tile", pa.array(tile, pa.int64())).to_batches():
            yield batch
    return run


def shard(docs: DataFrame, shards: int = 24, tiles: int = TILES) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in each shard) of every document."""
    spark = docs.sparkSession
    binary = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = stored(docs.select("doc_id", (F.octet_length(binary) + ROW_BYTES).cast("long").alias("size"),
                              F.crc32(binary).alias("text_crc32"), F.sha1(binary).alias("digest")), "shard-rows")
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    capacity = max(1, total // (shards * tiles))
    parts = max(1, min(n // 20_000, 2 * shards * tiles))
    groups = (rows.groupBy("digest").agg(F.sum("size").alias("bytes")).repartition(parts, "digest"))
    tiled = stored(groups.mapInArrow(_tiles(capacity), "digest string, bytes long, tile long"), "shard-tiles")
    items = tiled.groupBy("tile").agg(F.sum("bytes").alias("bytes")).collect()  # at most 2 * shards * tiles + parts
    items.sort(key=lambda r: r["tile"])
    where = pack([r["bytes"] for r in items], shards)
    placed = spark.createDataFrame([(r["tile"], s) for r, s in zip(items, where, strict=True)],
                                   "tile long, shard int")
    out = (rows.join(tiled.join(F.broadcast(placed), "tile").select("digest", "shard"), "digest")
           .withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-n // SLOT_CHUNK))))))
    out = stored(out.drop("digest"), "shard-placed")
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (out.groupBy("shard", "chunk").count()
              .select("shard", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    number = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32"))
    return (out.withColumn("number", number).join(starts, ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).alias("slot")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
