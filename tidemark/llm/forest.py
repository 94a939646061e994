"""Near-duplicate embeddings by a forest of random-projection trees.

Vectors of one label are split recursively: each level of a tree has a random
direction, and a node splits at the median of its vectors on it. Medians are fitted on
a bounded sample; where a node has few sample rows, the level's median over the whole
sample stands in, so trees may grow deeper than the sample. Vectors closer than
``SPILL`` standard distances to a split go to both sides. All vectors are routed
through all trees, and those in one leaf are compared by one matrix product in double
precision. A pair that meets in several leaves is counted in the first of them only,
which each side knows from its own list of leaves; so links are summed per vector
and pairs are never written. A leaf above ``TILE`` vectors is compared in tiles.

Recall against brute force is measured in tests/llm (at least 0.9; above 0.99 there), also on
8,000 vectors of one label, where the trees split at the production LEAF.

Defined cases: equal vectors of a label are one class, compared once and counted by
weight. A null label, a null vec_id, and a vector that is null, empty, zero, or holds
null or non-finite components link with nothing: n_links is 0, and the component is
the row's own vec_id (null stays null, and is not kept). Vectors of different lengths
link with nothing. Rows that repeat a vec_id with another vector are compared each, and share
the id's name in components; an empty table gives no rows. Only vec_id, embedding and label
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, roots, stored, table

TREES = 5
LEAF = 512               # vectors wanted in a leaf
SPILL = 0.5              # share of the typical projected distance of two vectors at the threshold
TILE = 1024              # vectors on either side of a tile
SAMPLE = 20_000          # rows on which the medians are fitted
NODE_SAMPLE = 32         # sample rows that a node's own median takes at least
MAX_DEPTH = 40


def directions(dim: int) -> np.ndarray:
    """Unit directions (dim, TREES * MAX_DEPTH), the same on every worker."""
    r = np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, TREES * MAX_DEPTH))
    return r / np.linalg.norm(r, axis=0)


def units(column) -> np.ndarray:
    """The vectors of a list column (all of one length) scaled to length 1, in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Forest:
    """Medians by (label, length), tree and node; ``level`` has each level's over all labels."""

    def __init__(self, sample: list[tuple[int, int, np.ndarray]], threshold: float):
        self.threshold = threshold
        self.nodes: dict[tuple[int, int], list[dict[int, float]]] = {}
        self.level: dict[int, np.ndarray] = {}
        by: dict[tuple[int, int], list[np.ndarray]] = {}
        for label, dim, x in sample:
            by.setdefault((label, dim), []).append(x)
        for dim in {d for _, d in by}:
            every = np.concatenate([np.stack(v) for (_, d), v in by.items() if d == dim]) @ directions(dim)
            self.level[dim] = np.median(every, axis=0)
        for (label, dim), rows in by.items():
            p = (np.stack(rows) @ directions(dim)).reshape(len(rows), TREES, MAX_DEPTH)
            self.nodes[label, dim] = [self._fit(p[:, t]) for t in range(TREES)]

    @staticmethod
    def _fit(p: np.ndarray) -> dict[int, float]:
        out, open_ = {}, [(1, 0, np.arange(len(p)))]
        while open_:
            node, depth, rows = open_.pop()
            if len(rows) < NODE_SAMPLE or depth == MAX_DEPTH:
                continue
            cut = out[node] = float(np.median(p[rows, depth]))
            left = p[rows, depth] <= cut
            open_ += [(2 * node, depth + 1, rows[left]), (2 * node + 1, depth + 1, rows[~left])]
        return out

    def leaves(self, x: np.ndarray, label: int, depth: int) -> list[list[tuple[int, int]]]:
        """(tree, node) of all leaves of every row."""
        dim = x.shape[1]
        margin = SPILL * np.sqrt(2 - 2 * self.threshold) / np.sqrt(dim)
        p = (x @ directions(dim)).reshape(len(x), TREES, MAX_DEPTH)
        level = self.level.get(dim, np.zeros(TREES * MAX_DEPTH)).reshape(TREES, MAX_DEPTH)
        out: list[list[tuple[int, int]]] = [[] for _ in x]
        for t in range(TREES):
            cuts = self.nodes.get((label, dim), [{}] * TREES)[t]
            rows, node = np.arange(len(x)), np.ones(len(x), np.int64)
            for d in range(min(depth, MAX_DEPTH)):
                names, where = np.unique(node, return_inverse=True)
                cut = np.array([cuts.get(int(n), level[t, d]) for n in names])[where]
                at = p[rows, t, d]
                left, right = at <= cut + margin, at > cut - margin
                rows = np.concatenate([rows[left], rows[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            for r, n in zip(rows.tolist(), node.tolist(), strict=True):
                out[r].append((t, n))
        return out


def _route(shared):
    def run(batches):
        forest: Forest = shared.value
        for batch in batches:
            label, dim, depth = (batch.column(c).to_numpy() for c in ("label", "dim", "depth"))
            for key in sorted(set(zip(label.tolist(), dim.tolist(), depth.tolist(), strict=True))):
                part = batch.filter(pa.array((label == key[0]) & (dim == key[1]) & (depth == key[2])))
                x = units(part.column("embedding"))
                lists = [[t << 42 | n for t, n in row] for row in forest.leaves(x, key[0], key[2])]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("label"), part.column("dim"), part.column("weight"),
                    pa.array([v.tobytes() for v in x], pa.binary()),
                    pa.array([sorted(v) for v in lists], pa.list_(pa.int64()))],
                    ["id", "label", "dim", "weight", "unit", "leaves"])
    return run


def _compare(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        """(id, links, root): weights of linked vectors counted in this leaf, and a linked id."""
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        ids, weight, side = (rows.column(c).to_numpy() for c in ("id", "weight", "side"))
        x = np.stack([np.frombuffer(v, np.float64) for v in rows.column("unit").to_pylist()])
        lists = rows.column("leaves").to_pylist()
        longest = max(map(len, lists))
        member = np.array([v + [-1] * (longest - len(v)) for v in lists], np.int64)
        here = rows.column("leaf")[0].as_py()
        sides = np.unique(side)
        if len(sides) == 2:
            one, two = (np.flatnonzero(side == s) for s in sides)
            a, b = np.nonzero(x[one] @ x[two].T >= threshold)
            a, b = one[a], two[b]
        else:
            a, b = np.nonzero(np.triu(x @ x.T >= threshold, 1))
            if rows.column("i")[0].as_py() != rows.column("j")[0].as_py():
                a, b = a[:0], b[:0]           # an off-diagonal tile with one empty side
        links = np.zeros(len(ids), np.int64)
        for s in range(0, len(a), 50_000):
            p, q = a[s:s + 50_000], b[s:s + 50_000]
            common = (member[p][:, :, None] == member[q][:, None, :]).any(2) & (member[p] >= 0)
            first = member[p, common.argmax(1)] == here
            np.add.at(links, p[first], weight[q[first]])
            np.add.at(links, q[first], weight[p[first]])
        root = roots(len(ids), a, b)
        keep = np.zeros(len(ids), bool)
        keep[a] = keep[b] = True
        return pa.table({"id": pa.array(ids[keep]), "links": pa.array(links[keep]), "root": pa.array(ids[root[keep]])})
    return run


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = embeddings.sparkSession
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
             & finite & F.exists(x, lambda v: v != 0))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             "embedding").withColumn("valid", F.coalesce(valid, F.lit(False)))
    good = rows.where("valid").withColumn("dim", F.size("embedding").cast("long"))
    classes = stored(good.groupBy("label", "dim", "embedding").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("weight")), "forest-classes")
    order = F.xxhash64("id", "label")
    sample = [(r["label"], r["dim"], units(pa.array([r["embedding"]]))[0])
              for r in classes.orderBy(order).limit(SAMPLE).select("label", "dim", "embedding").collect()]
    forest = spark.sparkContext.broadcast(Forest(sample, threshold))
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / LEAF))).cast("long")
    depths = classes.groupBy("label", "dim").count().select("label", "dim", depth.alias("depth"))
    routed = stored(classes.join(depths, ["label", "dim"])
                    .select("id", "label", "dim", "weight", "embedding", "depth")
                    .mapInArrow(_route(forest), "id long, label long, dim long, weight long, unit binary,"
                                                " leaves array<long>"), "forest-routed")
    held = routed.withColumn("leaf", F.explode("leaves"))
    ways = (held.groupBy("label", "dim", "leaf").count()
            .select("label", "dim", "leaf", F.ceil(F.col("count") / TILE).cast("int").alias("ways")))
    side = F.pmod(F.xxhash64("id"), F.col("ways")).cast("int")
    tiles = (held.join(ways, ["label", "dim", "leaf"]).withColumn("side", side)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
             .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")))
    found = stored(tiles.groupBy("label", "dim", "leaf", "i", "j").applyInArrow(
        _compare(threshold), "id long, links long, root long"), "forest-found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found, "id", "root")
    per_class = (classes.join(links, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
                 .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id")))
    linked = (good.select("vec_id", "label", "embedding").join(per_class, ["label", "embedding"])
              .select("vec_id", "n_links", "component_id"))
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
