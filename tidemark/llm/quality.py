"""Quality scores: ridge regression on random Fourier features of document statistics.

Each text gives about twenty statistics (shares of character classes, repetition of
words, shingles and lines, lengths). Standardised, they pass through random Fourier
features that approximate a Gaussian kernel. Every partition sums its part of the
normal equations; the sums are added in groups and solved on the driver, whose input
has a fixed size. Scores of training rows by models that have not seen them (four folds
of the same sums) are calibrated by isotonic regression over a fixed number of bins.

Labels are learned from rows whose crc32(doc_id as text) mod 5 is not 0. Labels, lang,
source and doc_id never enter a score.

Defined cases: null text counts as ''; it has a score like any other. A null doc_id is
not held out and has no label. Several labels of one id count as their maximum, null
labels as none. Without labels of both kinds every score is the share of label 1
(0.5 without labels). Repeated rows are scored alike. Texts of any length are read whole; an empty
table gives no rows. Only doc_id and text are read for a score, other columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_SPACE, blocks, key_bitmap, marked, shingles, split_words, stored, table, text_bytes

FEATURES = 192
FOLDS = 4
BINS = 2000
RIDGE = 1e-4              # times the number of training rows
STATS = ["log_words", "log_bytes", "word_length", "longest_word", "upper", "lower", "digit", "space", "wide", "stop",
         "symbol", "exclaim", "bar", "distinct", "commonest", "adjacent", "shingle_again", "pair_again", "lines",
         "line_again", "symbol_end", "capital"]

_CLASS = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A),
    "space": [0x20, *range(0x09, 0x0E)], "wide": range(0x80, 0x100), "stop": b".,;:?'\"-()",
    "symbol": b"%&$*#@^~<>=+_/\\[]{}`", "exclaim": b"!", "bar": b"|", "lines": b"\n",
}
_MEMBER = {name: np.isin(np.arange(256), list(b)) for name, b in _CLASS.items()}
_ENDS = _MEMBER["symbol"] | _MEMBER["exclaim"] | _MEMBER["bar"]


def _again(values: np.ndarray) -> float:
    """Share of values that repeat an earlier one."""
    return 1 - len(np.unique(values)) / len(values) if len(values) else 0.0


def statistics(column) -> np.ndarray:
    """One row of STATS for every text."""
    raw, offsets = text_bytes(column)
    words = split_words(column, NOT_SPACE)
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    out = {"log_bytes": np.log1p(np.diff(offsets))}
    for name, member in _MEMBER.items():
        total = np.concatenate([[0], np.cumsum(member[raw])])
        out[name] = (total[offsets[1:]] - total[offsets[:-1]]) / size
    count = np.diff(words.first)
    some = np.maximum(count, 1)
    length = words.stop - words.start
    sums = np.concatenate([[0], np.cumsum(length)])
    out["log_words"] = np.log1p(count)
    out["word_length"] = (sums[words.first[1:]] - sums[words.first[:-1]]) / some
    for name, marks in (("symbol_end", _ENDS[raw[words.stop - 1]] if len(length) else np.zeros(0)),
                        ("capital", _MEMBER["upper"][raw[words.start]] if len(length) else np.zeros(0))):
        total = np.concatenate([[0], np.cumsum(marks)])
        out[name] = (total[words.first[1:]] - total[words.first[:-1]]) / some
    ends = np.flatnonzero(raw == 0x0A)
    for name in ("longest_word", "distinct", "commonest", "adjacent", "shingle_again", "pair_again", "line_again"):
        out[name] = np.zeros(n)
    hashes, pairs, fives = words.hash, shingles(words.hash, 2), shingles(words.hash, 5)
    for d, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
        if a == b:
            continue
        own = hashes[a:b]
        _, often = np.unique(own, return_counts=True)
        out["longest_word"][d] = np.log1p(length[a:b].max())
        out["distinct"][d] = len(often) / (b - a)
        out["commonest"][d] = often.max() / (b - a)
        out["adjacent"][d] = (own[1:] == own[:-1]).mean() if b - a > 1 else 0
        out["pair_again"][d] = _again(pairs[a:b - 1])
        out["shingle_again"][d] = _again(fives[a:max(a, b - 4)])
        breaks = ends[np.searchsorted(ends, offsets[d]):np.searchsorted(ends, offsets[d + 1])]
        if len(breaks):       # a line by its first word, last word and number of words
            at = np.searchsorted(words.start[a:b], breaks)
            first, last = np.concatenate([[0], at]), np.concatenate([at, [b - a]])
            keep = last > first
            out["line_again"][d] = _again(own[first[keep]] * np.uint64(31) + own[last[keep] - 1]
                                          + (last - first)[keep].astype(np.uint64))
    return np.stack([np.asarray(out[s], np.float64) for s in STATS], 1)


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def held_out_column(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label) once an id, of the rows that may be learned from."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull() & ~held_out_column(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max(F.col(name).cast("int")).alias("label")))


class Model:
    def __init__(self, mean, scale, weights=None, knots=None):
        r = np.random.Generator(np.random.PCG64(17))
        self.mean, self.scale = mean, scale
        self.w = r.standard_normal((len(STATS), FEATURES)) / np.sqrt(len(STATS))
        self.b = r.uniform(0, 2 * np.pi, FEATURES)
        self.weights, self.knots = weights, knots

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / FEATURES)
        return np.concatenate([z, np.ones((len(z), 1))], 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.features(stats) @ self.weights
        if not len(self.knots[0]):
            return np.clip(raw, 0, 1)
        # a little of the raw score keeps the order within level parts
        return np.clip(0.99 * np.interp(raw, *self.knots) + 0.01 * np.clip(raw, 0, 1), 0, 1)


def isotonic(count: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The non-decreasing shares closest to ones / count, by pooling adjacent violators."""
    pools: list[list[float]] = []
    for c, o in zip(count.tolist(), ones.tolist(), strict=True):
        pools.append([o, c, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            o2, c2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + o2, pools[-1][1] + c2, pools[-1][2] + k2]
    return np.concatenate([np.full(k, o / c) for o, c, k in pools]) if pools else np.zeros(0)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and one double column for each of STATS."""
    def run(batches):
        for block in blocks(batches):
            stats = statistics(block.column("text"))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks().cast(pa.int64()),
                 *(pa.array(np.ascontiguousarray(stats[:, k])) for k in range(len(STATS)))],
                ["doc_id", *STATS])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


def _matrix(batch) -> np.ndarray:
    return np.stack([batch.column(s).to_numpy() for s in STATS], 1)


def _sums(model: Model):
    """Each partition's part of the normal equations, by fold."""
    def run(batches):
        from pyspark import TaskContext

        width = FEATURES + 1
        left, right = np.zeros((FOLDS, width, width)), np.zeros((FOLDS, width))
        for batch in batches:
            z, y, fold = model.features(_matrix(batch)), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            for f in range(FOLDS):
                own = z[fold == f]
                left[f] += own.T @ own
                right[f] += own.T @ y[fold == f]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array(range(FOLDS), pa.int32()), pa.array([part % 32] * FOLDS, pa.int32()),
            pa.array([np.concatenate([a.ravel(), b]).tobytes() for a, b in zip(left, right, strict=True)], pa.binary())],
            ["fold", "part", "sums"])
    return run


def _add(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in rows.column("sums"))
    return pa.table({"fold": rows.column("fold")[:1], "part": rows.column("part")[:1],
                     "sums": pa.array([total.tobytes()], pa.binary())})


def _solve(sums: np.ndarray) -> np.ndarray:
    width = FEATURES + 1
    left, right = sums[:-width].reshape(width, width), sums[-width:]
    n = left[-1, -1]
    return np.linalg.solve(left + np.eye(width) * (RIDGE * n + 1e-6), right)


def fit(stats: DataFrame, labels: DataFrame, name: str = "quality") -> Model:
    """The model of all labelled rows of ``with_statistics`` that are not held out."""
    spark = stats.sparkSession
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    train = stored(stats.join(one_label(labels, name), "doc_id").withColumn("fold", fold).drop("doc_id"), "quality-train")
    row = train.agg(F.count("*").alias("n"), F.sum("label").alias("ones"),
                    *(F.avg(s).alias(f"m_{s}") for s in STATS), *(F.stddev_pop(s).alias(f"s_{s}") for s in STATS)).first()
    if not row["n"] or row["ones"] in (0, row["n"]):
        share = row["ones"] / row["n"] if row["n"] else 0.5
        weights = np.zeros(FEATURES + 1)
        weights[-1] = share
        return Model(np.zeros(len(STATS)), np.ones(len(STATS)), weights, (np.zeros(0), np.zeros(0)))
    mean = np.array([row[f"m_{s}"] for s in STATS])
    model = Model(mean, np.maximum([row[f"s_{s}"] for s in STATS], 1e-6))
    schema = "fold int, part int, sums binary"
    parts = train.mapInArrow(_sums(model), schema).groupBy("fold", "part").applyInArrow(_add, schema)
    sums = {r["fold"]: np.frombuffer(r["sums"], np.float64)
            for r in parts.groupBy("fold").applyInArrow(_add, schema).collect()}       # FOLDS rows of fixed size
    total = sum(sums.values())
    unseen = [_solve(total - sums[f]) for f in range(FOLDS)]

    def bins(batches):
        count, ones = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for batch in batches:
            z, y, f = model.features(_matrix(batch)), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
            raw = np.einsum("ij,ij->i", z, np.stack(unseen)[f])
            at = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            count += np.bincount(at, minlength=BINS)
            ones += np.bincount(at, weights=y, minlength=BINS).astype(np.int64)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(ones[some])],
                                         ["bin", "count", "ones"])

    found = sorted(map(tuple, train.mapInArrow(bins, "bin long, count long, ones long").groupBy("bin")
                       .agg(F.sum("count"), F.sum("ones")).collect()))                  # at most BINS rows
    at, count, ones = np.array(found, float).T
    share = row["ones"] / row["n"]
    level = isotonic(count + 0.02, ones + 0.02 * share)
    model.weights, model.knots = _solve(total), ((at + 0.5) / BINS * 2 - 0.5, level)
    return model


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    stats = stored(with_statistics(docs), "quality-stats")
    shared = docs.sparkSession.sparkContext.broadcast(fit(stats, labels))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(_matrix(batch)))],
                                             ["doc_id", "score"])
    return (stats.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out_column(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that the model of these documents' labels accepts, all columns kept."""
    known = labels.where("quality is not null and doc_id is not null")
    labelled = marked(docs, F.col("doc_id"), key_bitmap(F.col("doc_id"), known), "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast(fit(with_statistics(labelled), labels))

    def run(batches):
        for block in blocks(batches):
            keep = shared.value.score(statistics(block.column("text"))) >= threshold
            yield from block.filter(pa.array(keep)).to_batches()
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
