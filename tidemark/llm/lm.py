"""Language-model scores from a log-frequency Bloom filter of bigram counts.

1. Each block of texts is turned into numbers: its distinct word hashes, and every
   token as a place in them. Blocks are written once and reread by the later steps.
2. Word counts: each block sends its distinct words, packed by hash range, to the range's
   task, which adds the counts of the training documents and replies to each block with
   the totals of just its words. So counts are exact and no table is broadcast.
3. Bigrams go the same way: each block sends its distinct bigrams with their counts in
   training documents (0 for those only in held-out ones). Each range's task fills its
   segment of the filter: a bigram with count c enters once for each level 1 .. 1 + log2(c),
   under ``PROBES`` bits. A segment has ``BITS_PER_ENTRY`` bits for every entry, so the filter
   grows with the corpus and no count is left out; it stays in the range's task.
4. The task probes its segment for the bigrams it was sent, level after level until one
   misses, and replies to each block with the levels of just its bigrams.
   p(w | v) = (c(v w) + PRIOR * p(w)) / (c(v) + PRIOR), and p(w) has one count added, as in
   the base score.

Defined cases: null is an empty text, whose only token is the end. A null doc_id is not
held out, and is learned from. Words are compared by 64-bit hash, bigrams by the
bits of theirs that the packing keeps (48 at least). With no training text all
probabilities are 1. Repeated rows are learned from and scored each; texts of any length are read
whole; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_SPACE, blocks, mix, split_words, stored, table

BLOCK = (8 << 20) - 1
BITS_PER_ENTRY = 12
PROBES = 4
PRIOR = 5.0
RANGE_ENTRIES = 1 << 18        # packed entries wanted in one hash range
LEAST_RANGES = 256
BIGRAMS_A_RANGE = 1 << 20      # tokens for one hash range of bigrams, which are fewer
END, BEGIN = np.uint64(0xE0D0C0B0A0908070), np.uint64(0xB10C0B10C0B10C0B)


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


BLOCK_DDL = "block long, ids binary, known_id binary, held binary, learned long, first binary, tokens binary, words binary, counts binary"

BLOCK_SCHEMA = pa.schema([(name, pa.int64() if kind == "long" else pa.binary())
                          for name, kind in map(str.split, BLOCK_DDL.split(", "))])


def _blocks(batches):
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    for block in blocks(batches, limit=BLOCK):
        words = split_words(block.column("text"), NOT_SPACE)
        ids = block.column("doc_id").to_pylist()
        n = len(ids)
        first = words.first + np.arange(n + 1)       # one end token after each document
        every = np.full(first[-1], END, np.uint64)
        inner = np.ones(len(every), bool)
        inner[first[1:] - 1] = False
        every[inner] = words.hash
        distinct, tokens = np.unique(every, return_inverse=True)
        held = np.array([held_out(i) for i in ids])
        learned = np.repeat(~held, np.diff(first))
        counts = np.bincount(tokens[learned], minlength=len(distinct)).astype(np.int32)
        yield pa.RecordBatch.from_pylist([{
            "block": part << 32 | k, "ids": np.array([i or 0 for i in ids], np.int64).tobytes(),
            "known_id": np.array([i is not None for i in ids]).tobytes(), "held": held.tobytes(),
            "learned": int((~held).sum()), "first": first.tobytes(), "tokens": tokens.astype(np.int32).tobytes(),
            "words": distinct.tobytes(), "counts": counts.tobytes()}], BLOCK_SCHEMA)
        k += 1


def _array(row, name, kind):
    return np.frombuffer(row[name], kind)


def _ranges(entries: int, each: int = RANGE_ENTRIES) -> int:
    """A power of two of hash ranges: the entries decide."""
    return max(LEAST_RANGES, 1 << (max(1, entries) // each).bit_length())


def _slices(hashes: np.ndarray, shift: int, ranges: int) -> list[int]:
    """Where each hash range begins in sorted hashes, and the end."""
    return np.searchsorted(hashes >> np.uint64(shift), np.arange(ranges + 1, dtype=np.uint64)).tolist()


def _ask(ranges: int):
    """(range, block, words, counts): each block's distinct words by hash range."""
    shift = 64 - (ranges.bit_length() - 1)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = _array(row, "words", np.uint64), _array(row, "counts", np.int32)
                cuts = _slices(words, shift, ranges)
                spans = [(r, a, b) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r for r, *_ in spans], pa.int32()), pa.array([row["block"]] * len(spans), pa.int64()),
                    pa.array([words[a:b].tobytes() for _, a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary())],
                    ["range", "block", "words", "counts"])
    return run


def _reply(rows: pa.Table) -> pa.Table:
    """(block, range, totals) for each asking block; block -1 has (tokens, distinct) of the range."""
    words = [np.frombuffer(x.as_py(), np.uint64) for x in rows.column("words")]
    counts = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in rows.column("counts")])
    _, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(place, weights=counts).astype(np.int64)
    answers, at = [], 0
    for w in words:
        answers.append(total[place[at:at + len(w)]].tobytes())
        at += len(w)
    summary = np.array([total.sum(), np.count_nonzero(total)], np.int64)
    own = rows.column("range")[0].as_py()
    return pa.table({"block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()),
                     "range": pa.array([own] * (len(words) + 1), pa.int32()),
                     "totals": pa.array([*answers, summary.tobytes()], pa.binary())})


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(3) + mix(right + np.uint64(1)))


def _bigrams(row) -> np.ndarray:
    """The pair hash of each token and the one before it; the left of a document's first is BEGIN."""
    first, tokens, words = _array(row, "first", np.int64), _array(row, "tokens", np.int32), _array(row, "words", np.uint64)
    right = words[tokens]
    left = np.empty_like(right)
    left[1:] = right[:-1]
    left[first[:-1]] = BEGIN
    return pair_hash(left, right)


KEPT = 5                        # bytes of a bigram's hash kept beside its range


def _distinct_bigrams(row, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct bigrams, sorted, by the bits that are kept; the place of each token's among them."""
    return np.unique(_bigrams(row) >> np.uint64(64 - (ranges.bit_length() - 1) - 8 * KEPT), return_inverse=True)


def _ask_bigrams(ranges: int):
    """(range, block, pairs, counts): each block's distinct bigrams by hash range, with their learned counts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pairs, place = _distinct_bigrams(row, ranges)
                learned = np.repeat(~_array(row, "held", bool), np.diff(_array(row, "first", np.int64)))
                counts = np.bincount(place[learned], minlength=len(pairs)).astype(np.uint32)
                cuts = _slices(pairs, 8 * KEPT, ranges)
                kept = np.ascontiguousarray(pairs).view(np.uint8).reshape(-1, 8)[:, :KEPT]
                spans = [(r, a, b) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r for r, *_ in spans], pa.int32()), pa.array([row["block"]] * len(spans), pa.int64()),
                    pa.array([kept[a:b].tobytes() for _, a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary())],
                    ["range", "block", "pairs", "counts"])
    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """The highest level of each count: 1 + the whole part of its binary logarithm."""
    return np.frexp(counts.astype(np.float64))[1]


def level_count(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its counts; 0 for level 0."""
    return np.where(level > 0, (3 * 2.0 ** (level.astype(np.float64) - 1) - 1) / 2, 0.0)


def _bits(pairs: np.ndarray, level: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    """The bit of each (bigram, level) for one probe, in a segment of ``size`` bits."""
    return mix(pairs * np.uint64(2 * PROBES * 64 + 1) + (level * PROBES + probe).astype(np.uint64)) % size


def _summed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A range's distinct bigrams, the place of each sent one among them, and their summed counts."""
    pairs = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in rows.column("pairs")]).reshape(-1, KEPT)
    counts = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in rows.column("counts")])
    wide = np.zeros((len(pairs), 8), np.uint8)
    wide[:, :KEPT] = pairs
    pairs, place = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
    return pairs, place, np.bincount(place, weights=counts)


def _fill(pairs: np.ndarray, total: np.ndarray) -> tuple[int, bytes]:
    """Size and bits of the segment that holds these bigrams: BITS_PER_ENTRY bits for every entry."""
    level = levels(total)
    size = max(64, int(BITS_PER_ENTRY * level.sum()))
    filled = np.zeros(size, bool)
    for l in range(1, int(level.max(initial=0)) + 1):
        own = pairs[level >= l]
        for probe in range(PROBES):
            filled[_bits(own, np.full(len(own), l), probe, np.uint64(size)).astype(np.int64)] = True
    return size, np.packbits(filled, bitorder="little").tobytes()


def _segment(most: int):
    """A range's segment in at most ``most`` bits, without its rarest bigrams if need be. Scores do not
    use it: their segments have no bound."""
    def run(rows: pa.Table) -> pa.Table:
        pairs, _, total = _summed(rows)
        # the least count for which all entries have room
        by = np.sort(total)[::-1]
        need = BITS_PER_ENTRY * np.cumsum(levels(by))
        least = 1.0
        if need[-1] > most:
            out = by[np.searchsorted(need, most, side="right")]      # the first count without room
            least = out + 1
        keep = total >= least
        size, bits = _fill(pairs[keep], total[keep])
        return pa.table({"range": rows.column("range")[:1], "size": pa.array([size], pa.int64()),
                         "least": pa.array([int(least)], pa.int64()), "bits": pa.array([bits], pa.binary())})
    return run


def _reply_bigrams(rows: pa.Table) -> pa.Table:
    """(block, range, levels) for each asking block, read from the range's segment of the filter."""
    pairs, place, total = _summed(rows)
    own = Filter(1, [(0, *_fill(pairs, total))])
    level = own.level(pairs << np.uint64(64 - 8 * KEPT)).astype(np.uint8)[place]
    cuts = np.cumsum([0, *(len(x.as_py()) // KEPT for x in rows.column("pairs"))])
    return pa.table({"block": rows.column("block"), "range": rows.column("range"),
                     "levels": pa.array([level[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                                        pa.binary())})


class Filter:
    """Segments in one array; ``level`` and ``count`` read quantised counts back by probing."""

    def __init__(self, ranges: int, segments: list[tuple[int, int, bytes]]):
        self.ranges = ranges
        self.size, self.start = np.ones(ranges, np.uint64), np.zeros(ranges, np.int64)
        at, parts = 0, []
        for r, size, bits in segments:
            self.size[r], self.start[r] = size, at
            parts.append(bits)
            at += 8 * len(bits)
        self.present = np.zeros(ranges, bool)
        self.present[[r for r, *_ in segments]] = True
        self.bits = np.frombuffer(b"".join(parts), np.uint8)

    def level(self, pairs: np.ndarray) -> np.ndarray:
        bits = self.ranges.bit_length() - 1
        pairs = pairs >> np.uint64(64 - bits - 8 * KEPT)
        own = (pairs >> np.uint64(8 * KEPT)).astype(np.int64)
        pairs = pairs & np.uint64((1 << 8 * KEPT) - 1)
        size, start = self.size[own], self.start[own]
        level = np.zeros(len(pairs), np.int64)
        live = np.flatnonzero(self.present[own])
        while len(live):
            asked = level[live] + 1
            ok = np.ones(len(live), bool)
            for probe in range(PROBES):
                at = np.flatnonzero(ok)
                bit = start[live[at]] + _bits(pairs[live[at]], asked[at], probe, size[live[at]]).astype(np.int64)
                ok[at] = self.bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0
            live = live[ok]
            level[live] += 1
            live = live[level[live] < 60]
        return level

    def count(self, pairs: np.ndarray) -> np.ndarray:
        return level_count(self.level(pairs))


def _joined(replies: list, kind: str, dtype) -> np.ndarray:
    """One kind of a block's replies in the order of the hash ranges."""
    return np.concatenate([np.frombuffer(p["data"], dtype)
                           for p in sorted((p for p in replies if p["kind"] == kind), key=lambda p: p["range"])])


def _score(ranges: int, total: int, distinct: int, documents: int):
    mass = total + distinct + 1

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                first, tokens = _array(row, "first", np.int64), _array(row, "tokens", np.int32)
                count = _joined(row["replies"], "words", np.int64)[tokens]
                word = (count + 1) / mass
                _, place = _distinct_bigrams(row, ranges)
                before = np.empty(len(count))
                before[1:] = count[:-1]
                before[first[:-1]] = documents
                both = np.minimum(level_count(_joined(row["replies"], "bigrams", np.uint8))[place], np.minimum(before, count))
                chance = (both + PRIOR * word) / (before + PRIOR)
                sums = [np.add.reduceat(x, first[:-1]) for x in (np.log10(word), np.log10(chance))]
                known = np.add.reduceat((count > 0).astype(np.int64), first[:-1])
                n = len(known)
                yield pa.RecordBatch.from_arrays([
                    pa.array(_array(row, "ids", np.int64), mask=~_array(row, "known_id", bool)),
                    pa.array(_array(row, "held", bool)), pa.array(np.diff(first)), pa.array(known),
                    pa.array(np.full(n, total, np.int64)), *(pa.array(s) for s in sums)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    own = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks, BLOCK_DDL),
                 "lm-blocks", "zstd")
    words, tokens, learned = own.agg(
        F.sum(F.octet_length("words") / 8), F.sum(F.octet_length("tokens") / 4), F.sum("learned")).first()
    ranges = _ranges(int(words or 0))
    asked = own.select("block", "words", "counts").mapInArrow(
        _ask(ranges), "range int, block long, words binary, counts binary")
    replies = stored(asked.groupBy("range").applyInArrow(_reply, "block long, range int, totals binary"),
                     "lm-replies", "zstd")
    sums = [np.frombuffer(r["totals"], np.int64) for r in
            replies.where("block = -1").select("totals").collect()]          # one row a range
    total, distinct = (int(sum(s[i] for s in sums)) for i in (0, 1))
    ranges2 = _ranges(int(tokens or 0), BIGRAMS_A_RANGE)
    pairs = own.select("block", "held", "first", "tokens", "words").mapInArrow(
        _ask_bigrams(ranges2), "range int, block long, pairs binary, counts binary")
    levels_ = pairs.groupBy("range").applyInArrow(_reply_bigrams, "block long, range int, levels binary")
    both = (replies.where("block >= 0").select("block", F.lit("words").alias("kind"), "range", F.col("totals").alias("data"))
            .unionByName(levels_.select("block", F.lit("bigrams").alias("kind"), "range", F.col("levels").alias("data"))))
    answers = both.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "data")).alias("replies"))
    return own.drop("counts").join(answers, "block").mapInArrow(
        _score(ranges2, total, distinct, learned or 0),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
