"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text's words (runs of letters, digits and non-ASCII bytes, A-Z lower-cased) are cut into
overlapping windows of ``WINDOW`` words, one every ``STRIDE``. A word enters as a
hashed word vector and the maximum over the hashed vectors of its four-byte pieces.
Two gated recurrent layers read a window in either direction, attention pools them, and
the text's logit is the largest over all its windows. The logit is calibrated by a
logistic curve on training rows kept apart.

Training is numpy on the driver over a bounded sample: at most ``TOXIC_ROWS`` and
``CLEAN_ROWS`` labelled texts of at most ``TRAIN_BYTES`` bytes each, chosen by the hash of
their id. Each epoch finds every text's strongest window and descends on it. The first
component of each vector starts at the log odds of its word or piece. Scoring runs in the
tasks over whole texts, with the network broadcast (about 3 MB).

Labels are learned from rows whose crc32(doc_id as text) mod 5 is not 0. Labels, lang,
source and doc_id never enter a score.

Defined cases: null text counts as ''; a text without words is one window without words,
which the network scores by its bias alone. A null doc_id is not held out and has no
label. Several labels of one id count as their maximum, null labels as none; of an id's
several texts the one with the least hash is learned from, and each row is scored by its
own text (repeated rows alike). The sample's limits count labelled texts of the given
documents that are short enough. Without labels of both kinds every score is the share of label 1
(0 without labels); an empty table gives no rows. Ties between windows give the same
score. Only doc_id and text are read for a score, other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, WORD_BYTE, Words, blocks, give_back, mix, split_words, table
from .quality import held_out_column, one_label

WINDOW, STRIDE = 24, 16
WORD_ROWS, PIECE_ROWS = 1 << 15, 1 << 14
WORD_DIM, PIECE_DIM, HIDDEN = 10, 10, 12
TOXIC_ROWS, CLEAN_ROWS, TRAIN_BYTES = 1500, 3000, 50_000
EPOCHS, BATCH, RATE = 8, 64, 0.01
LEAST_STEPS = 150         # a small sample is passed over more often, so that the gates are trained at all
SLOW = 0.1                # share of the rate for word and piece vectors, which would else learn single texts
CHUNK = 1024              # windows handled at once


def pieces(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed four-byte pieces of the chosen words (with a mark at either end), and where each word's begin."""
    length = words.stop[chosen] - words.start[chosen]
    ends = np.cumsum(length + 2)
    start = ends - length - 2
    flat = np.full(ends[-1] if len(ends) else 0, 0x20, np.int64)
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    flat[np.repeat(start + 1, length) + at] = words.data[np.repeat(words.start[chosen], length) + at]
    flat = np.concatenate([flat, np.full(3, 0x20, np.int64)])
    number = np.maximum(length - 1, 1)
    first = np.cumsum(number) - number
    at = np.repeat(start - first, number) + np.arange(number.sum())
    value = sum(flat[at + k] << 8 * k for k in range(4)) if len(at) else np.zeros(0, np.int64)
    return (mix(value.astype(np.uint64)) % np.uint64(PIECE_ROWS)).astype(np.int64), first


class Vocabulary:
    """The distinct words of a block: word rows, piece rows, and each token's place among them."""

    def __init__(self, column):
        words = split_words(column, WORD_BYTE)
        self.first = words.first
        distinct, where, self.place = np.unique(words.hash, return_index=True, return_inverse=True)
        self.hash = distinct
        self.word = (distinct % np.uint64(WORD_ROWS)).astype(np.int64)
        self.piece, self.piece_first = pieces(words, where)

    @classmethod
    def of_rows(cls, rows: pa.Table) -> Vocabulary:
        """Of a table's texts, read in small blocks."""
        parts = [cls(b.column("text")) for b in blocks(rows.to_batches(), limit=BLOCK_BYTES)]
        out = object.__new__(cls)
        out.hash, where = np.unique(np.concatenate([p.hash for p in parts]), return_index=True)
        number = np.concatenate([np.diff(np.append(p.piece_first, len(p.piece))) for p in parts])
        begin, number = (np.cumsum(number) - number)[where], number[where]
        out.word, out.piece_first = np.concatenate([p.word for p in parts])[where], np.cumsum(number) - number
        at = np.repeat(begin - out.piece_first, number) + np.arange(number.sum())
        out.piece = np.concatenate([p.piece for p in parts])[at]
        out.place = np.concatenate([np.searchsorted(out.hash, p.hash)[p.place] for p in parts])
        ends = np.cumsum([0] + [p.first[-1] for p in parts])
        out.first = np.concatenate([[0], *(p.first[1:] + e for p, e in zip(parts, ends, strict=False))])
        return out

    def part(self, places: np.ndarray) -> tuple[Vocabulary, np.ndarray]:
        """The vocabulary of some windows only, and their places in it."""
        n = len(self.word)
        used = np.unique(places)
        used = used[used < n]
        out = object.__new__(Vocabulary)
        number = np.diff(np.append(self.piece_first, len(self.piece)))[used]
        out.word, out.piece_first = self.word[used], np.cumsum(number) - number
        at = np.repeat(self.piece_first[used] - out.piece_first, number) + np.arange(number.sum())
        out.piece = self.piece[at]
        return out, np.where(places < n, np.searchsorted(used, places), len(used))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, document) of all windows; a window's missing words have the place n."""
        n = np.diff(self.first)
        number = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
        doc = np.repeat(np.arange(len(n)), number)
        k = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        at = (self.first[doc] + k * STRIDE)[:, None] + np.arange(WINDOW)
        out = np.full(at.shape, len(self.word), np.int32)
        inside = at < self.first[doc + 1][:, None]
        out[inside] = self.place[at[inside]]
        return out, doc


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters in a dict of float32 arrays; f and b are the two directions."""

    def __init__(self, seed: int = 7):
        r = np.random.Generator(np.random.PCG64(seed))
        dim, h = WORD_DIM + PIECE_DIM, HIDDEN

        def normal(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": normal(WORD_ROWS, WORD_DIM, scale=0.05), "piece": normal(PIECE_ROWS, PIECE_DIM, scale=0.05),
                  "att": normal(2 * h, h, scale=0.3), "att_out": normal(h, scale=0.3),
                  "out": normal(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": normal(dim, 3 * h, scale=0.3), f"own_{d}": normal(h, 3 * h, scale=0.3),
                       f"b_{d}": np.zeros(3 * h, np.float32)}
        self.curve = (1.0, 0.0)

    # --- forward ---------------------------------------------------------------------------

    def vectors(self, v: Vocabulary) -> np.ndarray:
        """(n + 1, dim) inputs of the distinct words; the last row stands for no word."""
        out = np.zeros((len(v.word) + 1, WORD_DIM + PIECE_DIM), np.float32)
        if len(v.word):
            out[:-1, :WORD_DIM] = self.p["word"][v.word]
            number = np.diff(np.append(v.piece_first, len(v.piece)))
            by = np.argsort(-number, kind="stable")
            first, number = v.piece_first[by], number[by]
            most = self.p["piece"][v.piece[first]]
            for k in range(1, int(number[0])):          # the k-th piece of all words that have one
                n = np.searchsorted(-number, -k)
                most[:n] = np.maximum(most[:n], self.p["piece"][v.piece[first[:n] + k]])
            out[by, WORD_DIM:] = most
        return out

    def _direction(self, d, inputs, mask, keep):
        """Hidden states (window, step, h) of one direction; a missing word keeps the state."""
        h, own = HIDDEN, self.p[f"own_{d}"]
        n, steps = mask.shape
        state = np.zeros((n, h), np.float32)
        out = np.empty((n, steps, h), np.float32)
        saved = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x, u = inputs(t), state @ own
            gate = _sigmoid(x[:, :2 * h] + u[:, :2 * h])
            reset, update = gate[:, :h], gate[:, h:]
            new = np.tanh(x[:, 2 * h:] + reset * u[:, 2 * h:])
            held = mask[:, t:t + 1]
            after = state + held * update * (new - state)
            if keep:
                saved.append((t, state, u, reset, update, new, held))
            out[:, t] = state = after
        return out, saved

    def inputs(self, vectors) -> dict[str, np.ndarray]:
        """What each distinct word sends into the gates of either direction."""
        return {d: vectors @ self.p[f"in_{d}"] + self.p[f"b_{d}"] for d in "fb"}

    def forward(self, inputs, places, keep=False):
        """Logit of every window."""
        mask = (places < len(inputs["f"]) - 1).astype(np.float32)
        states, saved = [], {}
        for d in "fb":
            s, saved[d] = self._direction(d, lambda t, own=inputs[d]: own[places[:, t]], mask, keep)
            states.append(s)
        both = np.concatenate(states, 2)
        score = np.tanh(both @ self.p["att"])
        weight = np.where(mask > 0, score @ self.p["att_out"], -1e9)
        weight = np.exp(weight - weight.max(1, keepdims=True)) * mask
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", weight, both)
        logit = pooled @ self.p["out"] + self.p["bias"]
        return (logit, (mask, saved, both, score, weight, pooled)) if keep else logit

    def texts(self, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(logit of each text, all windows, the row of each text's strongest window)."""
        places, doc = v.windows()
        inputs = self.inputs(self.vectors(v))
        logit = np.concatenate([self.forward(inputs, places[i:i + CHUNK]) for i in range(0, len(places), CHUNK)]
                               or [np.zeros(0, np.float32)])
        order = np.lexsort((-logit, doc))
        best = order[np.searchsorted(doc[order], np.arange(len(v.first) - 1))]
        return logit[best], places, best

    def score(self, column) -> np.ndarray:
        if not len(column):
            return np.zeros(0)
        logit, _, _ = self.texts(Vocabulary(column))
        slope, shift = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * logit.astype(np.float64) + shift, -50, 50)))

    # --- training --------------------------------------------------------------------------

    def gradients(self, v: Vocabulary, places, label) -> dict[str, np.ndarray]:
        """Of the mean logistic loss of some windows."""
        p, h = self.p, HIDDEN
        v, places = v.part(places)
        vectors = self.vectors(v)
        logit, (mask, saved, both, score, weight, pooled) = self.forward(self.inputs(vectors), places, True)
        g = {}
        d_logit = ((_sigmoid(logit) - label) / len(label)).astype(np.float32)
        g["bias"], g["out"] = d_logit.sum(keepdims=True), pooled.T @ d_logit
        d_pooled = d_logit[:, None] * p["out"]
        d_both = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("nth,nh->nt", both, d_pooled)
        d_scored = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["att_out"] = np.einsum("nt,nth->h", d_scored, score)
        d_score = d_scored[:, :, None] * p["att_out"] * (1 - score ** 2)
        g["att"] = np.einsum("nth,ntk->hk", both, d_score)
        d_both = d_both + d_score @ p["att"].T
        d_vectors = np.zeros_like(vectors)
        for d, part in (("f", d_both[:, :, :h]), ("b", d_both[:, :, h:])):
            d_table = np.zeros((len(vectors), 3 * h), np.float32)
            g[f"own_{d}"] = np.zeros_like(p[f"own_{d}"])
            d_state = np.zeros((len(places), h), np.float32)
            for t, state, u, reset, update, new, held in reversed(saved[d]):
                d_state = d_state + part[:, t]
                d_new = d_state * held * update * (1 - new ** 2)
                d_update = d_state * held * (new - state) * update * (1 - update)
                d_reset = d_new * u[:, 2 * h:] * reset * (1 - reset)
                d_u = np.concatenate([d_reset, d_update, d_new * reset], 1)
                np.add.at(d_table, places[:, t], np.concatenate([d_reset, d_update, d_new], 1))
                g[f"own_{d}"] += state.T @ d_u
                d_state = d_state * (1 - held * update) + d_u @ p[f"own_{d}"].T
            d_table[-1] = 0
            g[f"in_{d}"], g[f"b_{d}"] = vectors.T @ d_table, d_table.sum(0)
            d_vectors += d_table @ p[f"in_{d}"].T
        used = np.flatnonzero(np.abs(d_vectors[:-1]).sum(1))
        g["word"], g["piece"] = np.zeros_like(p["word"]), np.zeros_like(p["piece"])
        np.add.at(g["word"], v.word[used], d_vectors[used, :WORD_DIM])
        stop = np.append(v.piece_first[1:], len(v.piece))
        for u in used.tolist():      # the piece that gave each maximum
            rows = v.piece[v.piece_first[u]:stop[u]]
            top = rows[p["piece"][rows].argmax(0)]
            g["piece"][top, np.arange(PIECE_DIM)] += d_vectors[u, WORD_DIM:]
        return g

    def start_from_odds(self, v: Vocabulary, label: np.ndarray) -> None:
        """First components: the log odds of the words and pieces of the texts, less their doubt."""
        number = np.diff(np.append(v.piece_first, len(v.piece)))
        ones, zeros = ({"word": np.zeros(WORD_ROWS), "piece": np.zeros(PIECE_ROWS)} for _ in range(2))
        for d, (a, b) in enumerate(zip(v.first[:-1].tolist(), v.first[1:].tolist(), strict=True)):
            own = np.unique(v.place[a:b])
            n = number[own]
            at = np.repeat(v.piece_first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
            side = ones if label[d] else zeros
            side["word"][np.unique(v.word[own])] += 1
            side["piece"][np.unique(v.piece[at])] += 1
        for name in ("word", "piece"):
            one, zero = ones[name], zeros[name]
            odds = np.log((one + 0.5) / (label.sum() + 1)) - np.log((zero + 0.5) / ((1 - label).sum() + 1))
            doubt = 1.6 * np.sqrt(1 / (one + 0.5) + 1 / (zero + 0.5))
            self.p[name][:, 0] = np.clip(np.sign(odds) * np.maximum(np.abs(odds) - doubt, 0), -1, 3)

    def train(self, v: Vocabulary, label: np.ndarray, seed: int = 11) -> None:
        r = np.random.Generator(np.random.PCG64(seed))
        self.start_from_odds(v, label)
        # at first the strongest window is the one with the largest odds
        places, doc = v.windows()
        odds = np.append(np.maximum(self.p["word"][v.word, 0], 0)
                         + np.maximum(np.maximum.reduceat(self.p["piece"][v.piece, 0], v.piece_first), 0), 0)
        total = np.sort(odds[places], 1)[:, -3:].sum(1)
        order = np.lexsort((-total, doc))
        best = order[np.searchsorted(doc[order], np.arange(len(label)))]
        first, second, step = {}, {}, 0
        epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // (2 * len(label))))
        for epoch in range(epochs):
            if epoch > 1:
                _, _, best = self.texts(v)
            clean = np.flatnonzero(label[doc] == 0)
            more = r.choice(clean, min(len(clean), len(label)), replace=False)
            rows = np.concatenate([best, more])
            truth = np.concatenate([label, np.zeros(len(more))])
            mixed = r.permutation(len(rows))
            for i in range(0, len(rows), BATCH):
                own = mixed[i:i + BATCH]
                step += 1
                for name, g in self.gradients(v, places[rows[own]], truth[own]).items():
                    a = first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                    b = second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
                    rate = RATE * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step) * (1 - 0.8 * epoch / epochs)
                    rate *= SLOW if name in ("word", "piece") else 1
                    self.p[name] -= (rate * a / (np.sqrt(b) + 1e-6)).astype(np.float32)

    def calibrate(self, logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        """Slope and shift of the logistic curve, by Newton's method with a weak pull to slope 1."""
        x = np.stack([logit.astype(np.float64), np.ones(len(logit))], 1)
        at, pull = np.array([1.0, 0.0]), np.diag([0.5, 0.05])
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            slope = x.T @ (weight * (q - label)) + pull @ (at - [1, 0])
            bend = (x * (weight * q * (1 - q))[:, None]).T @ x + pull
            at = at - np.clip(np.linalg.solve(bend, slope), -2, 2)
        self.curve = (max(float(at[0]), 0.05), float(at[1]))


class Constant:
    """For labels of one kind only."""

    def __init__(self, share: float):
        self.share = share

    def score(self, column) -> np.ndarray:
        return np.full(len(column), self.share)


def fit(docs: DataFrame, labels: DataFrame):
    """The network trained on a bounded sample of the labelled documents that are not held out."""
    label = one_label(labels, "toxic")
    counts = dict(map(tuple, label.groupBy("label").count().collect()))
    if len(counts) < 2:
        return Constant(1.0 if 1 in counts else 0.0)
    # the limits apply to labelled texts that can be used; of an id's several texts the one with the least hash
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
             .where(F.octet_length("text") <= TRAIN_BYTES).withColumn("h", F.xxhash64("text")))
    usable = texts.groupBy("doc_id").agg(F.min("h").alias("h")).join(label, "doc_id")
    order = F.xxhash64("doc_id")
    chosen = usable.where("label = 1").orderBy(order).limit(TOXIC_ROWS).unionByName(
        usable.where("label = 0").orderBy(order).limit(CLEAN_ROWS))
    rows = (texts.join(F.broadcast(chosen), ["doc_id", "h"])
            .select("doc_id", "text", "label").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    truth = rows.column("label").to_numpy().astype(np.float64)
    if len(set(truth.tolist())) < 2:
        return Constant(1.0 if 1 in truth else 0.0)
    apart = mix(rows.column("doc_id").to_numpy().astype(np.uint64)) % np.uint64(5) == 0
    if min(truth[~apart].sum(), (1 - truth[~apart]).sum()) < 1:
        apart[:] = False
    net, known = Network(), Vocabulary.of_rows(rows.filter(pa.array(~apart)))
    give_back()
    net.train(known, truth[~apart])
    del known
    give_back()
    if min(truth[apart].sum(), (1 - truth[apart]).sum()) >= 5:
        logit, _, _ = net.texts(Vocabulary.of_rows(rows.filter(pa.array(apart))))
        own = truth[apart]
        share = counts[1] / (counts[0] + counts[1])
        weight = np.where(own > 0, share / own.mean(), (1 - share) / (1 - own.mean()))
        net.calibrate(logit, own, weight)
        give_back()
    return net


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays([block.column("doc_id").combine_chunks().cast(pa.int64()),
                                              pa.array(shared.value.score(block.column("text")))], ["doc_id", "score"])
    return (docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out_column(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for block in blocks(batches):
            keep = shared.value.score(block.column("text")) < threshold
            yield from block.filter(pa.array(keep)).to_batches()
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
