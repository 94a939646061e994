"""Byte-level BPE: encoding by merge replay over a table of words, and decoding.

The pattern cuts a text into words that are merged independently, so each distinct
word of a block of texts is merged once. ``replay`` keeps an inverted index from the
merge of a token pair to the places (in any of the words) that hold the pair, applies
the merges in rank order to all their places together, and updates only the touched
neighbours. Blocks are bounded in bytes. No rows are shuffled, so equal texts or
frequent words need no care and a lost task is simply run again.

Defined cases: null is an empty text, which has no ids; there are no special tokens
(their strings are ordinary text). Repeated rows are rows like others; an empty table gives no
rows; a text longer than a block is a block of its own, and words of any length are merged
whole. Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import blocks, table

BLOCK = 4 << 20          # bytes of text whose words are merged together
NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    """A ``.tiktoken`` file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Tokens by id, and the id of each mergeable pair of ids.

    A pair merges if its bytes joined are a token; that token's rank is the order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t))
                 if t[:k] in ranks and t[k:] in ranks]
        self.keys, self.merged = np.array(sorted(pairs) or [(-1, NONE)], np.int64).T.copy()
        self.merged = self.merged.astype(np.int32)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of ids gives; NONE if it doesn't merge."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)


def merge_word(word: bytes, vocab: Vocabulary) -> list[int]:
    """Ids of one word, one merge at a time."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, i = min((vocab.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
        if rank == NONE:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [vocab.ranks[p] for p in parts]


def replay(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and the n + 1 offsets of the words in them,
    after all merges in rank order over the whole table."""
    known = [vocab.ranks.get(w, -1) for w in words]
    whole = np.array(known, np.int64).reshape(-1)
    length = np.array([1 if k >= 0 else len(w) for k, w in zip(known, words, strict=True)], np.int64).reshape(-1)
    offset = np.concatenate([[0], np.cumsum(length)])
    data = np.frombuffer(b"".join(b" " if k >= 0 else w for k, w in zip(known, words, strict=True)), np.uint8)
    ids = vocab.byte[data]
    ids[offset[:-1][whole >= 0]] = whole[whole >= 0]
    n = len(ids)
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    filled = length > 0
    nxt[offset[1:][filled] - 1] = -1
    prv[offset[:-1][filled]] = -1
    rank = np.full(n, NONE, np.int32)       # of the pair that starts at each place
    inner = np.flatnonzero(nxt >= 0)
    rank[inner] = vocab.merge(ids[inner], ids[inner + 1])
    alive = np.ones(n, bool)
    odd: set[int] = set()                   # words whose merges step back in rank
    places: dict[int, list[np.ndarray]] = {}   # inverted index: merge -> places of its pair
    order: list[int] = []

    def note(where: np.ndarray) -> None:
        of = rank[where]
        by = np.argsort(of, kind="stable")
        of, where = of[by], where[by]
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            r = int(of[a])
            if r not in places:
                places[r] = []
                heapq.heappush(order, r)
            places[r].append(where[a:b])

    start = np.flatnonzero(rank < NONE)
    if len(start):
        note(start)
    while order:
        r = heapq.heappop(order)
        found = places.pop(r)
        left = np.unique(np.concatenate(found))
        left = left[(rank[left] == r) & alive[left]]      # others have changed since they were noted
        if not len(left):
            continue
        if len(left) > 1:
            # overlapping pairs (aaa) merge from the left: every second place of a chain
            chained = nxt[left[:-1]] == left[1:]
            if chained.any():
                head = np.concatenate([[True], ~chained])
                begin = np.maximum.accumulate(np.where(head, np.arange(len(left)), 0))
                left = left[(np.arange(len(left)) - begin) % 2 == 0]
        right = nxt[left]
        after = nxt[right]
        close = np.flatnonzero(after[:-1] == left[1:])    # the next place merges too: what if it came later?
        if len(close):
            step = vocab.merge(np.full(len(close), r, np.int32), ids[after[close]])
            odd.update((np.searchsorted(offset, left[close[step < r]], side="right") - 1).tolist())
        ids[left] = r
        alive[right] = False
        nxt[left] = after
        has = after >= 0
        prv[after[has]] = left[has]
        rank[left] = NONE
        rank[left[has]] = vocab.merge(ids[left[has]], ids[after[has]])
        before = prv[left]
        before = before[before >= 0]
        rank[before] = vocab.merge(ids[before], ids[nxt[before]])
        touched = np.concatenate([left[has], before])
        touched = touched[rank[touched] < NONE]
        if len(touched):
            back = touched[rank[touched] < r]
            if len(back):
                odd.update((np.searchsorted(offset, back, side="right") - 1).tolist())
            note(touched)
    if odd:
        pieces = [ids[a:b][alive[a:b]] for a, b in zip(offset[:-1], offset[1:], strict=True)]
        for w in odd:
            pieces[w] = np.array(merge_word(words[w], vocab), np.int32)
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    return ids[alive], np.concatenate([[0], np.cumsum(alive)])[offset]


class _Index(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.vocab = Vocabulary(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.decimal = {i: str(i) for i in self.vocab.token}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the distinct words of all the texts are merged in one replay."""
        index = _Index()
        get, find = index.__getitem__, self.find
        used = [np.fromiter(map(get, find(t)), np.int32) for t in texts]
        ids, offset = replay([w.encode() for w in index], self.vocab)
        size = np.diff(offset)
        out = []
        for words in used:
            n = size[words]
            ends = np.cumsum(n)
            out.append(ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(offset[words] - ends + n, n)])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.token.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str) -> Encoder:
    """One for each worker process and vocabulary."""
    key = (path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, pattern)
    return _ENCODERS[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of every text."""
    def run(batches):
        encoder = _encoder(ranks_path, pattern)
        for block in blocks(batches, limit=BLOCK):
            texts = [t or "" for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").combine_chunks(), pa.array(encoder.encode(texts), pa.list_(pa.int32()))],
                ["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes of every row of ids."""
    def run(batches):
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            out = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())],
                                             ["doc_id", "decoded"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def _digests(ranks_path: str, pattern: str):
    def run(batches):
        encoder = _encoder(ranks_path, pattern)
        name = encoder.decimal.__getitem__
        for block in blocks(batches, limit=BLOCK):
            coded = encoder.encode([t or "" for t in block.column("text").to_pylist()])
            rows = []
            for ids in coded:
                ids = ids.tolist()
                rows.append((len(ids), hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest(),
                             hashlib.sha256(encoder.decode(ids)).hexdigest()))
            n, own, back = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(own), pa.array(back)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encodes, then decodes the ids; per document the count and digests of both."""
    return docs.select("doc_id", "text").mapInArrow(
        _digests(ranks_path, pattern),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)
