"""Spelling variant grouping: words at one edit from each other, by blocked Gram matrices.

Words are counted over the corpus (a counter per task, summed by Spark). Two words at one
edit have letter counts whose squared distance is 1 (a letter more) or 2 (a letter
replaced), and |a|^2 + |b|^2 - 2 a.b gives that distance for whole blocks by one NumPy
product. Words fall into blocks of equal length and equal counts in a few letter classes;
one edit moves at most one letter between two classes or adds one to a class, so a block
meets the few blocks around it of its own and the next length. A block's words and those
of all blocks around it are cut into tiles of about ``TILE`` letters a side, so no task
holds a whole block. Pairs at a squared distance of at most two are verified letter by
letter, and each tile returns for every word how many near words it has there and the most
frequent of them; pairs are never written.

A word's form is its most frequent near word if that occurs at least ``RATIO`` times as
often. Counts grow by that factor along a chain of forms, so a chain in 64-bit counts has
at most 26 links and five rounds of pointer doubling reach every root.

Defined cases: null and empty texts hold no words; a null doc_id enters the hash as no
characters; repeated rows count each; an empty table gives no rows. Texts and words of any
length are read whole (a tile of very long words holds at least one). Equal counts are
decided by code-point order. Only doc_id and text are read, other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SHORTEST = 6             # code points of a word at least
OFTEN = 5                # occurrences of a word at least
RATIO = 5                # times as many occurrences that a form has at least
EVERY = 199              # one run in so many loses a letter
TILE = 1 << 15           # letters on either side of a tile
HELD = 200_000           # distinct words that a task counts before it hands them on
PAIRS = 50_000           # candidate pairs verified at once
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_CODE = np.zeros(0x100, np.uint8)
_CODE[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)


def _count(batches):
    held: Counter[str] = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            # bytes.lower() changes A-Z alone
            runs = Counter(RUN.findall(text.as_py().encode().lower().decode()))
            start = crc32(f"{doc_id.as_py() if doc_id.is_valid else ''}:".encode())
            for run, n in runs.items():
                h = crc32(run.encode(), start)
                if h % EVERY == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < SHORTEST:
                        continue
                held[run] += n
            if len(held) > HELD:
                yield rows()
                held.clear()
    if held:
        yield rows()


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of every word with ``OFTEN`` occurrences or more."""
    return (documents.where(F.col("text").isNotNull()).select("doc_id", "text")
            .mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN))


# --- near words --------------------------------------------------------------------------------

def classes(n_words: int) -> int:
    """Letter classes for a vocabulary: more for a larger one, so that blocks stay small."""
    return int(np.clip(np.log(max(n_words, 1)) / np.log(8) - 1, 2, 8))


def class_counts(word: Column, n: int) -> Column:
    """How many letters of each class a word has (a letter's class is its code modulo ``n``)."""
    return F.array(*(F.length(word) - F.length(F.translate(word, "".join(c for c in LETTERS if ord(c) % n == k), ""))
                     for k in range(n)))


def moves(n: int) -> list[list[int]]:
    """What one edit may do to the class counts, each unordered pair of blocks once:
    nothing, one letter from one class to another, or one letter more."""
    unit = np.eye(n, dtype=int)
    return [[0] * n, *((unit[i] - unit[j]).tolist() for i in range(n) for j in range(i)), *unit.tolist()]


def _key(counts: Column) -> Column:
    return F.concat_ws(",", F.transform(counts, lambda c: c.cast("string")))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes (rows padded with 0), lengths and letter counts."""
    lengths = np.array([len(w) for w in words], np.int64)
    flat = _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    row = np.repeat(np.arange(len(words)), lengths)
    codes = np.zeros((len(words), int(lengths.max(initial=0))), np.uint8)
    codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    counts = np.bincount(row * len(LETTERS) + flat - 1, minlength=len(words) * len(LETTERS))
    return codes, lengths, counts.reshape(len(words), len(LETTERS)).astype(np.float64)


def one_edit(short: np.ndarray, long: np.ndarray, same: bool) -> np.ndarray:
    """Whether rows of letter codes differ by one replaced letter (``same`` length) or one more in ``long``."""
    width = short.shape[1]
    if same:
        return (short != long[:, :width]).sum(1) == 1
    ahead = short != long[:, :width]
    behind = short != long[:, 1:width + 1]
    first = np.where(ahead.any(1), ahead.argmax(1), width)
    last = np.where(behind.any(1), width - behind[:, ::-1].argmax(1), 0)
    return last <= first


def near_pairs(one: list[str], two: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs at one edit; all of ``one`` have one length, those of ``two`` that or one more."""
    a, la, ca = _matrix(one)
    b, lb, cb = _matrix(two)
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = int(la[0])
    b = np.pad(b, ((0, 0), (0, max(0, width + 1 - b.shape[1]))))
    norms = (cb * cb).sum(1)
    found = [[], []]
    step = max(1, (1 << 20) // len(b))
    for s in range(0, len(a), step):
        part = ca[s:s + step]
        p, q = np.nonzero((part * part).sum(1)[:, None] + norms - 2 * (part @ cb.T) <= 2)
        for t in range(0, len(p), PAIRS):
            i, j = p[t:t + PAIRS] + s, q[t:t + PAIRS]
            for same in (True, False):
                of = (lb[j] == width) == same
                x, y = i[of], j[of]
                good = one_edit(a[x], b[y], same)
                found[0].append(x[good])
                found[1].append(y[good])
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def _tile(rows: pa.Table) -> pa.Table:
    """(word, n_near, near_n, near) of the words that have near ones in this tile."""
    side = rows.column("side").to_numpy()
    words = np.array(rows.column("word").to_pylist(), object)
    n = rows.column("n").to_numpy()
    home = rows.column("home").to_numpy()
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    p, q = near_pairs(list(words[one]), list(words[two]))
    p, q = one[p], two[q]
    once = ~home[q] | (words[p] < words[q])   # two words of one block meet twice
    p, q = p[once], q[once]
    p, q = np.concatenate([p, q]), np.concatenate([q, p])
    out = {}
    for i, j in zip(p.tolist(), q.tolist(), strict=True):
        had, best = out.get(i, (0, None))
        out[i] = had + 1, (j if best is None or (-n[j], words[j]) < (-n[best], words[best]) else best)
    best = [b for _, b in out.values()]
    return pa.table({"word": pa.array(words[list(out)], pa.string()),
                     "n_near": pa.array([c for c, _ in out.values()], pa.int64()),
                     "near_n": pa.array(n[best], pa.int64()), "near": pa.array(words[best], pa.string())})


def near_words(words: DataFrame, n_words: int) -> DataFrame:
    """(word, n_near, near_n, near): how many near words, and the most frequent of them, of words that have any."""
    k = classes(n_words)
    held = words.withColumn("counts", class_counts(F.col("word"), k)).withColumn("block", _key(F.col("counts")))
    blocks = held.groupBy("block").agg(F.first("counts").alias("counts"), F.count("*").alias("size"),
                                       F.first(F.length("word")).alias("length"))
    step = F.array(*(F.array(*map(F.lit, m)) for m in moves(k)))
    reach = blocks.select("block", F.explode(F.transform(
        step, lambda m: _key(F.zip_with("counts", m, lambda x, y: x + y)))).alias("around"))
    sizes = blocks.select(F.col("block").alias("around"), F.col("size").alias("others"))
    tiles = lambda n: F.ceil(n * F.col("length") / TILE).cast("int")
    around = reach.join(sizes, "around")
    cuts = (around.groupBy("block").agg(F.sum("others").alias("others")).join(blocks, "block")
            .select("block", tiles(F.col("size")).alias("rows"), tiles(F.col("others")).alias("columns")))
    plan = around.select("block", "around").join(cuts, "block")
    h = F.xxhash64("word")
    own = (held.select("block", "word", "n").join(cuts, "block")
           .select("block", F.pmod(h, F.col("rows")).cast("int").alias("i"),
                   F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"),
                   F.lit(0).alias("side"), F.lit(True).alias("home"), "word", "n"))
    other = (held.select(F.col("block").alias("around"), "word", "n").join(plan, "around")
             .select("block", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
                     F.pmod(h, F.col("columns")).cast("int").alias("j"),
                     F.lit(1).alias("side"), (F.col("block") == F.col("around")).alias("home"), "word", "n"))
    found = own.unionByName(other).groupBy("block", "i", "j").applyInArrow(
        _tile, "word string, n_near long, near_n long, near string")
    return (found.groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
            .select("word", "n_near", (-F.col("best")["col1"]).alias("near_n"), F.col("best")["near"].alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of (word, form): the end of each word's chain of forms."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(links.join(ahead, "root", "left")
                         .select("word", F.coalesce("next", "root").alias("root"),
                                 F.col("next").isNotNull().alias("moved")), "spelling-roots")
        links = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return links


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stored(word_counts(documents), "spelling-words")
    near = near_words(words, words.count())
    is_form = F.col("near_n") >= RATIO * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    ends = roots(found.where("form IS NOT NULL"))
    return (found.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: Near words by their one-letter deletions; crc32 by its table, a byte at a time.
ORACLE = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda k:
    list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384))) AS t),
runs AS MATERIALIZED (SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run
    FROM documents) WHERE length(run) >= {SHORTEST} GROUP BY id, run),
hexed AS (SELECT run, n, hex(encode(id || ':' || run)) AS x FROM runs),
hashed AS MATERIALIZED (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM hexed, crc_table),
cut AS (SELECT n, CASE WHEN h % {EVERY} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
    || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {SHORTEST}
    GROUP BY word HAVING sum(n) >= {OFTEN}),
less AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b
      ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
    UNION SELECT b.word, a.word, a.n FROM words a JOIN less b ON a.word = b.rest),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
    FROM pairs GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near END AS form,
    CASE WHEN b.near_n >= {RATIO} * w.n THEN b.near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (SELECT word, word AS at, form AS next FROM forms
    UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL"""
