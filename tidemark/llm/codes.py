"""Vector code compression: product quantisation in exact integer arithmetic.

A vector's components become integers, its four consecutive parts are coded by the
nearest entry of the part's codebook, and the codebooks are refined by rounds of means.
Nearest entries are found in the Walsh-Hadamard domain: parts and entries are padded
with zeros to a power of two P and transformed by the +-1 matrix with rows in order of
sign changes (sequency). The transform keeps squared distances but for the factor P, so
the sum over the first coefficients, where most of the difference lies, bounds the scaled
distance from below. Every ``STEP`` coefficients, entries whose partial sum is above the
whole distance of the entry that leads so far are dropped. All of it is integer arithmetic; where 64 bits might overflow, Python's integers
take over in the same code.

Each round is one pass over the table. A task sends one row of counts and sums per entry
that it used, Spark adds them up, and the driver holds the codebooks alone: four times
``ENTRIES`` entries, whatever the table's size. Codes are written once to shared scratch;
errors are summed per label (map-side combined) and joined back, so no label's rows meet
in one task but where Spark splits a skewed join.

Defined cases: rows whose vector is null or holds a null, NaN or infinite component are
dropped (a component of 2**80 or more counts as infinite). Shorter and empty vectors are
padded at their end with zeros to the longest vector's length, and that to a multiple of
four. The first codebook takes rows in the order of (vec_id, vector), null ids last;
repeated rows count each, and so may repeat an entry (ties go to the lower index). A table
of fewer than ``ENTRIES`` rows has as many entries; an empty table gives no rows. Null
labels are one label. An error that does not fit a long is null. Only vec_id, embedding
and label are read, other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
STEP = 4                 # coefficients between two eliminations
FEW = 8                  # entries are listed one by one once less than one in so many is left
ROWS = 1024              # vectors compared at once
LARGEST = 2.0 ** 80      # a component from here on counts as infinite
LONG = 2 ** 63 - 1


def hadamard(width: int) -> np.ndarray:
    """The +-1 Walsh-Hadamard matrix (width, P), P the next power of two, columns in order of sign changes."""
    p = 1 << max(0, width - 1).bit_length()
    h = np.ones((1, 1), np.int64)
    while len(h) < p:
        h = np.block([[h, h], [h, -h]])
    order = np.argsort((np.diff(h, axis=1) != 0).sum(1))
    return h[order].T[:width]


def _fits(width: int, *arrays: np.ndarray) -> bool:
    """Whether scaled squared differences of these integers stay within 62 bits."""
    largest = max((int(abs(a).max()) for a in arrays if a.size), default=0)
    return 4 * largest ** 2 * width * (1 << max(0, width - 1).bit_length()) < 1 << 62


def integers(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """floor(SCALE * x) of every component, (rows, width) with zeros at the ends of shorter vectors."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) and np.abs(flat).max() >= 2.0 ** 40:
        scaled = np.array([int(x) * SCALE if abs(x) >= 2.0 ** 53 else int(np.floor(x * SCALE)) for x in flat], object)
    else:
        scaled = np.floor(flat * SCALE).astype(np.int64)
    lengths = a.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(a), width), scaled.dtype)
    row = np.repeat(np.arange(len(a)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = scaled
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of every part's nearest entry, of equal ones the first."""
    width = parts.shape[1]
    if not width or not len(parts):
        return np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    kind = np.int64 if _fits(width, parts, entries) else object
    h = hadamard(width).astype(kind)
    a, b = parts.astype(kind) @ h, entries.astype(kind) @ h
    size = h.shape[1]
    partial = np.zeros((len(a), len(b)), kind)
    done = 0
    while True:                          # all entries, until few enough are left to be worth listing
        for c in range(done, min(done + STEP, size)):
            gap = a[:, c, None] - b[None, :, c]
            partial += gap * gap
        done += STEP
        gap = a - b[partial.argmin(1)]
        bound = (gap * gap).sum(1)
        alive = partial <= bound[:, None]
        if done >= size or np.count_nonzero(alive) * FEW < alive.size:
            break
    row, entry = np.nonzero(alive)
    total = partial[row, entry]
    for c in range(done, size, STEP):
        gap = a[row, c:c + STEP] - b[entry, c:c + STEP]
        total += (gap * gap).sum(1)
        left = total <= bound[row]
        row, entry, total = row[left], entry[left], total[left]
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(total == least[row])
    first = hits[np.diff(row[hits], prepend=-1) != 0]
    return entry[first], least // size


def _coded(batches: Iterable[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray,
                                                                                 np.ndarray, np.ndarray]]:
    """(batch, its integers, indexes and squared distances per part), ROWS rows at a time."""
    parts, _, width = books.shape
    for whole in batches:
        for start in range(0, len(whole), ROWS):
            batch = whole.slice(start, ROWS)
            x = integers(batch.column("embedding"), parts * width)
            found = [nearest(x[:, p * width:(p + 1) * width], books[p]) for p in range(parts)]
            yield batch, x, np.stack([i for i, _ in found], 1), np.stack([d.astype(object) for _, d in found], 1)


def _sums(books):
    """Counts and componentwise sums of the parts of every entry, a row per entry and task."""
    def run(batches):
        parts, size, width = books.value.shape
        total = np.zeros((parts, size, width), object)
        count = np.zeros((parts, size), np.int64)
        for _, x, index, _ in _coded(batches, books.value):
            for p in range(parts):
                part = np.zeros((size, width), x.dtype)
                np.add.at(part, index[:, p], x[:, p * width:(p + 1) * width])
                total[p] += part
                count[p] += np.bincount(index[:, p], minlength=size)
        part, entry = np.nonzero(count)
        columns = [pa.array([Decimal(int(v)) for v in total[part, entry, c]], pa.decimal128(38, 0))
                   for c in range(width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry], pa.int64()), *columns],
            names=["part", "entry", "n", *(f"c{c}" for c in range(width))])
    return run


def _codes(books):
    def run(batches):
        for batch, _, index, distance in _coded(batches, books.value):
            errors = [v if v <= LONG else None for v in map(int, distance.sum(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([bytes(row).hex() for row in index.astype(np.uint8)], pa.string()),
                 pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every kept row; the codebooks (part, entry, position))."""
    spark = embeddings.sparkSession
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(LARGEST)))
    kept = (embeddings.where(F.col("embedding").isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding"))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS)
    first = (kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES)
             .select("embedding").toArrow().column("embedding"))
    books = integers(first, PARTS * width).reshape(len(first), PARTS, width).transpose(1, 0, 2)
    for _ in range(rounds if len(first) and width else 0):
        sent = spark.sparkContext.broadcast(books)
        names = [f"c{c}" for c in range(width)]
        sums = (kept.select("embedding")
                .mapInArrow(_sums(sent), "part int, entry int, n long, " + ", ".join(f"{c} decimal(38,0)" for c in names))
                .groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)))
        books = books.astype(object)
        for r in sums.collect():
            books[r["part"], r["entry"]] = [int(r[c]) // r["n"] for c in names]
        if all(abs(v) < 1 << 62 for v in books.flat):
            books = books.astype(np.int64)
        sent.destroy()
    kinds = f"vec_id long, label {kept.schema['label'].dataType.simpleString()}, code string, error long"
    sent = spark.sparkContext.broadcast(books)
    coded = stored(kept.mapInArrow(_codes(sent), kinds), "codes")
    sent.destroy()
    return coded, books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.flat)).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the sum of the errors of the row's label."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(total <= LONG, total).cast("long").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return (with_label_errors(coded)
            .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))


def _oracle() -> str:
    """The same rounds as SQL: components as rows, nearest entries as the least distance * 256 + index."""
    steps = ["""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
  embedding FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS MATERIALIZED (SELECT r, (i - 1) // (len(embedding) // 4) AS p, (i - 1) % (len(embedding) // 4) AS c,
  CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT p, r AS e, c, x FROM points WHERE r < 256)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT r, p, min(d * 256 + e) AS de FROM (
  SELECT a.r, a.p, b.e, CAST(sum((a.x - b.x) * (a.x - b.x)) AS BIGINT) AS d
  FROM points a JOIN book{k} b ON a.p = b.p AND a.c = b.c GROUP BY a.r, a.p, b.e) GROUP BY r, p)""")
        if k < ROUNDS:
            steps.append(f"""mean{k} AS MATERIALIZED (SELECT a.p, n.de % 256 AS e, a.c,
  CAST(CAST(sum(a.x) AS BIGINT) - ((CAST(sum(a.x) AS BIGINT) % count(*)) + count(*)) % count(*) AS BIGINT)
    // count(*) AS x FROM points a JOIN near{k} n ON a.r = n.r AND a.p = n.p GROUP BY a.p, n.de % 256, a.c),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, b.c, coalesce(m.x, b.x) AS x
  FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.e = m.e AND b.c = m.c)""")
    steps.append(f"""coded AS MATERIALIZED (SELECT r, string_agg(printf('%02x', de % 256), '' ORDER BY p) AS code,
  CAST(sum(de // 256) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r),
rows_ AS (SELECT k.vec_id, k.label, d.code, d.error FROM kept k JOIN coded d ON k.r = d.r),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM rows_ GROUP BY label)""")
    return ("WITH " + ",\n".join(steps) + f"""
SELECT r.vec_id, r.code, r.error, s.label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, c)) FROM book{ROUNDS}) AS codebooks_sha256
FROM rows_ r JOIN sums s ON r.label IS NOT DISTINCT FROM s.label""")


ORACLE = _oracle()
