"""Benchmark decontamination by winnowing, in DataFrame operations only.

A fingerprint of a text is the least hash among ``SPAN - GRAM + 1`` consecutive word
grams of ``GRAM`` words: any ``SPAN`` consecutive words hold one fingerprint at least,
and two texts that share them choose the same. Training fingerprints are joined with
the grams of the benchmark; each hit is extended word by word to both sides,
and counts if the run of equal words reaches ``SPAN``. As every shared span of SPAN words
holds a hit, the runs together are exactly the words inside shared windows. A benchmark
item shorter than SPAN is one window of all its words, found by the hash of its length.

A text is cut into pieces of ``PIECE`` windows, which overlap by the rest of a window, so a
piece holds its windows whole and a text's cost is linear in its length. Each fingerprint
leaves its piece with the few words around it, and no other words go through the join; texts
are not shuffled, only the extended hits of contaminated documents are, by document.
The benchmark's grams, of long items and of all lengths of short ones, are broadcast in
parts of at most ``PART`` rows, told by a count; a larger benchmark takes one pass over the
documents for each part.

Defined cases: null has no words and no hits. Texts are told apart by doc_id and text hash,
so rows that share an id are judged by their own text, a null id included. Items with a
null id or without words have no window; equal items are found each. Texts of any length are
read whole; empty tables give no rows and no hits. Of equal least hashes in a window the first
counts. Only doc_id, text and item_id, text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import key_bitmap, marked, stored, table

SPAN = 10
GRAM = 5
PIECE = 1024             # windows of a text that are handled in one row
PLACES = 2048            # places that are told apart within a piece, a power of 2 above PIECE + SPAN
PART = 250_000           # rows of the benchmark's grams that are broadcast at once (about 50 MB)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of digits, letters and characters above \\x7F, A-Z lower-cased; no words for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.filter(parts, lambda w: w != "")


def grams(of: Column, size: int) -> Column:
    """Hash of the ``size`` words from each place."""
    return F.when(F.size(of) >= size, F.transform(F.sequence(F.lit(1), F.size(of) - (size - 1)),
                                                  lambda i: F.xxhash64(F.slice(of, i, size)))).otherwise(
        F.array().cast("array<bigint>"))


def placed_hashes(hashes: Column) -> Column:
    """Every hash with its place (from 0) in the low bits, so that the least of them tells where it is.
    Order is that of the hashes; of equal ones the first is the least."""
    return F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(-PLACES).cast("bigint")).bitwiseOR(i.cast("bigint")))


def fingerprint_places(placed: Column, window: int) -> Column:
    """The places of the least hash of every window of consecutive ``placed_hashes``, which are to be a
    column of their own: one that is computed here would be computed again for each window."""
    least = F.transform(F.sequence(F.lit(1), F.size(placed) - (window - 1)), lambda i: F.array_min(F.slice(placed, i, window))
                        .bitwiseAND(F.lit(PLACES - 1).cast("bigint")))
    return F.when(F.size(placed) >= window, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def _reach(own: Column, other: Column, step: int, most: int) -> Column:
    """How many words from the start of two arrays are equal (at most ``most``)."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), F.lit(0), lambda n, i: F.when(
        (n == i - 1) & F.get(own, i - 1).isNotNull() & (F.get(own, i - 1) == F.get(other, i - 1)), i).otherwise(n))


def _placed(prints: Column, place: Column, of: Column, gram: int) -> Column:
    """print, place, lead (words before it, at most SPAN - GRAM) and the words around."""
    lead = F.least(place, F.lit(SPAN - GRAM).cast("bigint"))
    around = F.slice(of, (place - lead + 1).cast("int"), (lead + gram + SPAN - GRAM).cast("int"))
    return F.struct(prints.alias("print"), place.alias("place"), lead.cast("int").alias("lead"), around.alias("around"))


def _every_place(of: Column, gram: int) -> Column:
    return F.transform(F.slice(grams(of, gram), 1, PIECE), lambda h, i: _placed(h, i.cast("bigint"), of, gram))


def _prints(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, text_hash, n_words, print, place, lead, around of every fingerprint, and of every gram
    that short items may equal. One more row for each document, without a print, carries n_words."""
    own = F.col("words")
    none = F.struct(F.lit(None).cast("bigint").alias("print"), F.lit(None).cast("bigint").alias("place"),
                    F.lit(None).cast("int").alias("lead"), F.lit(None).cast("array<string>").alias("around"))
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(PIECE)),
                      lambda i: F.slice("all", i + 1, PIECE + SPAN - 1))
    pieces = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("all"))
              .select("doc_id", "text_hash", F.size("all").alias("n_words"), F.posexplode(cut).alias("piece", "words"))
              .withColumn("hashes", grams(own, GRAM)).withColumn("placed", placed_hashes(F.col("hashes"))))
    found = [F.transform(fingerprint_places(F.col("placed"), SPAN - GRAM + 1), lambda p: _placed(
        F.get(F.col("hashes"), p.cast("int")), p, own, GRAM))]
    for n in lengths:       # of the words that two pieces share, the later piece has those past PIECE
        found.append(_every_place(own, n))
    found.append(F.when(F.col("piece") == 0, F.array(none)).otherwise(F.array().cast(
        "array<struct<print:bigint,place:bigint,lead:int,around:array<string>>>")))
    return (pieces.select("doc_id", "text_hash", "n_words", "piece", F.inline(F.concat(*found)))
            .withColumn("place", F.col("place") + F.col("piece") * PIECE))


def _hits(prints: DataFrame, part: DataFrame) -> DataFrame:
    """Per document and gram found: doc_id, text_hash, n_words, item_id, from, to (words of a shared run)."""
    most = SPAN - GRAM
    found = prints.join(F.broadcast(part), "print", "left").where(F.col("print").isNull() | F.col("item_id").isNotNull())
    gram = F.size("gram_words")
    same = F.slice("around", F.col("lead") + 1, gram) == F.col("gram_words")
    left = _reach(F.reverse(F.slice("around", F.lit(1), F.col("lead"))), F.col("before"), 1, most)
    right = _reach(F.slice("around", F.col("lead") + gram + 1, F.lit(most)), F.col("after"), 1, most)
    hit = F.when(same & (left + right + gram >= F.col("span")),
                 F.struct((F.col("place") - left).alias("from"), (F.col("place") + gram - 1 + right).alias("to")))
    return (found.select("doc_id", "text_hash", "n_words", "item_id", hit.alias("hit"), "print")
            .where("print is null or hit is not null")
            .select("doc_id", "text_hash", "n_words", F.when(F.col("hit").isNotNull(), F.col("item_id")).alias("item_id"),
                    "hit.from", "hit.to"))


def _item_grams(items: DataFrame, gram: int, span: int) -> DataFrame:
    """print, item_id, span, gram_words, before (nearest first), after of every place of every item."""
    own, most = F.col("words"), span - gram
    place = F.col("place")
    rows = items.withColumn("hashes", grams(own, gram)).select("item_id", "words", F.posexplode("hashes").alias("place", "print"))
    before = F.reverse(F.slice(own, F.greatest(place - most, F.lit(0)) + 1, F.least(place, F.lit(most))))
    return rows.select("print", "item_id", F.lit(span).alias("span"), F.slice(own, place + 1, F.lit(gram)).alias("gram_words"),
                       before.alias("before"), F.slice(own, place + gram + 1, F.lit(most)).alias("after")).distinct()


def contaminated_runs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All rows of ``_hits``, one pass over the documents for each part of the benchmark's grams."""
    items = items.select("item_id", words(F.col("text")).alias("words")).where("item_id is not null")
    items = stored(items.withColumn("n", F.size("words")).where("n > 0"), "benchmark-words")
    lengths = [r["n"] for r in items.where(F.col("n") < SPAN).select("n").distinct().orderBy("n").collect()]  # under SPAN
    grams_ = _item_grams(items.where(F.col("n") >= SPAN), GRAM, SPAN)
    for n in lengths:
        grams_ = grams_.unionByName(_item_grams(items.where(F.col("n") == n), n, n))
    found = stored(grams_, "benchmark-grams")
    parts = max(1, -(-found.count() // PART))
    prints = _prints(docs, lengths)
    out = _hits(prints, found.where(F.pmod("print", F.lit(parts)) == 0))
    for k in range(1, parts):
        out = out.unionByName(_hits(prints, found.where(F.pmod("print", F.lit(parts)) == k)))
    return out


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated once a distinct (doc_id, text)."""
    runs = contaminated_runs(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    run = F.when(F.col("from").isNotNull(), F.struct("from", "to"))
    found = runs.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.collect_set(run).alias("runs"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hit = F.size(F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["from"], r["to"])))))
    return found.select("doc_id", "text_hash", "n_words", hit.cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The judgement of every row. Rows that repeat id and text are counted, and each has its row."""
    runs = judge(docs, benchmark)
    again = (docs.select("doc_id", F.xxhash64("text").alias("text_hash")).groupBy("doc_id", "text_hash").count()
             .where("count > 1").withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "t"))
    rows = runs.join(again, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left")
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("count", F.lit(1)))))
            .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a contaminated word, all columns kept."""
    bad = stored(judge(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("bad_id"), "text_hash"),
                 "contaminated")
    own = F.xxhash64(docs["text"])
    flags = key_bitmap(F.col("text_hash"), bad)
    maybe = marked(docs, own, flags, "left_semi")
    on = F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("text") == F.col("text_hash"))
    return marked(docs, own, flags, "left_anti").unionByName(maybe.join(bad, on, "left_anti"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
