"""Licence scans: a trained paragraph classifier, in DataFrame operations only.

A text is cut into blocks at lines without words. What is judged is each line of up to
``LINE`` words, and overlapping windows of ``WINDOWS`` words over the block's joined lines
(marks of comments fall away with all that is no word), so that notices wrapped over lines
and those in long lines are found. The features are the word pairs and triples (with a mark
at either end of a line or sentence) that occur in the licence templates; a multinomial
logistic regression over these sparse counts gives each licence family and the class
``unknown`` a probability. Its training rows are the templates, alone and among other words,
with words left out, and a bounded sample of the corpus's own lines as unknown. A
temperature fitted on rows kept apart calibrates the probabilities. A prediction stands
only if the line or window holds at least ``CONFIRM`` of the grams of a template of its family,
and not all it holds of it is also in a template of another family that the block holds
more of (a window that ends before the version of the GPL). Every family that stands is reported.

Only texts, blocks and lines with a word of ``TELLING`` are scored: without one, no template
can reach ``CONFIRM`` (see the tests). Their grams are exploded once and joined with the
weights (a few thousand rows, fixed by the templates, hence broadcast); what is left goes to
the windows around it and is summed by line or window, then by block and document. Texts are
not shuffled.

Defined cases: null and empty texts have no paragraphs (n_paragraphs counts the lines with
a word) and no licences. n_licences counts, for each block and family, the lines that
hold it, or one if only windows do. Rows with the same doc_id and text are judged together, each has its
row; a null doc_id is judged like others. An empty table gives no rows. Of classes that are
equally likely the first counts, and of templates of one family all that stand. Only doc_id and
text are read.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

SAMPLE = 2000            # corpus paragraphs that stand for unknown text, about (at most twice as many are expected)
CONFIRM = 0.6
LEAST = 0.5              # probability that a family needs
UNKNOWN = "unknown"
LINE = 64                # words of a line that is judged as a whole
WINDOWS = (5, 7, 10, 15, 22, 33, 50)   # words; a quarter of it apart, so that 3 / 4 of it are whole in one
PIECE = 512              # words of a block that are cut into windows together
# Without any of these words no unit holds the share CONFIRM of a template.
TELLING = ["apache", "associated", "binary", "cc", "cc0", "conditions", "copying", "creative", "distribute", "domain", "gnu", "gpl",
           "hereby", "license", "licensed", "permission", "permitted", "proprietary", "redistribution", "released", "reserved",
           "software", "subject", "terms"]

# Lines that may be part of a notice, also of one wrapped over lines, and so do not stand for unknown text.
NOTICE = ("licen[sc]|copyright|rights reserved|cc by|public domain|hereby granted|permission to use|redistribut|free software"
          "|software foundation|general public|source and binary|with or without|this software|free of charge"
          "|conditions are met|associated documentation|creative commons|any purpose")

# Notices of each family, and texts that speak of licences without being one.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
                   " compliance with the License.", "SPDX-License-Identifier: Apache-2.0"],
    "mit": ["Released under the MIT License.", "This project is licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files", "SPDX-License-Identifier: MIT"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                " General Public License as published by the Free Software Foundation, either version 3 of the License",
                "SPDX-License-Identifier: GPL-3.0-or-later"],
    "gpl-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
                "SPDX-License-Identifier: GPL-2.0-only"],
    "lgpl": ["Licensed under the GNU Lesser General Public License.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3.",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "bsd": ["Released under the BSD License.", "Licensed under the 3-Clause BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, version 2.0."],
    "isc": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any"
            " purpose with or without fee is hereby granted"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International"
              " License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike"
                 " 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons"
                 " Attribution-NonCommercial 4.0 International License."],
    "cc0": ["Released under CC0 1.0.", "dedicated to the public domain under the Creative Commons CC0 1.0 Universal"],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "Unauthorized copying of this file is"
                    " strictly prohibited. Proprietary and confidential."],
}
OTHER = ["A license is required to fish here.", "The version of the work was released in the city.",
         "Read the terms of the contract before use.", "He was licensed as a driver in the general area.",
         "The public is free to use the hall.", "She reserved all the seats on the right.",
         "The following conditions are met in the north.", "This work is the first of the series."]


def words(text: Column) -> Column:
    found = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    return F.concat(F.array(F.lit("^")), found, F.array(F.lit("$")))


def grams(of: Column) -> Column:
    """Pairs and triples of consecutive words."""
    return F.transform(placed_grams(of), lambda x: x["gram"])


def placed_grams(of: Column) -> Column:
    """The same with the place of the first word (from 0) and the number of words."""
    def runs(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(of) - n), lambda i: F.struct(
            F.concat_ws(" ", *(F.get(of, i + k) for k in range(n))).alias("gram"), i.alias("place"), F.lit(n).alias("n")))
    none = F.array().cast("array<struct<gram:string,place:int,n:int>>")
    return F.concat(*(F.when(F.size(of) >= n, runs(n)).otherwise(none) for n in (2, 3)))


def _marked(text: Column) -> Column:
    """Words of joined lines, with the marks at the ends of sentences too."""
    plain = F.regexp_replace(F.lower(text), "[$^]", " ")
    ends = F.regexp_replace(plain, "[.!?]+[\"')\\]]*(?=\\s|$)", " \\$ ^ ")
    found = F.filter(F.split(ends, "[^\\p{L}\\p{N}$^]+"), lambda w: w != "")
    return F.concat(F.array(F.lit("^")), found, F.array(F.lit("$")))


def windows_around(size: Column, place: Column, n: Column) -> Column:
    """Numbers of the windows over ``size`` words that hold the ``n`` words from ``place`` on.

    Windows of every size of ``WINDOWS`` start a quarter of it apart, the last at or before the
    place where the rest fits; sizes that a smaller one makes needless are left out."""
    made = []
    for k, (width, less) in enumerate(zip(WINDOWS, (0, *WINDOWS), strict=False)):
        step = width // 4
        last = F.floor((F.greatest(F.lit(1), size - width + step) - 1) / step)
        lo = F.greatest(F.lit(0), F.ceil((place + n - width) / step))
        hi = F.least(last, F.floor(place / step))
        # numbered by size, then by start (fewer than 1024)
        made.append(F.when((size > less) & (lo <= hi), F.sequence(lo + (k << 10), hi + (k << 10)))
                    .otherwise(F.array().cast("array<bigint>")))
    return F.concat(*made)


def may_tell(text: Column) -> Column:
    """Whether a text may hold a telling word: it holds the letters of one, or a short one as a word."""
    short = [w for w in TELLING if len(w) < 3]
    long = [w for w in TELLING if not any(v != w and v in w for v in TELLING)]

    def found(t: Column) -> Column:
        alone = F.lit("(?<![\\p{L}\\p{N}])(?:" + "|".join(w for w in TELLING if w[:2] in short) + ")(?![\\p{L}\\p{N}])")
        some = F.lit(False)
        for w in long:
            has = F.contains(t, F.lit(w))
            some = some | (has & F.regexp_like(t, alone) if w in short else has)
        return some
    return F.exists(F.array(F.lower(text)), found)      # lower-cased once


def placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every gram of the lines and of the pieces of blocks that hold a telling word, once each.

    Lines: doc_id, text_hash, block, unit (from 0), gram. Pieces: doc_id, text_hash, block,
    piece, size (words), gram, place, n."""
    telling = F.array(*map(F.lit, TELLING))
    texts = docs.where(may_tell(F.col("text"))).select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.posexplode_outer(F.split("text", "\n(?:[^\\p{L}\\p{N}\n]*\n)+")).alias("block", "body"))
    blocks = stored(texts.where(may_tell(F.col("body"))), "licence-blocks")     # for lines and for windows
    own = ["doc_id", "text_hash", "block"]
    lines = (blocks.select(*own, F.posexplode_outer(F.split("body", "\n")).alias("unit", "line"))
             .where(may_tell(F.col("line"))).select(*own, F.col("unit").cast("long"), words(F.col("line")).alias("words"))
             .where(F.size("words") <= LINE + 2)
             .select(*own, "unit", F.explode(grams(F.col("words"))).alias("gram")))
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - max(WINDOWS)), F.lit(PIECE - max(WINDOWS))),
                      lambda i: F.slice("all", i, PIECE))
    pieces = (blocks.select(*own, _marked(F.col("body")).alias("all"))
              .select(*own, F.posexplode_outer(cut).alias("piece", "piece_words"))
              .where(F.arrays_overlap("piece_words", telling))
              .select(*own, "piece", F.size("piece_words").alias("size"),
                      F.inline(placed_grams(F.col("piece_words")))))
    return lines, pieces


def training_rows(docs: DataFrame) -> DataFrame:
    """(family, grams, apart): templates in several settings, and unknown paragraphs."""
    spark = docs.sparkSession
    templates = spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts] + [(UNKNOWN, t) for t in OTHER],
                                      "family string, line string")
    # lines of the corpus chosen by the hash of line and document (counted first, so that no
    # task has to sort them), less those that may be part of a notice
    lines = (docs.select("doc_id", F.explode_outer(F.split("text", "\n")).alias("line"))
             .where(F.length("line").between(20, 2000)))
    every = max(1, lines.count() // SAMPLE)
    lines = (lines.withColumn("h", F.xxhash64("line", "doc_id")).where(F.pmod("h", F.lit(every)) == 0)
             .where(~F.lower("line").rlike(NOTICE)).select("line", F.shiftright("h", 40).alias("h")))
    unknown = lines.select(F.lit(UNKNOWN).alias("family"), words(F.col("line")).alias("words"), (F.col("h") % 4 == 0).alias("apart"))
    own = templates.withColumn("words", words(F.col("line")))
    inner = F.slice("words", 2, F.size("words") - 2)
    # k-th variant: alone; after other words; before other words; without one of the words
    variants = own.select("family", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("k"), inner.alias("inner"))
    filler = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.concat(F.lit("filler"), F.col("k").cast("string"), i.cast("string")))
    drop = F.filter("inner", lambda w, i: (i != F.pmod(F.col("k") * 5, F.size("inner"))) | (F.size("inner") < 5))
    made = (F.when(F.col("k") < 4, F.col("inner")).when(F.col("k") < 6, F.concat(filler, F.col("inner")))
            .when(F.col("k") < 8, F.concat(F.col("inner"), filler)).otherwise(drop))
    templated = variants.select("family", F.concat(F.array(F.lit("^")), made, F.array(F.lit("$"))).alias("words"),
                                F.col("k").isin(3, 7, 11).alias("apart"))
    return templated.unionByName(unknown).select(
        "family", grams(F.col("words")).alias("grams"), F.coalesce("apart", F.lit(False)).alias("apart"))


def _mass(temperature: float) -> Column:
    """Sum of the exponentials of the logits, of which the largest is 0."""
    return F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x / temperature))


class Classifier:
    """Weights (gram, one double column a class) and templates (gram, template), as DataFrames."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.classes = [UNKNOWN, *sorted(TEMPLATES)]
        rows = training_rows(docs)
        number = F.coalesce(*[F.when(F.col("family") == c, F.lit(float(k))) for k, c in enumerate(self.classes)])
        rows = stored(rows.withColumn("label", number).withColumn("id", F.monotonically_increasing_id()),
                      "licence-train")
        own = spark.createDataFrame([(f"{f}:{k}", f, t) for f, ts in TEMPLATES.items() for k, t in enumerate(ts)],
                                    "template string, family string, line string")
        own = own.withColumn("grams", F.array_distinct(grams(words(F.col("line")))))
        counter = CountVectorizer(inputCol="grams", outputCol="features", vocabSize=1 << 16).fit(own.select("grams"))
        model = LogisticRegression(regParam=0.002, elasticNetParam=0.0, family="multinomial", maxIter=40,
                                   standardization=False).fit(
            # a few thousand rows: one partition, so that a step of the fit is one small task
            counter.transform(rows.where("not apart").coalesce(1)).select("label", "features"))
        shift, weight = model.interceptVector.toArray(), model.coefficientMatrix.toArray()
        self.columns = [f"w{k}" for k in range(len(self.classes))]
        self.shift = [float(x) for x in shift]
        self.weights = spark.createDataFrame(
            [(g, *map(float, weight[:, i])) for i, g in enumerate(counter.vocabulary)],
            "gram string, " + ", ".join(f"{c} double" for c in self.columns))
        size = F.size(F.array_distinct("grams"))
        self.templates = own.select("template", "family", size.alias("size"), F.explode("grams").alias("gram"))
        self.temperature = self._temperature(rows.where("apart"))

    def with_logits(self, sums: DataFrame) -> DataFrame:
        """Adds the array of class logits, the largest at 0, from the summed weights."""
        logits = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) + s for c, s in zip(self.columns, self.shift, strict=True)])
        out = sums.withColumn("logits", logits).drop(*self.columns)
        return out.withColumn("logits", F.transform("logits", lambda x: x - F.array_max("logits")))

    def weighted(self, rows: DataFrame) -> DataFrame:
        """The rows of one gram each whose gram has a weight, with its weights."""
        return rows.join(F.broadcast(self.weights), "gram")

    def sums(self, found: DataFrame, keys: list[str]) -> DataFrame:
        """Summed weights, and the grams held, of weighted grams."""
        return found.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in self.columns), F.collect_set("gram").alias("held"))

    def _temperature(self, rows: DataFrame) -> float:
        """The temperature with the least log loss on rows kept apart."""
        found = self.weighted(rows.select("id", F.explode_outer("grams").alias("gram")))
        sums = self.with_logits(rows.select("id", "label").join(self.sums(found, ["id"]), "id", "left"))
        grid = [0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]
        losses = [F.avg(F.log(_mass(t)) - F.get("logits", F.col("label").cast("int")) / t).alias(f"t{k}")
                  for k, t in enumerate(grid)]
        loss = sums.agg(*losses).first()
        return min(zip([math.inf if x is None else x for x in loss], grid, strict=True))[1]

    def units(self, docs: DataFrame) -> DataFrame:
        """doc_id, text_hash, block, unit and the summed weights and grams of every line (unit from 0)
        and window (below 0). A weighted gram goes to the windows around it, other words to none."""
        lines, pieces = placed(docs)
        around = windows_around(F.col("size"), F.col("place"), F.col("n"))
        own = ["doc_id", "text_hash", "block", "unit", "gram", *self.columns]
        windows = (self.weighted(pieces).withColumn("window", F.explode(around))
                   .withColumn("unit", -1 - F.col("piece").cast("long") * 8192 - F.col("window")))
        found = self.weighted(lines).select(*own).unionByName(windows.select(*own))
        return self.sums(found, own[:4])

    def predict(self, sums: DataFrame, keys: list[str]) -> DataFrame:
        """keys, family, probability, template, held (its grams), share of the units whose prediction is a confirmed
        family, for each template that confirms it."""
        all_ = F.array(*map(F.lit, self.classes))
        best = F.array_position("logits", F.lit(0.0)).cast("int") - 1
        scored = self.with_logits(sums).select(*keys, "held", F.get(all_, best).alias("family"),
                                               (1 / _mass(self.temperature)).alias("probability"))
        likely = stored(scored.where((F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST)), "licence-likely")
        # share of each template of the family that the row holds
        shares = (likely.select(*keys, "family", "probability", F.explode("held").alias("gram"))
                  .join(F.broadcast(self.templates), ["family", "gram"])
                  .groupBy(*keys, "family", "probability", "template", "size").agg(F.collect_set("gram").alias("held")))
        return shares.withColumn("share", F.size("held") / F.col("size")).where(F.col("share") >= CONFIRM)

    def standing(self, found: DataFrame, keys: list[str]) -> DataFrame:
        """keys, family, n (lines, or 1), probability of the families that stand in each block."""
        best = found.groupBy(*keys, "family", "template").agg(
            F.max("share").alias("share"), F.max_by("held", "share").alias("held"), F.max("probability").alias("probability"),
            F.collect_set(F.when(F.col("unit") >= 0, F.col("unit"))).alias("lines"))
        whole = self.templates.groupBy("template").agg(F.collect_set("gram").alias("whole"))
        best = best.join(F.broadcast(whole), "template")
        # at most one entry a template
        every = best.groupBy(*keys).agg(F.collect_list(
            F.struct("family", "share", "held", "whole", "probability", "lines")).alias("all"))
        stands = F.filter("all", lambda x: ~F.exists("all", lambda y: (y["family"] != x["family"]) & (y["share"] > x["share"])
                                                     & (F.size(F.array_except(x["held"], y["whole"])) == 0)))
        return (every.select(*keys, F.explode(stands).alias("x")).groupBy(*keys, F.col("x.family").alias("family"))
                .agg(F.greatest(F.lit(1), F.size(F.array_distinct(F.flatten(F.collect_list("x.lines"))))).alias("n"),
                     F.max("x.probability").alias("probability")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_licences, families (sorted, comma-joined), probability (of the least sure one) of every row."""
    docs = docs.select("doc_id", "text")
    keys = ["doc_id", "text_hash", "block"]
    model = Classifier(docs)
    found = model.standing(model.predict(model.units(docs), [*keys, "unit"]), keys)
    per_text = found.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(
        F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("found"),
        F.min("probability").alias("least"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("[\\p{L}\\p{N}]"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(lines).cast("long").alias("n_paragraphs"))
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    return rows.join(per_text, on, "left").select(
        "doc_id", "n_paragraphs", (F.coalesce("n", F.lit(0)) / F.lit(1)).cast("long").alias("n_licences"),
        F.coalesce("found", F.lit("")).alias("families"), F.col("least").alias("probability"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
