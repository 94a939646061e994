"""The corpus pipeline: documents that are good, harmless, unique and unknown to the
benchmark, as tokens.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps; the next one
works on these. ``run`` writes each stage's rows to shared scratch and rereads them, so a
lost executor costs its tasks only.

A stage handles null and empty texts and null ids as its operator's docstring says: texts
without words pass the near-duplicate and the benchmark stage; models are fitted on the
labels of the documents that a stage gets. Of rows that repeat id and text the near-duplicate
stage keeps one; of rows that share an id each text is judged by itself. Other columns are
kept as they are, and an empty table goes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, jaccard, quality, toxicity, winnow
from tidemark.llm.common import small_batches, stored, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    small_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", good), ("toxicity", harmless), ("near duplicates", unique),
          ("decontamination", decontaminated), ("tokens", tokens)]

#: The model stages have no SQL; tests/llm checks the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
