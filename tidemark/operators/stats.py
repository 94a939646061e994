"""Enrichment counters.

Batch: one aggregate row. Streaming: ``observe`` attaches the same aggregates
to each micro-batch as named metrics (reported through the query progress and
``StreamingQueryListener``), with no extra job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("enriched_count"),
        F.sum(F.when(F.col("info_timestamp") == 0, 1).otherwise(0)).cast("bigint").alias("unknown_count"),
    ]


def enrich_stats(enriched: DataFrame) -> DataFrame:
    return enriched.agg(*_counters())


def observe_enrichment(enriched: DataFrame, name: str = "enrich") -> DataFrame:
    return enriched.observe(name, *_counters())
