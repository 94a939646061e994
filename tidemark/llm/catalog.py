"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, codes, forest, jaccard, licences, lm, quality, sharding, spelling, suffixes, toxicity, warc, winnow


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc": warc.query,
        "op2_bpe": bpe.query,
        "op3_sharding": sharding.query,
        "op4_forest": forest.query,
        "op5_licences": licences.query,
        "op6_quality": quality.query,
        "op7_winnow": winnow.query,
        "op8_lm": lm.query,
        "op9_jaccard": jaccard.query,
        "op10_toxicity": toxicity.query,
        "op11_codes": codes.query,
        "op12_suffixes": suffixes.query,
        "op13_spelling": spelling.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.ORACLE, "op11_codes": codes.ORACLE, "op12_suffixes": suffixes.ORACLE,
            "op13_spelling": spelling.ORACLE}
