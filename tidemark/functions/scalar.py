"""Scalar column helpers: trade value, missing-info defaults, sink casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEC_28_8, INFO_FIELDS, SENTINEL
from .time import zero_ts_to_null
from .util import as_col


def trade_value(price="price", volume="volume") -> Column:
    """price * volume, exact: decimal(18,2) x int is decimal(29,2); stored as decimal(28,8).

    NULL where it doesn't fit: one such trade must not stop a stream. The
    constraint check rejects it with the reason."""
    return (as_col(price) * as_col(volume)).try_cast(DEC_28_8)


def default_missing(df: DataFrame, mode: str = "sentinel") -> DataFrame:
    """Fill the info columns of trades without any info.

    ``sentinel``: UNKNOWN / UNKNOWN / 0 / 0. ``null``: leave NULLs.
    """
    if mode == "null":
        return df
    if mode != "sentinel":
        raise ValueError(f"missing must be 'sentinel' or 'null', not {mode!r}")
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(SENTINEL[c]).cast(df.schema[c].dataType)) for c in INFO_FIELDS
    })


def round_half_up_div(numer, denom, scale: int = 8) -> Column:
    """numer / denom rounded HALF_UP to ``scale`` digits (Spark ``round``; ``bround`` is HALF_EVEN)."""
    return F.round(as_col(numer).cast("decimal(28,12)") / as_col(denom), scale).cast(f"decimal(28,{scale})")


def sink_projection(enriched: DataFrame) -> DataFrame:
    """Enriched trades cast to the serving types.

    price and trade_value DECIMAL(28,8); trade_timestamp TIMESTAMP; info_timestamp
    NULL when it is 0 or missing (C7).
    """
    return enriched.select(
        "symbol",
        F.col("price").cast(DEC_28_8).alias("price"),
        F.col("volume").cast("int").alias("volume"),
        F.timestamp_millis("trade_timestamp").alias("trade_timestamp"),
        "company",
        "sector",
        F.col("market_cap").cast("bigint").alias("market_cap"),
        zero_ts_to_null("info_timestamp").alias("info_timestamp"),
        F.col("trade_value").cast(DEC_28_8).alias("trade_value"),
    )
