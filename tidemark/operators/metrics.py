"""Per-sector metrics over tumbling event-time windows.

``groupBy(window, sector)`` runs as a partial + final hash aggregate, so a hot
sector is pre-combined in every map task before the shuffle; only the
(window, sector) partial rows cross the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_half_up_div
from ..functions.time import epoch_ms_to_ts
from ..schemas import DEC_28_8


def metric_aggs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trade_count"),
        F.sum("trade_value").cast(DEC_28_8).alias("total_value"),
        F.sum("price").alias("_sum_price"),
        F.sum("volume").cast("bigint").alias("total_volume"),
    ]


def finish_metrics(agg: DataFrame, window_col: str = "window") -> DataFrame:
    """Window bounds as columns and avg = sum/count, scale 8 HALF_UP."""
    return agg.select(
        F.col(f"{window_col}.start").alias("window_start"),
        F.col(f"{window_col}.end").alias("window_end"),
        "sector",
        "trade_count",
        "total_value",
        round_half_up_div("_sum_price", "trade_count").alias("avg_price"),
        "total_volume",
    )


def with_event_time(enriched: DataFrame, ts_col: str = "event_timestamp") -> DataFrame:
    if ts_col in enriched.columns:
        return enriched
    return enriched.withColumn(ts_col, epoch_ms_to_ts("trade_timestamp"))


def sector_metrics(enriched: DataFrame, width: str = "1 minute", *,
                   ts_col: str = "event_timestamp", watermark: str | None = None) -> DataFrame:
    """trade_count, total_value, avg_price, total_volume per (window, sector).

    ``watermark`` is for streaming input: it must be declared on the enriched
    stream (after any stateful enrichment) for append mode and state cleanup.
    """
    df = with_event_time(enriched, ts_col)
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    agg = df.groupBy(F.window(ts_col, width).alias("window"), "sector").agg(*metric_aggs())
    return finish_metrics(agg)
