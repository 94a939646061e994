"""Tagged union of the trade and info streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_ms_to_ts


def union_events(trades: DataFrame, info: DataFrame) -> DataFrame:
    """UNION ALL by name with a ``record_type`` tag and a common ``event_ms``.

    Columns missing on one side become typed NULLs. No shuffle.
    """
    t = trades.withColumns({"record_type": F.lit("trade"), "event_ms": F.col("trade_timestamp")})
    i = info.withColumns({"record_type": F.lit("info"), "event_ms": F.col("info_timestamp")})
    u = t.unionByName(i, allowMissingColumns=True)
    return u.withColumn("event_timestamp", epoch_ms_to_ts("event_ms"))


def trades_only(events: DataFrame) -> DataFrame:
    return events.where(F.col("record_type") == "trade")
