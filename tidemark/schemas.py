"""Fixed schemas of the trade and info events, the enriched row and the metrics row."""

from __future__ import annotations

from pyspark.sql import types as T

TRADE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DecimalType(18, 2)),
    T.StructField("volume", T.IntegerType()),
    T.StructField("trade_timestamp", T.LongType()),
    T.StructField("seq", T.LongType()),
])

INFO_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("info_timestamp", T.LongType()),
    T.StructField("seq", T.LongType()),
])

# Columns an info row carries into an enriched trade.
INFO_FIELDS = ("company", "sector", "market_cap", "info_timestamp")

ENRICHED_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DecimalType(18, 2)),
    T.StructField("volume", T.IntegerType()),
    T.StructField("trade_timestamp", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("company", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("info_timestamp", T.LongType()),
    T.StructField("trade_value", T.DecimalType(28, 8)),
])

# What a trade gets when its symbol has no info yet
# (missing='sentinel'): company, sector, market_cap, info_timestamp.
SENTINEL = {"company": "UNKNOWN", "sector": "UNKNOWN", "market_cap": 0, "info_timestamp": 0}

# Serving-table limits (VARCHAR widths and DECIMAL(28,8)).
DEC_28_8 = T.DecimalType(28, 8)
