"""Trade and info inputs derived from the driver's tables (no synthetic rows).

``events`` -> trades (all non-signup events) and info (signup events); the
column rules are fixed so that an independent SQL engine derives the same rows.
``lineitem``/``orders`` -> a tie-heavy, day-granular form of the same two
inputs for tie rules and load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id", "event_type", "value",
        to_epoch_ms("ts", ev.schema["ts"].dataType).alias("ms"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def trades_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") != "signup")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
        F.col("value").cast("decimal(18,2)").alias("price"),
        F.col("k").alias("volume"),
        F.col("ms").alias("trade_timestamp"),
        F.col("event_id").alias("seq"),
    )


def info_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).where(F.col("event_type") == "signup")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id")).alias("symbol"),
        F.concat(F.lit("C"), F.col("user_id")).alias("company"),
        F.concat(F.lit("S"), (F.col("user_id") + F.col("k")) % 5).alias("sector"),
        ((F.col("user_id") + 1) * 1_000_000 + F.col("k") * 1000).cast("bigint").alias("market_cap"),
        F.col("ms").alias("info_timestamp"),
        F.col("event_id").alias("seq"),
    )


#: The dense form has a month of events in a few hours: a trade every second or so at sf0.01.
DENSE = 200


def dense_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(trades, infos) of ``events`` with all times divided by ``DENSE``, for windows of minutes.

    Trades carry ``arrival_ms``, the time at which they are delivered: most at once, a tenth
    each 90 s, 200 s and 700 s late."""
    t, i = trades_from_events(spark, sf_dir), info_from_events(spark, sf_dir)
    late = F.element_at(F.array(*map(F.lit, LATE_MS)), (F.pmod("seq", F.lit(10)) + 1).cast("int"))
    t = t.withColumn("trade_timestamp", F.expr(f"trade_timestamp div {DENSE}"))
    return (t.withColumn("arrival_ms", F.col("trade_timestamp") + late),
            i.withColumn("info_timestamp", F.expr(f"info_timestamp div {DENSE}")))


def events_with_nulls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(trades, infos) of ``events``; every 50th trade has no symbol, the next one no time, and every
    40th event, if an info, no symbol."""
    t, i = trades_from_events(spark, sf_dir), info_from_events(spark, sf_dir)
    without = lambda c, cond: F.when(~cond, F.col(c)).alias(c)
    return (t.withColumns({"symbol": without("symbol", F.col("seq") % 50 == 0),
                           "trade_timestamp": without("trade_timestamp", F.col("seq") % 50 == 1)}),
            i.withColumn("symbol", without("symbol", F.col("seq") % 40 == 0)))


#: By the last digit of ``seq``.
LATE_MS = [90_000, 200_000, 700_000, 0, 0, 0, 0, 0, 0, 0]


def _n_suppliers(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "supplier").count()


def trades_from_lineitem(spark: SparkSession, sf_dir: str, hot: int | None = None) -> DataFrame:
    """Day-granular trades: one per lineitem, symbol from the supplier key.

    ``hot=k`` folds the suppliers into k symbols (``'H' || suppkey * k // n``),
    so each symbol holds about 1/k of all trades: the skewed-key form.
    """
    li = table(spark, sf_dir, "lineitem")
    if hot:
        n = _n_suppliers(spark, sf_dir)
        sym = F.concat(F.lit("H"), (F.col("l_suppkey") * hot / n).cast("bigint"))
    else:
        sym = F.concat(F.lit("U"), F.col("l_suppkey"))
    return li.select(
        sym.alias("symbol"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("volume"),
        to_epoch_ms("l_shipdate", li.schema["l_shipdate"].dataType).alias("trade_timestamp"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def trades_with_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same; every 997th trade has the largest price and volume, whose product does not fit."""
    t = trades_from_lineitem(spark, sf_dir)
    big = F.col("seq") % 997 == 0
    return t.withColumns({
        "price": F.when(big, F.lit("9999999999999999.99").cast("decimal(18,2)")).otherwise(F.col("price")),
        "volume": F.when(big, F.lit(2**31 - 1)).otherwise(F.col("volume"))})


def info_from_orders(spark: SparkSession, sf_dir: str, n_symbols: int | None = None,
                     hot: int | None = None) -> DataFrame:
    """Day-granular info: one per order, symbol = customer key modulo the supplier count
    (folded like ``trades_from_lineitem`` when ``hot`` is given).

    The modulus is a scalar (the supplier count), fetched once.
    """
    if n_symbols is None:
        n_symbols = _n_suppliers(spark, sf_dir)
    od = table(spark, sf_dir, "orders")
    base = F.col("o_custkey") % n_symbols
    sym = (F.concat(F.lit("H"), (base * hot / n_symbols).cast("bigint")) if hot
           else F.concat(F.lit("U"), base))
    return od.select(
        sym.alias("symbol"),
        F.concat(F.lit("C"), F.col("o_custkey")).alias("company"),
        F.concat(F.lit("S"), (F.col("o_custkey") + F.col("o_orderkey")) % 5).alias("sector"),
        F.floor("o_totalprice").cast("bigint").alias("market_cap"),
        to_epoch_ms("o_orderdate", od.schema["o_orderdate"].dataType).alias("info_timestamp"),
        (F.col("o_orderkey") * 8).alias("seq"),
    )
