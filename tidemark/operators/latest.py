"""Latest-per-key, first-per-key and newest-N-per-key.

All of them are written as aggregates or as a ranked filter Spark can limit
before the shuffle, so a key holding a large share of the rows is combined in
the map tasks instead of being funnelled whole into one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str | Column], fn) -> DataFrame:
    # One struct whose leading fields are the ordering key and whose tail is the
    # rest of the row: min/max of it picks the whole row (ties broken by the
    # remaining columns, a total order). Partial aggregation runs in every map task.
    names = [o for o in order if isinstance(o, str)]
    lead = [(F.col(o) if isinstance(o, str) else o).alias(o if isinstance(o, str) else f"_o{i}")
            for i, o in enumerate(order)]
    rest = [c for c in df.columns if c not in keys and c not in names]
    best = df.groupBy(*keys).agg(fn(F.struct(*lead, *[F.col(c) for c in rest])).alias("_p"))
    return best.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in names + rest]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key (``DISTINCT ON ... ORDER BY ... DESC``)."""
    return _pick(df, list(keys), list(order), F.max)


def dedup_first(df: DataFrame, keys: list[str], order: list[str] = ("seq",)) -> DataFrame:
    """First row per key by ``order`` then by every other column (a total order).

    This is insert-if-absent within one batch: ``ON CONFLICT DO NOTHING``.
    """
    return _pick(df, list(keys), list(order), F.min)


def duplicates(df: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``df`` not in ``kept``, as a multiset (``EXCEPT ALL``)."""
    return df.exceptAll(kept.select(*df.columns))


def newest_per_key(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The ``n`` newest rows per key, newest first within the key.

    ``row_number() <= n`` is rewritten by Spark into a partial per-key limit
    before the exchange, so each map task sends at most ``n`` rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def dedup_stream(df, keys: list[str], event_time: str, delay: str = "5 minutes"):
    """Streaming insert-if-absent (L4): one row per key among rows whose event
    times lie within the watermark delay. Which copy survives depends on arrival;
    use ``upsert(policy='ignore')`` in ``foreachBatch`` for first-by-``seq``."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
