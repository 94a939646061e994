"""Keyed writes into a lake table: insert-ignore and upsert-update (K2, K3, K9).

``policy='ignore'`` is ``ON CONFLICT (keys) DO NOTHING``: the batch is
deduplicated (first row per key by ``seq``), then rows whose key is already in
the table are dropped with a left-anti join and the rest are appended.

``policy='update'`` is ``ON CONFLICT (keys) DO UPDATE``: rows are appended to
the log as they come and resolved on read by ``latest_view`` (latest
``batch_id`` per key), so a replayed batch can never win by being later in
wall-clock time. ``compact(keys=...)`` folds the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.latest import dedup_first, latest_per_key
from . import table as tbl


def upsert(batch: DataFrame, path: str, batch_id: int, keys: list[str], *, policy: str = "ignore",
           order: list[str] = ("seq",), prune_on: str | None = None) -> int:
    """Apply one batch to the table at ``path``; errors propagate so the batch is retried.

    ``prune_on`` (a column among ``keys``) restricts the target scan of the
    anti join to the batch's [min, max] on that column; Parquet min/max
    statistics then skip the rest of the table. Where the table has no row in that
    range the batch is not joined at all, so its rows are not shuffled again for it.
    """
    spark = batch.sparkSession
    if policy == "update":
        return tbl.write_batch(batch, path, batch_id)
    if policy != "ignore":
        raise ValueError(f"policy must be 'ignore' or 'update', not {policy!r}")
    if batch_id in tbl.committed_batches(spark, path):
        # Replay of a committed batch: the anti join would now drop every row,
        # so leave the committed folder as it is.
        return -1
    fresh = dedup_first(batch, list(keys), list(order))
    if not tbl.live_dirs(spark, path):
        return tbl.write_batch(fresh, path, batch_id)
    target = tbl.read_table(spark, path).select(*keys)
    if prune_on is not None:
        lo, hi = batch.agg(F.min(prune_on), F.max(prune_on)).first()
        # nothing in the table can have a key of the batch (a NULL equals nothing): no join
        target = target.where(F.col(prune_on).between(lo, hi))
        if lo is None or target.isEmpty():
            return tbl.write_batch(fresh, path, batch_id)
    return tbl.write_batch(fresh.join(target, list(keys), "left_anti"), path, batch_id)


def latest_view(log: DataFrame, keys: list[str], order: list[str] = ("batch_id", "ingestion_time")) -> DataFrame:
    """Resolved state of an update-policy log: the newest row per key (L1)."""
    return latest_per_key(log, list(keys), list(order))
