"""JDBC append from ``foreachBatch`` (K4, K6).

A generic writer: table and mode are parameters, inserts are batched, and any
error is re-raised so that Structured Streaming retries the batch instead of
committing it without its rows. Keyed conflict handling (insert-ignore,
upsert) lives in ``upsert``; a database-side ``ON CONFLICT`` needs the
database's own statement and is not issued from here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", properties: dict | None = None,
               batchsize: int = 10_000, num_partitions: int | None = None) -> None:
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batchsize))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def jdbc_sink(url: str, table: str, **kw):
    """A ``foreachBatch`` callback; exceptions propagate (the batch is retried)."""

    def sink(df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, url, table, **kw)

    return sink
