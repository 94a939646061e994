"""Driving a stream from table-derived input in time-ordered slices.

The input rows are cut into ``k`` event-time slices (equal-width cuts between
the min and max timestamp, so an SQL engine can reproduce them). Each slice is
appended as JSON-lines files to a topic folder by parallel tasks, and the
streaming queries are then run with ``trigger(availableNow=True)`` from their
checkpoints - so every slice is one micro-batch and every run is a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.topic import to_json_lines


def time_cuts(df: DataFrame, ts_col: str, k: int) -> list[int]:
    """k-1 interior cut points, equal width in event time (one small aggregate)."""
    lo, hi = df.agg(F.min(ts_col), F.max(ts_col)).first()
    if lo is None:
        return []
    return [lo + (hi - lo) * i // k for i in range(1, k)]


def time_slice(df: DataFrame, ts_col: str, cuts: list[int], i: int) -> DataFrame:
    cond = F.lit(True)
    if i > 0:
        cond = cond & (F.col(ts_col) >= cuts[i - 1])
    if i < len(cuts):
        cond = cond & (F.col(ts_col) < cuts[i])
    return df.where(cond)


def append_json(df: DataFrame, folder: str) -> None:
    """Append rows as JSON lines (new files, written by parallel tasks)."""
    to_json_lines(df).write.mode("append").text(folder)


def run_available(start: Callable[[], StreamingQuery]) -> None:
    """Start a query that processes what is there (availableNow) and wait; re-raise failures."""
    q = start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def feed_in_slices(topics: dict[str, tuple[DataFrame, str, str]], k: int,
                   runs: list[Callable[[], StreamingQuery]], cut_on: str | None = None) -> list[int]:
    """For each of ``k`` time slices: append every topic's slice, then run each query.

    ``topics``: name -> (rows, time column, folder). Cuts come from the first
    topic's time column.
    """
    first = next(iter(topics.values()))
    cuts = time_cuts(first[0], cut_on or first[1], k)
    for i in range(len(cuts) + 1):
        for rows, ts, folder in topics.values():
            append_json(time_slice(rows, ts, cuts, i), folder)
        for r in runs:
            run_available(r)
    return cuts
