"""Window metrics that fire early and correct late, by event time.

Two clocks run on the same events. A window closes when the closing clock, the newest
event time less ``delay``, reaches its end; until then it emits its totals whenever that
clock passes a multiple of ``every`` and they have changed. For ``lateness`` after its
end it stays in state, and a batch that still brings rows for it emits corrected totals
at once. Later rows are dropped.

Spark has one watermark and drops single rows behind it, so it is declared later than the
closing clock by ``lateness`` plus a window's width: every row of a window that may still
change then arrives, and the operator reads its closing clock as the watermark plus that
shift. Firing marks and clean-up are event-time timers on the same scale. As always in
Structured Streaming the clock moves between micro-batches: several marks passed in one
step give one emission.

Rows are summed per (window, sector) and Arrow batch before the exchange, so a window and
sector that hold a large share of a batch reach the state as a few partial sums.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalar import round_half_up_div
from ..functions.time import epoch_ms_to_ts, interval_ms
from ..schemas import DEC_28_8
from ..session import rocksdb_state

TOTALS = ["trade_count", "total_value", "sum_price", "total_volume"]
_TOTAL_TYPES = "trade_count bigint, total_value decimal(38,8), sum_price decimal(38,2), total_volume bigint"
PARTIAL_SCHEMA = f"sector string, window_ms bigint, {_TOTAL_TYPES}, first_ms bigint, last_ms bigint"
STATE_SCHEMA = f"{_TOTAL_TYPES}, emitted bigint"
OUT_SCHEMA = f"sector string, window_ms bigint, {_TOTAL_TYPES}, kind string"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # as in enrich_stream


def _partials(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ms = batch.column("trade_timestamp").to_numpy(zero_copy_only=False)
            rows = pa.table({"sector": batch.column("sector"), "window_ms": ms - np.mod(ms, width),
                             "value": batch.column("trade_value"), "price": batch.column("price"),
                             "volume": batch.column("volume").cast(pa.int64()), "ms": ms})
            out = rows.group_by(["sector", "window_ms"]).aggregate([
                ([], "count_all"), ("value", "sum"), ("price", "sum"), ("volume", "sum"), ("ms", "min"), ("ms", "max")])
            out = pa.table([out.column("sector"), out.column("window_ms"), out.column("count_all"),
                            out.column("value_sum").cast(pa.decimal128(38, 8)),
                            out.column("price_sum").cast(pa.decimal128(38, 2)), out.column("volume_sum"),
                            out.column("ms_min"), out.column("ms_max")],
                           names=["sector", "window_ms", *TOTALS, "first_ms", "last_ms"])
            yield from out.to_batches()
    return run


def _plus(a, b):
    """Sum as SQL has it: NULL adds nothing."""
    return b if a is None else a if b is None else a + b


class FiringWindows(StatefulProcessor):
    """Totals of one (sector, window); see the module docstring for when they are emitted."""

    def __init__(self, width: int, every: int, lateness: int):
        self.width, self.every, self.lateness = width, every, lateness
        self.shift = lateness + width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", STATE_SCHEMA)

    def _at(self, mark: int) -> None:
        """A timer that expires once the closing clock is at ``mark`` or beyond."""
        self.handle.registerTimer(mark - self.shift - 1)

    def _next_mark(self, ms: int, end: int) -> int:
        return min(end, ms - ms % self.every + self.every)

    def _row(self, key, totals, kind: str) -> pd.DataFrame:
        return pd.DataFrame([[key[0], key[1], *totals, kind]], columns=["sector", "window_ms", *TOTALS, "kind"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = int(key[1]) + self.width
        clock = timerValues.getCurrentWatermarkInMs() + self.shift
        if end + self.lateness <= clock:
            return
        state = self.totals.get()
        totals, emitted, first = [0, None, None, None], -1, None
        if state is not None:
            totals, emitted = list(state[:4]), state[4]
        for part in rows:
            first = int(part["first_ms"].min()) if first is None else min(first, int(part["first_ms"].min()))
            for c, name in enumerate(TOTALS):
                for v in part[name]:
                    v = None if pd.isna(v) else v if c in (1, 2) else int(v)
                    totals[c] = _plus(totals[c], v)
        late = end <= clock
        if late:
            emitted = totals[0]
            yield self._row(key, totals, "correction")
        if state is None:
            self._at(end + self.lateness if late else max(self._next_mark(first, end), self._next_mark(clock, end)))
        self.totals.update((*totals, emitted))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = int(key[1]) + self.width
        clock = timerValues.getCurrentWatermarkInMs() + self.shift
        state = self.totals.get()
        if state is None:
            return
        if expiredTimerInfo.getExpiryTimeInMs() + self.shift + 1 <= end:
            totals, closed = state[:4], end <= clock
            if closed or totals[0] != state[4]:
                yield self._row(key, totals, "final" if closed else "early")
                self.totals.update((*totals, totals[0]))
            if clock < end + self.lateness:
                self._at(end + self.lateness if closed else self._next_mark(clock, end))
                return
        self.totals.clear()

    def close(self) -> None:
        pass


def firing_metrics(enriched: DataFrame, width: str = "1 minute", *, every: str = "30 seconds",
                   delay: str = "5 seconds", lateness: str = "5 minutes") -> DataFrame:
    """Append stream of window totals per sector, each with its ``kind``: ``early``, ``final``
    (the window has closed) or ``correction`` (a late row has changed it).

    The newest emission of a (window_start, sector) holds its totals. Rows without a time
    belong to no window; a NULL sector is a sector of its own.
    """
    rocksdb_state(enriched.sparkSession)
    width_ms, late_ms = interval_ms(width), interval_ms(lateness)
    declared = interval_ms(delay) + late_ms + width_ms
    parts = (enriched.where(F.col("trade_timestamp").isNotNull())
             .select("sector", "trade_timestamp", "trade_value", "price", "volume")
             .mapInArrow(_partials(width_ms), PARTIAL_SCHEMA)
             .withColumn("event_timestamp", epoch_ms_to_ts("last_ms"))
             .withWatermark("event_timestamp", f"{declared} milliseconds"))
    out = parts.groupBy("sector", "window_ms").transformWithStateInPandas(
        statefulProcessor=FiringWindows(width_ms, interval_ms(every), late_ms), outputStructType=OUT_SCHEMA,
        outputMode="Append", timeMode="EventTime")
    return out.select(
        epoch_ms_to_ts("window_ms").alias("window_start"),
        epoch_ms_to_ts(F.col("window_ms") + width_ms).alias("window_end"), "sector", "trade_count",
        F.col("total_value").cast(DEC_28_8).alias("total_value"),
        round_half_up_div("sum_price", "trade_count").alias("avg_price"), "total_volume", "kind")
