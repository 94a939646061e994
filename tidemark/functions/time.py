"""Epoch-millisecond <-> timestamp conversions.

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen and never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .util import as_col

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def to_epoch_ms(c, dtype: T.DataType | None = None) -> Column:
    """Floored epoch milliseconds of a timestamp or timestamp_ntz column.

    ``timestamp_ntz`` is read as UTC wall-clock without consulting the session
    time zone (``unix_millis(cast(...))`` would shift it by the zone offset).
    """
    c = as_col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), c)
    return F.unix_millis(c)


def epoch_ms_to_ts(ms) -> Column:
    """Epoch ms -> TIMESTAMP (an instant, independent of the session zone)."""
    return F.timestamp_millis(as_col(ms))


def zero_ts_to_null(ms) -> Column:
    """Non-positive or null epoch ms -> NULL timestamp, else the timestamp."""
    ms = as_col(ms)
    return F.when(ms > 0, F.timestamp_millis(ms))


def interval_ms(spec: str | int) -> int:
    """'24 hours' / '1 minute' / '5 minutes' / '2 days' / ms int -> milliseconds."""
    if isinstance(spec, int):
        return spec
    qty, unit = spec.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {
        "millisecond": 1, "ms": 1, "second": 1000, "sec": 1000, "minute": 60_000,
        "min": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000,
    }[unit]
    return int(float(qty) * scale)
