from .scalar import default_missing, round_half_up_div, sink_projection, trade_value
from .time import epoch_ms_to_ts, interval_ms, to_epoch_ms, zero_ts_to_null

__all__ = [
    "default_missing", "epoch_ms_to_ts", "interval_ms", "round_half_up_div",
    "sink_projection", "to_epoch_ms", "trade_value", "zero_ts_to_null",
]
