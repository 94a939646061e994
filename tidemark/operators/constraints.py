"""Serving-table constraints checked before a write.

NOT NULL, VARCHAR(n), DECIMAL(p,s) range and UNIQUE keys are evaluated as
columns; rows that fail are returned with the reason instead of being written.
UNIQUE keeps the first valid row per key (by ``seq``, then by every other column) and rejects
the other copies. One pass: the reason is a column of each row, and rows of a key are numbered
in one window over the key, so the input is computed and shuffled once for both results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Constraints:
    not_null: tuple[str, ...] = ()
    max_len: dict[str, int] = field(default_factory=dict)
    decimal: dict[str, tuple[int, int]] = field(default_factory=dict)
    # column -> inputs: NULL although all inputs are set means that the value did not fit
    derived: dict[str, tuple[str, ...]] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    order: tuple[str, ...] = ("seq",)


# The enriched-trades serving table: symbol VARCHAR(8) NOT NULL, price DECIMAL(28,8) NOT NULL,
# volume INTEGER NOT NULL, trade_timestamp NOT NULL, company/sector VARCHAR(20),
# trade_value DECIMAL(28,8), UNIQUE (symbol, trade_timestamp, volume).
ENRICHED_CONSTRAINTS = Constraints(
    not_null=("symbol", "price", "volume", "trade_timestamp"),
    max_len={"symbol": 8, "company": 20, "sector": 20},
    decimal={"price": (28, 8), "trade_value": (28, 8)},
    derived={"trade_value": ("price", "volume")},
    unique=("symbol", "trade_timestamp", "volume"),
)

# sector_metrics: every column NOT NULL, sector VARCHAR(20), UNIQUE (window_start, sector).
METRICS_CONSTRAINTS = Constraints(
    not_null=("window_start", "window_end", "sector", "trade_count", "total_value", "avg_price",
              "total_volume"),
    max_len={"sector": 20},
    decimal={"total_value": (28, 8), "avg_price": (28, 8)},
    unique=("window_start", "sector"),
    order=("window_end",),
)


def check_constraints(df: DataFrame, spec: Constraints) -> tuple[DataFrame, DataFrame]:
    """-> (rows that satisfy every constraint, rejected rows with a ``reason``)."""
    checks = []
    checks += [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in spec.not_null]
    checks += [F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")) for c, n in spec.max_len.items()]
    checks += [F.when(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(),
                      F.lit(f"{c} out of decimal({p},{s})")) for c, (p, s) in spec.decimal.items()]
    for c, inputs in spec.derived.items():
        missing = F.col(c).isNull()
        for i in inputs:
            missing = missing & F.col(i).isNotNull()
        p, s = spec.decimal[c]
        checks.append(F.when(missing, F.lit(f"{c} out of decimal({p},{s})")))
    reason = F.concat_ws("; ", *checks) if checks else F.lit("")
    tagged = df.withColumn("reason", reason)
    if spec.unique:
        rest = [c for c in df.columns if c not in spec.unique and c not in spec.order]
        of_key = Window.partitionBy(*spec.unique, F.col("reason") == "").orderBy(*spec.order, *rest)
        again = (F.col("reason") == "") & (F.row_number().over(of_key) > 1)
        tagged = tagged.withColumn("reason", F.when(again, F.lit("duplicate key")).otherwise(F.col("reason")))
    return tagged.where(F.col("reason") == "").drop("reason"), tagged.where(F.col("reason") != "")
