"""As-of enrichment of a stream without Python on the data path (E5, E6, E8 per micro-batch).

Each micro-batch of the tagged trade/info union is handed to ``foreachBatch``:

1. the carried state is read from the state log's rows of batches ``< batch_id``, of the
   batch's own symbols only (a semi-join, which Spark may turn into a runtime filter on
   the log's scan), and reduced to one row per symbol;
2. the batch is enriched with the bucketed ``enrich_asof(seed=state)`` - the
   same skew-safe plan as in batch, so a hot symbol inside one micro-batch is
   still split across tasks;
3. the enriched rows and what the batch's symbols carry on are written as
   folder ``batch_id=N`` of their tables.

Replaying batch N reads the same state (batches < N): exactly-once. Semantics
equal ``late='current_state'`` of the stateful processor. With ``ttl`` the state
holds each symbol's last event too, and a symbol that was silent for longer
than that starts without info, within a batch and between batches. Every
``fold_every`` batches the state log of earlier batches is folded to one row
per symbol, so the state read stays small.

``late='history'`` keeps the infos themselves by day, see ``InfoDays``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_ms_to_ts
from ..operators.asof import carry_sessions, enrich_asof, info_key_struct, latest_info
from ..operators.stats import enrich_stats
from ..schemas import INFO_FIELDS, INFO_SCHEMA
from ..sinks import table as tbl

_TRADE_COLS = ["symbol", "price", "volume", "trade_timestamp", "seq"]
_INFO_COLS = ["symbol", *INFO_FIELDS, "seq"]


def _newest(log: DataFrame) -> DataFrame:
    """The row of the newest batch per symbol: with ``ttl`` a state row stands for all before it."""
    kept = [c for c in log.columns if c not in ("symbol", "batch_id")]
    return (log.groupBy("symbol").agg(F.max_by(F.struct(*kept), "batch_id").alias("s"))
            .select("symbol", *(F.col("s")[c].alias(c) for c in kept)))


def carried_state(spark, state_path: str, batch_id: int, symbols: DataFrame | None = None,
                  ttl=None) -> DataFrame | None:
    """The state before a batch, of the given symbols only: idle ones are left in the log."""
    if not tbl.live_dirs(spark, state_path):
        return None
    log = tbl.read_table(spark, state_path).where(F.col("batch_id") < batch_id)
    if symbols is not None:
        log = log.join(symbols.select("symbol"), "symbol", "left_semi")
    if ttl is None:
        return latest_info(log.select(*_INFO_COLS))
    return _newest(log.select(*_INFO_COLS, "last_ms", "batch_id"))


def fold_state(spark, state_path: str, batch_id: int, ttl=None) -> int:
    """Fold the state log of batches ``< batch_id`` to one row per symbol."""
    if ttl is None:
        return tbl.fold_before(spark, state_path, batch_id, lambda rows: latest_info(rows.select(*_INFO_COLS)))
    return tbl.fold_before(spark, state_path, batch_id, _newest)


def enrich_micro_batch(batch: DataFrame, batch_id: int, enriched_path: str, state_path: str, *,
                       missing: str = "sentinel", bucket: str | None = "auto", ttl: str | int | None = None,
                       fold_every: int = 50, counters_path: str | None = None) -> None:
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        trades = batch.where(F.col("ev_ord") == 1).select(*_TRADE_COLS)
        info = batch.where(F.col("ev_ord") == 0).select(*_INFO_COLS)
        seen = (batch.where((F.col("ev_ord") == 1) | (F.col("info_timestamp") > 0))
                .groupBy("symbol").agg(F.min("ev_ms").alias("first_ms")))
        seed = carried_state(spark, state_path, batch_id, seen, ttl)
        if seed is not None and ttl is not None:
            seed = (seed.join(seen, "symbol").withColumn("at_ms", F.least("last_ms", "first_ms"))
                    .drop("first_ms").where(F.col("at_ms").isNotNull()))
        out = enrich_asof(trades, info, missing=missing, bucket=bucket, seed=seed, ttl=ttl)
        out = out.withColumn("event_timestamp", epoch_ms_to_ts("trade_timestamp"))
        tbl.write_batch(out, enriched_path, batch_id)
        carried = latest_info(info) if ttl is None else carry_sessions(trades, info, ttl, seed)
        tbl.write_batch(carried, state_path, batch_id, stamp_ingestion=False)
        if counters_path:
            written = spark.read.parquet(f"{enriched_path}/data/batch_id={batch_id}")
            tbl.write_batch(enrich_stats(written), counters_path, batch_id)
        if fold_every and batch_id > 0 and batch_id % fold_every == 0:
            fold_state(spark, state_path, batch_id, ttl)
    finally:
        batch.unpersist()


# --- late='history' ------------------------------------------------------------------------------

DAY_MS = 86_400_000
_LOG_SCHEMA = T.StructType([*(f for f in INFO_SCHEMA.fields if f.name in _INFO_COLS),
                            T.StructField("day", T.LongType()), T.StructField("batch_id", T.LongType())])


class InfoDays:
    """Infos by the day of their time, and for each day the newest info of every symbol before it.

    ``<path>/log/day=D/batch_id=N`` holds the infos of day D that batch N brought, and
    ``<path>/before/day=D/batch_id=N`` the newest infos before D: all of them from the batch that
    first had trades of that day, and what later batches still brought for days before. A trade of
    day D needs these two folders of D alone, however old it is and however long the log.

    Batch N writes its own folders only (a replay replaces them: dynamic partition overwrite) and
    reads those of earlier batches, so a replay sees what the first run saw.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _days(self, part: str, batch_id: int) -> list[int]:
        """Days that have a folder of an earlier batch (from the listing, no job)."""
        fs, root = tbl._fs(self.spark, f"{self.path}/{part}")
        if not fs.exists(root):
            return []
        found = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("day=") and any(
                    b.getPath().getName().startswith("batch_id=")
                    and int(b.getPath().getName().split("=")[1]) < batch_id for b in fs.listStatus(st.getPath())):
                found.append(int(name.split("=")[1]))
        return sorted(found)

    def _read(self, part: str, batch_id: int) -> DataFrame:
        fs, root = tbl._fs(self.spark, f"{self.path}/{part}")
        if not fs.exists(root):
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).parquet(f"{self.path}/{part}").where(F.col("batch_id") < batch_id)

    def _write(self, df: DataFrame, part: str, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.partitionBy("day", "batch_id")
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{part}"))

    def known(self, days: list[int], batch_id: int) -> DataFrame:
        """All infos that trades of these days may need, from earlier batches: two folders a day."""
        had = self._days("before", batch_id)
        rows = self._read("log", batch_id).where(F.col("day").isin(days)).unionByName(
            self._read("before", batch_id).where(F.col("day").isin(days)))
        return rows.select(*_INFO_COLS).unionByName(
            self._newest_before([d for d in days if d not in had], batch_id).select(*_INFO_COLS))

    def _newest_before(self, days: list[int], batch_id: int) -> DataFrame:
        """(info, day): the newest info of every symbol before each of the days, from the nearest day
        that has them already and the log since."""
        if not days:
            return self.spark.createDataFrame([], T.StructType(_LOG_SCHEMA.fields[:-1]))
        base = max((d for d in self._days("before", batch_id) if d < min(days)), default=None)
        log = self._read("log", batch_id).where(F.col("day") < max(days))
        if base is not None:
            log = log.where(F.col("day") >= base).unionByName(
                self._read("before", batch_id).where(F.col("day") == base).withColumn("day", F.lit(base - 1)))
        return _newest_by_day(_newest_by_day(log).select(*_INFO_COLS, F.explode(_later(days)).alias("day")))

    def add(self, info: DataFrame, days: list[int], batch_id: int) -> None:
        """Logs a batch's infos, and adds them to the days after theirs; ``days`` are those of its trades."""
        had = self._days("before", batch_id)
        fresh = [d for d in days if d not in had]
        own = info.where(F.col("info_timestamp") > 0).withColumn(
            "day", F.floor(F.col("info_timestamp") / F.lit(DAY_MS)).cast("long"))
        self._write(own.select(*_INFO_COLS, "day"), "log", batch_id)
        rows = own.select(*_INFO_COLS, F.explode(_later([*had, *days])).alias("day")).unionByName(
            self._newest_before(fresh, batch_id))
        self._write(_newest_by_day(rows), "before", batch_id)


def _later(days: list[int]):
    """Those of the days that come after the row's own."""
    return F.filter(F.array(*map(F.lit, sorted({*days}))).cast("array<long>"), lambda d: d > F.col("day"))


def _newest_by_day(rows: DataFrame) -> DataFrame:
    """The newest info of every symbol and day (map-side combined)."""
    best = rows.groupBy("day", "symbol").agg(F.max(info_key_struct(rows)).alias("m"))
    return best.select("symbol", *(F.col("m")[c].alias(c) for c in INFO_FIELDS), (-F.col("m.k_nseq")).alias("seq"), "day")


def enrich_micro_batch_history(batch: DataFrame, batch_id: int, enriched_path: str, info_log_path: str, *,
                               missing: str = "sentinel", bucket: str | None = "auto") -> None:
    """``late='history'`` without Python: every trade gets the info as of its own
    time, however late it arrives. The days of a batch's trades (one number a day)
    are known on the driver, so the reads of ``InfoDays`` are pruned to them."""
    spark = batch.sparkSession
    infos = InfoDays(spark, info_log_path)
    batch = batch.persist()
    try:
        trades = batch.where(F.col("ev_ord") == 1).select(*_TRADE_COLS)
        info = batch.where(F.col("ev_ord") == 0).select(*_INFO_COLS)
        days = sorted(r[0] for r in trades.where(F.col("trade_timestamp").isNotNull()).select(
            F.floor(F.col("trade_timestamp") / F.lit(DAY_MS)).cast("long")).distinct().collect())
        known = info.unionByName(infos.known(days, batch_id)) if days else info
        out = enrich_asof(trades, known, missing=missing, bucket=bucket)
        out = out.withColumn("event_timestamp", epoch_ms_to_ts("trade_timestamp"))
        tbl.write_batch(out, enriched_path, batch_id)
        infos.add(info, days, batch_id)
    finally:
        batch.unpersist()
