"""End-to-end streaming pipelines.

staged:  topics -> parse -> stateful enrichment -> enriched table (K1)
         enriched table (stream) -> watermark -> window metrics, update mode
         -> keyed upsert-update log (K3) -> latest view (L1)
         enriched table (stream) -> not-null filter -> serving projection (K5)
unified: topics -> parse -> stateful enrichment -> one foreachBatch that writes
         the enriched rows and merges the batch's partial metrics into the
         metrics log (reading only the windows the batch touches)

Every query has its own checkpoint folder; sinks re-raise errors so a failed
batch is retried, and every sink is idempotent per ``batch_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import round_half_up_div, sink_projection
from ..operators.constraints import ENRICHED_CONSTRAINTS, METRICS_CONSTRAINTS, Constraints, check_constraints
from ..operators.metrics import metric_aggs, sector_metrics
from ..schemas import ENRICHED_SCHEMA
from ..session import scratch_path
from ..sinks import table as tbl
from ..sinks.upsert import latest_view, upsert
from ..sources.topic import parse_info, parse_trades, read_topic
from ..operators.stats import observe_enrichment
from ..streaming.enrich_batches import enrich_micro_batch, enrich_micro_batch_history
from ..streaming.enrich_stream import enrich_stream, stream_union
from ..streaming.feed import feed_in_slices
from ..streaming.window_state import firing_metrics

# Serving-table row checks (NOT NULL, VARCHAR widths, DECIMAL range); uniqueness
# of the serving rows is the upsert's job, not a per-batch check.
ROW_CHECKS = Constraints(**{**ENRICHED_CONSTRAINTS.__dict__, "unique": ()})


def write_checked(df: DataFrame, path: str, batch_id: int, spec: Constraints, write) -> None:
    """Rows that break the serving constraints go to ``<path>_rejects`` with a
    reason (same batch id, so replays stay idempotent); the rest are written."""
    df = df.persist()
    try:
        ok, rejects = check_constraints(df, spec)
        write(ok)
        tbl.write_batch(rejects, f"{path}_rejects", batch_id)
    finally:
        df.unpersist()


METRIC_KEYS = ["window_start", "sector"]
METRIC_COLS = ["window_start", "window_end", "sector", "trade_count", "total_value", "avg_price", "total_volume"]


@dataclass
class Layout:
    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def layout(spark: SparkSession, name: str) -> Layout:
    return Layout(scratch_path(spark, name))


def _parsed_topics(spark: SparkSession, lay: Layout, max_files: int | None = None):
    t, _ = parse_trades(read_topic(spark, "trades", path=lay.in_trades, max_per_trigger=max_files))
    i, _ = parse_info(read_topic(spark, "info", path=lay.in_info, max_per_trigger=max_files))
    return t, i


def _enriched_stream(spark: SparkSession, lay: Layout, *, max_files: int | None = None,
                     late: str = "current_state", watermark: str | None = None,
                     ttl: str | None = None) -> DataFrame:
    t, i = _parsed_topics(spark, lay, max_files)
    return observe_enrichment(enrich_stream(t, i, late=late, watermark=watermark, ttl=ttl))


def start_enrichment(spark: SparkSession, lay: Layout, *, engine: str = "batchwise", **kw):
    """Query A: enriched trades appended to the enriched table, one folder per batch.

    ``engine='batchwise'`` (default): foreachBatch + seeded as-of, state in a
    table (no Python on the data path), with ``ttl``; ``late='history'`` keeps the
    infos by day and is exact for any lateness. Each batch's counters (E10) go to
    a table of their own. ``engine='state'``: the
    ``transformWithStateInPandas`` operator (TTL timers; its ``late='history'``
    is exact up to the watermark delay).
    """
    if engine == "batchwise":
        history, ttl = kw.get("late", "current_state") == "history", kw.get("ttl")
        if kw.get("watermark") is not None:
            raise ValueError("engine='batchwise' drops no row, so it has no watermark; use engine='state'")
        if history and ttl is not None:
            raise ValueError("ttl is supported with late='current_state'")
        t, i = _parsed_topics(spark, lay, kw.get("max_files"))

        def fb(df: DataFrame, batch_id: int) -> None:
            if history:
                enrich_micro_batch_history(df, batch_id, lay.enriched, lay.info_log)
            else:
                enrich_micro_batch(df, batch_id, lay.enriched, lay.enrich_state, ttl=ttl, counters_path=lay.counters)

        return (stream_union(t, i).writeStream.foreachBatch(fb)
                .option("checkpointLocation", lay.ckpt_enrich).trigger(availableNow=True).start())

    enriched = _enriched_stream(spark, lay, **kw)

    def sink(df: DataFrame, batch_id: int) -> None:
        tbl.write_batch(df, lay.enriched, batch_id)

    return (enriched.writeStream.foreachBatch(sink).outputMode("append")
            .option("checkpointLocation", lay.ckpt_enrich).trigger(availableNow=True).start())


_ENRICHED_TABLE_SCHEMA = T.StructType(list(ENRICHED_SCHEMA.fields) + [
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("ingestion_time", T.TimestampType()),
])


def start_metrics(spark: SparkSession, lay: Layout, width: str = "1 minute", watermark: str = "5 minutes",
                  output_mode: str = "update"):
    """Query C: window metrics from the enriched table's appends, upserted by (window_start, sector)."""
    src = tbl.read_table_stream(spark, lay.enriched, _ENRICHED_TABLE_SCHEMA)
    m = sector_metrics(src.drop("batch_id", "ingestion_time"), width, watermark=watermark)

    def sink(df: DataFrame, batch_id: int) -> None:
        write_checked(df, lay.metrics, batch_id, METRICS_CONSTRAINTS,
                      lambda ok: upsert(ok, lay.metrics, batch_id, METRIC_KEYS, policy="update"))

    return (m.writeStream.foreachBatch(sink).outputMode(output_mode)
            .option("checkpointLocation", lay.ckpt_metrics).trigger(availableNow=True).start())


def start_firing_metrics(spark: SparkSession, lay: Layout, width: str = "1 minute", every: str = "30 seconds",
                         delay: str = "5 seconds", lateness: str = "5 minutes"):
    """Query C with early results and corrections by event time (W4, W7): each emission is
    upserted by (window_start, sector), so the newest one is the window's result."""
    src = tbl.read_table_stream(spark, lay.enriched, _ENRICHED_TABLE_SCHEMA)
    m = firing_metrics(src, width, every=every, delay=delay, lateness=lateness)

    def sink(df: DataFrame, batch_id: int) -> None:
        write_checked(df, lay.metrics, batch_id, METRICS_CONSTRAINTS,
                      lambda ok: upsert(ok, lay.metrics, batch_id, METRIC_KEYS, policy="update"))

    return (m.writeStream.foreachBatch(sink).outputMode("append")
            .option("checkpointLocation", lay.ckpt_metrics).trigger(availableNow=True).start())


def run_firing(spark: SparkSession, trades: DataFrame, info: DataFrame, *, k: int, arrival: str = "trade_timestamp",
               name: str = "firing", **windows) -> Layout:
    """Enrichment by event time, then firing windows; trades are delivered in the order of ``arrival``."""
    lay = layout(spark, name)
    feed_in_slices({"trades": (trades, arrival, lay.in_trades), "info": (info, "info_timestamp", lay.in_info)}, k,
                   [lambda: start_enrichment(spark, lay, late="history"),
                    lambda: start_firing_metrics(spark, lay, **windows)])
    return lay


def start_rejects(spark: SparkSession, lay: Layout, raw: dict[str, DataFrame] | None = None, **trigger):
    """Every document that the parsers turn down (malformed, or a NULL key), kept with its
    topic, text and reason in the rejects table."""
    raw = raw or {"trades": read_topic(spark, "trades", path=lay.in_trades),
                  "info": read_topic(spark, "info", path=lay.in_info)}
    parse = {"trades": parse_trades, "info": parse_info}
    parts = [parse[k](df)[1].select(F.lit(k).alias("topic"), "value", "reason") for k, df in raw.items()]

    def sink(df: DataFrame, batch_id: int) -> None:
        tbl.write_batch(df, lay.rejects, batch_id)

    return (parts[0].unionByName(parts[1]).writeStream.foreachBatch(sink)
            .option("checkpointLocation", lay.ckpt_rejects).trigger(**(trigger or {"availableNow": True})).start())


def start_serving_copy(spark: SparkSession, lay: Layout):
    """Query B: enriched rows with a symbol, cast to the serving types."""
    src = tbl.read_table_stream(spark, lay.enriched, _ENRICHED_TABLE_SCHEMA)

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = df.where(F.col("symbol").isNotNull())
        write_checked(rows, lay.serving, batch_id, ROW_CHECKS,
                      lambda ok: tbl.write_batch(sink_projection(ok), lay.serving, batch_id))

    return (src.writeStream.foreachBatch(sink)
            .option("checkpointLocation", lay.ckpt_serving).trigger(availableNow=True).start())


def run_staged(spark: SparkSession, trades: DataFrame, info: DataFrame, *, k: int = 3, width: str = "1 minute",
               name: str = "staged", serving: bool = False, output_mode: str = "update",
               rejects: bool = False, arrival: str = "trade_timestamp", late: str = "current_state") -> Layout:
    lay = layout(spark, name)
    runs = [lambda: start_enrichment(spark, lay, late=late),
            lambda: start_metrics(spark, lay, width, output_mode=output_mode)]
    if serving:
        runs.append(lambda: start_serving_copy(spark, lay))
    if rejects:
        runs.append(lambda: start_rejects(spark, lay))
    feed_in_slices({"trades": (trades, arrival, lay.in_trades),
                    "info": (info, "info_timestamp", lay.in_info)}, k, runs)
    return lay


def run_enrichment_only(spark: SparkSession, trades: DataFrame, info: DataFrame, *, k: int = 3,
                        name: str = "enrich", engine: str = "batchwise", arrival: str = "trade_timestamp",
                        **kw) -> Layout:
    lay = layout(spark, name)
    feed_in_slices({"trades": (trades, arrival, lay.in_trades),
                    "info": (info, "info_timestamp", lay.in_info)}, k,
                   [lambda: start_enrichment(spark, lay, engine=engine, **kw)])
    return lay


# ---- unified: one query, two sinks --------------------------------------------------

def not_too_late(fresh: DataFrame, before: DataFrame | None, width: str, delay: str) -> DataFrame:
    """The rows whose window is still open: what a watermark of ``delay`` over the rows of earlier
    batches (``before``) keeps in a window aggregation."""
    newest = before.agg(F.max("event_timestamp")).first()[0] if before is not None else None
    if newest is None:
        return fresh
    return fresh.where(F.window("event_timestamp", width)["end"] > F.lit(newest) - F.expr(f"INTERVAL {delay}"))


def merge_metrics(batch: DataFrame, path: str, batch_id: int, width: str) -> int:
    """Fold a batch's partial sums into the metrics log (update policy).

    The previous totals are read from batches ``< batch_id`` only, so a replay
    of batch N recomputes the same rows; the target scan is limited to the
    batch's window range (pushed down to Parquet statistics).
    """
    spark = batch.sparkSession
    part = (batch.groupBy(F.window("event_timestamp", width).alias("w"), "sector").agg(*metric_aggs())
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "sector",
                    "trade_count", "total_value", "_sum_price", "total_volume")).persist()
    try:
        lo, hi = part.agg(F.min("window_start"), F.max("window_start")).first()
        if lo is None:
            return -1
        merged = part
        if tbl.live_dirs(spark, path):
            prev = (tbl.read_table(spark, path).where(F.col("batch_id") < batch_id)
                    .where(F.col("window_start").between(lo, hi)))
            prev = latest_view(prev, METRIC_KEYS).select(*part.columns)
            prev = prev.join(part.select(*METRIC_KEYS), METRIC_KEYS, "left_semi")
            merged = part.unionByName(prev)
        out = merged.groupBy("window_start", "window_end", "sector").agg(
            F.sum("trade_count").cast("bigint").alias("trade_count"),
            F.sum("total_value").cast("decimal(28,8)").alias("total_value"),
            F.sum("_sum_price").cast("decimal(28,2)").alias("_sum_price"),
            F.sum("total_volume").cast("bigint").alias("total_volume"),
        ).withColumn("avg_price", round_half_up_div("_sum_price", "trade_count"))
        return tbl.write_batch(out, path, batch_id)
    finally:
        part.unpersist()


def start_unified(spark: SparkSession, lay: Layout, width: str = "1 minute", watermark: str = "5 minutes",
                  late: str = "current_state"):
    """One query, two sinks: each micro-batch is enriched (seeded, bucketed plan),
    written to the enriched table, and its partial metrics merged into the log.
    Rows too late for their window are left out of the metrics as in the staged form."""
    t, i = _parsed_topics(spark, lay)

    def sink(df: DataFrame, batch_id: int) -> None:
        if late == "history":
            enrich_micro_batch_history(df, batch_id, lay.enriched, lay.info_log)
        else:
            enrich_micro_batch(df, batch_id, lay.enriched, lay.enrich_state, counters_path=lay.counters)
        fresh = spark.read.parquet(f"{lay.enriched}/data/batch_id={batch_id}")
        rows = tbl.read_table(spark, lay.enriched)
        before = rows.where(F.col("batch_id") < batch_id) if batch_id else None
        merge_metrics(not_too_late(fresh, before, width, watermark), lay.metrics, batch_id, width)

    return (stream_union(t, i).writeStream.foreachBatch(sink)
            .option("checkpointLocation", lay.ckpt_unified).trigger(availableNow=True).start())


def run_unified(spark: SparkSession, trades: DataFrame, info: DataFrame, *, k: int = 3,
                width: str = "1 minute", name: str = "unified", arrival: str = "trade_timestamp", **kw) -> Layout:
    lay = layout(spark, name)
    feed_in_slices({"trades": (trades, arrival, lay.in_trades),
                    "info": (info, "info_timestamp", lay.in_info)}, k,
                   [lambda: start_unified(spark, lay, width, **kw)])
    return lay


def latest_metrics(spark: SparkSession, lay: Layout) -> DataFrame:
    """The resolved metrics table: newest emission per (window_start, sector)."""
    return latest_view(tbl.read_table(spark, lay.metrics), METRIC_KEYS).select(*METRIC_COLS)


def latest_sector_view(spark: SparkSession, lay: Layout) -> DataFrame:
    """The serving view (L2): the newest emission of each window and sector, and when it came in."""
    return latest_view(tbl.read_table(spark, lay.metrics), METRIC_KEYS).select(
        "window_start", "window_end", "sector", "trade_count", "total_value", "avg_price", "ingestion_time")


def enriched_rows(spark: SparkSession, lay: Layout) -> DataFrame:
    return tbl.read_table(spark, lay.enriched).select(*[f.name for f in ENRICHED_SCHEMA.fields])
