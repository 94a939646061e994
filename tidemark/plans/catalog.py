"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator key,
and the matching DuckDB SQL (``oracle_sql``). ``__spark_entry__`` re-exports both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import asof, constraints, events, latest, metrics, stats
from ..schemas import INFO_FIELDS
from ..session import scratch_path
from ..sinks import table as tbl
from ..sinks import upsert
from ..sources import fixtures as fx
from ..sources import topic
from ..streaming import feed
from . import oracle as O
from . import pipelines as P

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def event_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fx.trades_from_events(spark, sf_dir), fx.info_from_events(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    t, i = event_inputs(spark, sf_dir)
    return asof.enrich_asof(t, i, **kw)


_ENRICHED_SQL = O.enriched_sql()


# ---- E1 / E1b: as-of enrichment -------------------------------------------------

@register("enrich_asof", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_enrich_asof(spark, sf_dir):
    return enriched(spark, sf_dir, bucket=None)


@register("enrich_asof_bucketed", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_enrich_asof_bucketed(spark, sf_dir):
    return enriched(spark, sf_dir, bucket="1 hour")


_TIES_SQL = O.with_ctes(O.TIES_CTE, O.asof_ctes(), O.ENRICHED_SENTINEL)


@register("enrich_asof_ties", _TIES_SQL + "\nSELECT * FROM enriched")
def q_enrich_asof_ties(spark, sf_dir):
    t, i = fx.trades_from_lineitem(spark, sf_dir), fx.info_from_orders(spark, sf_dir)
    return asof.enrich_asof(t, i, bucket="1 day")


_HOT_SQL = O.with_ctes(O.HOT_CTE, O.asof_ctes(), O.ENRICHED_SENTINEL)


def _hot_inputs(spark, sf_dir):
    return (fx.trades_from_lineitem(spark, sf_dir, hot=3), fx.info_from_orders(spark, sf_dir, hot=3))


@register("enrich_asof_hot", _HOT_SQL + "\nSELECT * FROM enriched")
def q_enrich_asof_hot(spark, sf_dir):
    """Three symbols, each about a third of all trades: the bucketed plan splits them."""
    t, i = _hot_inputs(spark, sf_dir)
    return asof.enrich_asof(t, i, bucket="1 day")


@register("sector_metrics_hot_1d", _HOT_SQL + O.metrics_select(86_400_000))
def q_sector_metrics_hot(spark, sf_dir):
    t, i = _hot_inputs(spark, sf_dir)
    return metrics.sector_metrics(asof.enrich_asof(t, i, bucket="1 day"), "1 day")


# ---- A1: sector metrics ---------------------------------------------------------

for _name, _width, _ms in (("1m", "1 minute", 60_000), ("1h", "1 hour", 3_600_000),
                           ("1d", "1 day", 86_400_000)):
    def _q(spark, sf_dir, _width=_width):
        return metrics.sector_metrics(enriched(spark, sf_dir), _width)
    register(f"sector_metrics_{_name}", _ENRICHED_SQL + O.metrics_select(_ms))(_q)


@register("sector_metrics_ties_1d", _TIES_SQL + O.metrics_select(86_400_000))
def q_sector_metrics_ties(spark, sf_dir):
    t, i = fx.trades_from_lineitem(spark, sf_dir), fx.info_from_orders(spark, sf_dir)
    return metrics.sector_metrics(asof.enrich_asof(t, i, bucket="1 day"), "1 day")


# ---- S1 / P1-P4: decoding the wire format ---------------------------------------

def _json_roundtrip(df: DataFrame, parse) -> DataFrame:
    valid, _rejects = parse(topic.to_json_lines(df))
    return valid


@register("parse_trades", O.with_ctes(O.FIXTURE_CTE) + "\nSELECT * FROM trades")
def q_parse_trades(spark, sf_dir):
    t, _ = event_inputs(spark, sf_dir)
    return _json_roundtrip(t, topic.parse_trades)


@register("parse_info", O.with_ctes(O.FIXTURE_CTE) + "\nSELECT * FROM info")
def q_parse_info(spark, sf_dir):
    _, i = event_inputs(spark, sf_dir)
    return _json_roundtrip(i, topic.parse_info)


# ---- P9, P11, P12, P14, P17 --------------------------------------------------------

@register("trade_value", O.with_ctes(O.FIXTURE_CTE) +
          "\nSELECT symbol, seq, price, volume, CAST(price * volume AS DECIMAL(28,8)) AS trade_value FROM trades")
def q_trade_value(spark, sf_dir):
    t, _ = event_inputs(spark, sf_dir)
    return t.select("symbol", "seq", "price", "volume", S.trade_value().alias("trade_value"))


@register("enrich_missing_sentinel", O.ENRICHED_SENTINEL_SQL + "\nSELECT * FROM enriched")
def q_enrich_missing_sentinel(spark, sf_dir):
    return enriched(spark, sf_dir, missing="sentinel")


@register("enrich_missing_null", O.enriched_sql(missing="null") + "\nSELECT * FROM enriched")
def q_enrich_missing_null(spark, sf_dir):
    return enriched(spark, sf_dir, missing="null")


@register("sink_projection", O.ENRICHED_SENTINEL_SQL + O.SINK_PROJECTION)
def q_sink_projection(spark, sf_dir):
    return S.sink_projection(enriched(spark, sf_dir))


@register("valid_trades", O.ENRICHED_SENTINEL_SQL + "\nSELECT * FROM enriched WHERE symbol IS NOT NULL")
def q_valid_trades(spark, sf_dir):
    return enriched(spark, sf_dir).where(F.col("symbol").isNotNull())


@register("constraint_rejects",
          O.with_ctes(O.OVERFLOW_CTE, O.asof_ctes(), O.ENRICHED_TRY) + O.constraint_rejects_sql())
def q_constraint_rejects(spark, sf_dir):
    """Second and later rows of a key, and trades whose value does not fit."""
    t, i = fx.trades_with_overflow(spark, sf_dir), fx.info_from_orders(spark, sf_dir)
    _ok, rejects = constraints.check_constraints(asof.enrich_asof(t, i), constraints.ENRICHED_CONSTRAINTS)
    return rejects


# ---- U1, E2, E4, E5, E6, E10 -----------------------------------------------------

@register("union_events", O.with_ctes(O.FIXTURE_CTE) + O.UNION_EVENTS)
def q_union_events(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return events.union_events(t, i)


@register("latest_info", O.with_ctes(O.FIXTURE_CTE) + O.LATEST_INFO)
def q_latest_info(spark, sf_dir):
    _, i = event_inputs(spark, sf_dir)
    return asof.latest_info(i)


@register("forward_fill", O.with_ctes(O.FIXTURE_CTE) + O.FORWARD_FILL)
def q_forward_fill(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    u = events.union_events(t, i)
    filled = asof.forward_fill(u, list(INFO_FIELDS), ["symbol"], ["event_ms", "record_type", "seq"],
                               bucket_on="event_ms", bucket="auto")
    return events.trades_only(filled).select(*t.columns, *INFO_FIELDS)


@register("enrich_seeded", O.ENRICHED_SENTINEL_SQL + "\nSELECT * FROM enriched")
def q_enrich_seeded(spark, sf_dir):
    """Two batches split at a cut time; batch 2 starts from batch 1's carried state."""
    t, i = event_inputs(spark, sf_dir)
    cut = t.agg(F.percentile_approx("trade_timestamp", 0.5)).first()[0]
    t1, t2 = t.where(F.col("trade_timestamp") < cut), t.where(F.col("trade_timestamp") >= cut)
    i1, i2 = i.where(F.col("info_timestamp") < cut), i.where(F.col("info_timestamp") >= cut)
    state = asof.latest_info(i1)
    return asof.enrich_asof(t1, i1).unionByName(asof.enrich_asof(t2, i2, seed=state))


@register("enrich_ttl", O.enriched_sql(ttl_ms=86_400_000) + "\nSELECT * FROM enriched")
def q_enrich_ttl(spark, sf_dir):
    return enriched(spark, sf_dir, ttl="24 hours")


@register("enrich_stats", O.ENRICHED_SENTINEL_SQL + """
SELECT count(*) AS enriched_count, CAST(sum(CASE WHEN info_timestamp = 0 THEN 1 ELSE 0 END) AS BIGINT)
       AS unknown_count FROM enriched""")
def q_enrich_stats(spark, sf_dir):
    return stats.enrich_stats(enriched(spark, sf_dir))


@register("enrich_asof_nulls", O.ENRICHED_NULLS)
def q_enrich_asof_nulls(spark, sf_dir):
    """Trades without a symbol or a time match no info; infos without a symbol serve no trade."""
    t, i = fx.events_with_nulls(spark, sf_dir)
    return asof.enrich_asof(t, i, bucket="1 hour")


@register("forward_fill_nulls", O.FORWARD_FILL_NULLS)
def q_forward_fill_nulls(spark, sf_dir):
    """Rows without a key belong to no series: they keep their values and fill no other row."""
    t, i = fx.events_with_nulls(spark, sf_dir)
    filled = asof.forward_fill(events.union_events(t, i), list(INFO_FIELDS), ["symbol"],
                               ["event_ms", "record_type", "seq"], bucket_on="event_ms", bucket="1 hour")
    return events.trades_only(filled).select(*t.columns, *INFO_FIELDS)


# ---- streaming: S1, S2, E7, W2-W9, K1, K5, K7 --------------------------------------

_M1 = O.metrics_select(60_000)
_M1H = O.metrics_select(3_600_000)


@register("stream_ingest_trades", O.with_ctes(O.FIXTURE_CTE) + "\nSELECT * FROM trades")
def q_stream_ingest_trades(spark, sf_dir):
    """Trades JSON files -> streaming text source -> parse -> replay-safe table."""
    t, _ = event_inputs(spark, sf_dir)
    lay = P.layout(spark, "ingest")

    def start():
        parsed, _rej = topic.parse_trades(topic.read_topic(spark, "trades", path=lay.in_trades))
        return (parsed.writeStream.foreachBatch(lambda df, b: tbl.write_batch(df, lay.trades, b))
                .option("checkpointLocation", lay.ckpt).trigger(availableNow=True).start())

    feed.feed_in_slices({"trades": (t, "trade_timestamp", lay.in_trades)}, 3, [start])
    return tbl.read_table(spark, lay.trades).select(*t.columns)


@register("stream_rejects", O.with_ctes(O.FIXTURE_CTE) + O.STREAM_REJECTS)
def q_stream_rejects(spark, sf_dir):
    """Documents that the parsers turn down, by topic and reason, as the rejects stream keeps them."""
    lay = P.layout(spark, "rejects")
    for rows, folder in zip(event_inputs(spark, sf_dir), (lay.in_trades, lay.in_info), strict=True):
        kind = F.col("seq") % 20
        feed.append_json(rows.where(kind > 1), folder)
        feed.append_json(rows.where(kind == 1).withColumn("symbol", F.lit(None).cast("string")), folder)
        topic.to_json_lines(rows.where(kind == 0)).select(F.substring("value", 1, 10)).write.mode("append").text(folder)
    feed.run_available(lambda: P.start_rejects(spark, lay))
    return tbl.read_table(spark, lay.rejects).groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("stream_dedup_keys", O.with_ctes(O.TIES_CTE) +
          "\nSELECT DISTINCT symbol, trade_timestamp, volume FROM trades")
def q_stream_dedup_keys(spark, sf_dir):
    """Tie-heavy trades (duplicate keys) through dropDuplicatesWithinWatermark: one row per key."""
    t = fx.trades_from_lineitem(spark, sf_dir)
    lay = P.layout(spark, "dedup")
    keys = ["symbol", "trade_timestamp", "volume"]

    def start():
        parsed, _rej = topic.parse_trades(topic.read_topic(spark, "trades", path=lay.in_trades))
        parsed = parsed.withColumn("event_timestamp", F.timestamp_millis("trade_timestamp"))
        out = latest.dedup_stream(parsed, keys, "event_timestamp")
        return (out.writeStream.foreachBatch(lambda df, b: tbl.write_batch(df, lay.trades, b))
                .option("checkpointLocation", lay.ckpt).trigger(availableNow=True).start())

    feed.feed_in_slices({"trades": (t, "trade_timestamp", lay.in_trades)}, 3, [start])
    return tbl.read_table(spark, lay.trades).select(*keys)


@register("stream_enrich", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_stream_enrich(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.enriched_rows(spark, P.run_enrichment_only(spark, t, i, k=3, engine="state"))


@register("stream_enrich_batchwise", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_stream_enrich_batchwise(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.enriched_rows(spark, P.run_enrichment_only(spark, t, i, k=3, engine="batchwise"))


@register("stream_enrich_history_batchwise", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_stream_enrich_history_batchwise(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.enriched_rows(spark, P.run_enrichment_only(spark, t, i, k=3, engine="batchwise", late="history"))


@register("stream_enrich_ttl", O.enriched_sql(ttl_ms=86_400_000) + "\nSELECT * FROM enriched")
def q_stream_enrich_ttl(spark, sf_dir):
    """Stateful enrichment whose per-symbol state expires 24 h after the symbol's newest event."""
    t, i = event_inputs(spark, sf_dir)
    lay = P.run_enrichment_only(spark, t, i, k=3, engine="state", ttl="24 hours", watermark="5 minutes")
    return P.enriched_rows(spark, lay)


@register("stream_enrich_ttl_batchwise", O.enriched_sql(ttl_ms=86_400_000) + "\nSELECT * FROM enriched")
def q_stream_enrich_ttl_batchwise(spark, sf_dir):
    """The same on the foreachBatch engine: each symbol's last event is part of its state."""
    t, i = event_inputs(spark, sf_dir)
    return P.enriched_rows(spark, P.run_enrichment_only(spark, t, i, k=4, ttl="24 hours", name="enrich-ttl"))


@register("stream_enrich_counters", _ENRICHED_SQL + O.batch_counters_sql(3))
def q_stream_enrich_counters(spark, sf_dir):
    """Enriched and unknown trades of every micro-batch of the default engine."""
    t, i = event_inputs(spark, sf_dir)
    lay = P.run_enrichment_only(spark, t, i, k=3, name="enrich-counters")
    return tbl.read_table(spark, lay.counters).select(
        F.col("batch_id").cast("long").alias("batch_id"), "enriched_count", "unknown_count")


@register("stream_enrich_history", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_stream_enrich_history(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.enriched_rows(spark, P.run_enrichment_only(spark, t, i, k=3, late="history", engine="state"))


@register("stream_sector_metrics", _ENRICHED_SQL + _M1)
def q_stream_sector_metrics(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.latest_metrics(spark, P.run_staged(spark, t, i, k=3, width="1 minute"))


@register("stream_sector_metrics_append", _ENRICHED_SQL + O.metrics_cte(60_000) + O.APPEND_CLOSED)
def q_stream_sector_metrics_append(spark, sf_dir):
    """Append mode: a window is emitted once, after the watermark (max event time
    minus 5 minutes) passes its end; windows still open when the input ends are
    not emitted."""
    t, i = event_inputs(spark, sf_dir)
    lay = P.run_staged(spark, t, i, k=3, width="1 minute", output_mode="append", name="append")
    return P.latest_metrics(spark, lay)


@register("staged_enriched", _ENRICHED_SQL + O.SINK_PROJECTION)
def q_staged_enriched(spark, sf_dir):
    """Second hop: the enriched table re-read as a stream into the serving projection."""
    t, i = event_inputs(spark, sf_dir)
    lay = P.run_staged(spark, t, i, k=3, serving=True)
    return tbl.read_table(spark, lay.serving).drop("batch_id", "ingestion_time")


@register("pipeline_staged", _ENRICHED_SQL + _M1H)
def q_pipeline_staged(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.latest_metrics(spark, P.run_staged(spark, t, i, k=3, width="1 hour"))


@register("pipeline_unified", _ENRICHED_SQL + _M1H)
def q_pipeline_unified(spark, sf_dir):
    t, i = event_inputs(spark, sf_dir)
    return P.latest_metrics(spark, P.run_unified(spark, t, i, k=3, width="1 hour"))


@register("early_results", _ENRICHED_SQL + O.emissions_sql(3_600_000, 3))
def q_early_results(spark, sf_dir):
    """Every update-mode emission, unresolved: a window that is still open when a
    batch ends is emitted with its partial totals and again when it grows."""
    t, i = event_inputs(spark, sf_dir)
    lay = P.run_staged(spark, t, i, k=3, width="1 hour", name="early")
    return tbl.read_table(spark, lay.metrics).select(*P.METRIC_COLS)


_DENSE_SQL = O.enriched_sql(fixture=O.DENSE_CTE)
_LATE_METRICS = _DENSE_SQL + O.watermarked_sql(4, O.LATE_ARRIVAL)


@register("stream_enrich_late_history", _DENSE_SQL + "\nSELECT * FROM enriched")
def q_stream_enrich_late_history(spark, sf_dir):
    """Late trades get the info as of their own time, from the infos kept by day."""
    t, i = fx.dense_events(spark, sf_dir)
    lay = P.run_enrichment_only(spark, t, i, k=4, late="history", arrival="arrival_ms", name="late-history")
    return P.enriched_rows(spark, lay)


@register("pipeline_staged_late", _LATE_METRICS)
def q_pipeline_staged_late(spark, sf_dir):
    """Rows behind the watermark of 5 minutes are not counted."""
    t, i = fx.dense_events(spark, sf_dir)
    return P.latest_metrics(spark, P.run_staged(spark, t, i, k=4, arrival="arrival_ms", late="history"))


@register("pipeline_unified_late", _LATE_METRICS)
def q_pipeline_unified_late(spark, sf_dir):
    """The one-query form leaves out the same rows."""
    t, i = fx.dense_events(spark, sf_dir)
    return P.latest_metrics(spark, P.run_unified(spark, t, i, k=4, arrival="arrival_ms", late="history"))


@register("early_event_results", _DENSE_SQL + O.firing_sql(3))
def q_early_event_results(spark, sf_dir):
    """Every emission of one-minute windows that fire at each half minute of event time."""
    t, i = fx.dense_events(spark, sf_dir)
    lay = P.run_firing(spark, t, i, k=3, name="early-event")
    return tbl.read_table(spark, lay.metrics).select(*P.METRIC_COLS, "kind")


@register("late_corrections", _DENSE_SQL + O.firing_sql(3, O.LATE_ARRIVAL))
def q_late_corrections(spark, sf_dir):
    """The same with late trades: into open windows, into closed ones (corrections up to five
    minutes after the end), and later still (dropped)."""
    t, i = fx.dense_events(spark, sf_dir)
    lay = P.run_firing(spark, t, i, k=3, arrival="arrival_ms", name="late-corrections")
    return tbl.read_table(spark, lay.metrics).select(*P.METRIC_COLS, "kind")


# ---- keyed sinks, latest views, retention, compaction, history -------------------

def _ties_enriched(spark, sf_dir):
    t, i = fx.trades_from_lineitem(spark, sf_dir), fx.info_from_orders(spark, sf_dir)
    return asof.enrich_asof(t, i)


@register("dedup_trades", _TIES_SQL + O.DEDUP_TRADES)
def q_dedup_trades(spark, sf_dir):
    return latest.dedup_first(_ties_enriched(spark, sf_dir), ["symbol", "trade_timestamp", "volume"])


@register("upsert_ignore", _TIES_SQL + O.DEDUP_TRADES)
def q_upsert_ignore(spark, sf_dir):
    """Insert-ignore in 3 time-sliced batches, then the last batch replayed. Each batch is enriched by
    itself, from its own infos and the state that earlier ones leave, so no trade is shuffled twice."""
    t, i = fx.trades_from_lineitem(spark, sf_dir), fx.info_from_orders(spark, sf_dir)
    path = scratch_path(spark, "upsert-ignore")
    cuts = feed.time_cuts(t, "trade_timestamp", 3)
    keys = ["symbol", "trade_timestamp", "volume"]

    def batch(b):
        seed = asof.latest_info(i.where(F.col("info_timestamp") < cuts[b - 1])) if b else None
        return asof.enrich_asof(feed.time_slice(t, "trade_timestamp", cuts, b),
                                feed.time_slice(i, "info_timestamp", cuts, b), seed=seed)

    for b in range(len(cuts) + 1):
        upsert.upsert(batch(b), path, b, keys, prune_on="trade_timestamp")
    again = batch(len(cuts))
    upsert.upsert(again, path, len(cuts), keys)
    return tbl.read_table(spark, path).select(*again.columns)


@register("upsert_update", _ENRICHED_SQL + _M1H)
def q_upsert_update(spark, sf_dir):
    """Update-mode emissions (cumulative totals of the windows each batch touches) upserted by key."""
    e = enriched(spark, sf_dir)
    path = scratch_path(spark, "upsert-update")
    cuts = feed.time_cuts(e, "trade_timestamp", 3)
    for b in range(len(cuts) + 1):
        upto = e.where(F.col("trade_timestamp") < cuts[b]) if b < len(cuts) else e
        touched = metrics.sector_metrics(feed.time_slice(e, "trade_timestamp", cuts, b), "1 hour")
        emit = metrics.sector_metrics(upto, "1 hour").join(
            touched.select(*P.METRIC_KEYS), P.METRIC_KEYS, "left_semi")
        upsert.upsert(emit, path, b, P.METRIC_KEYS, policy="update")
    return upsert.latest_view(tbl.read_table(spark, path), P.METRIC_KEYS).select(*P.METRIC_COLS)


def _metrics_log(spark, sf_dir, width="1 hour"):
    """Metrics written through the staged stream into the update log."""
    t, i = event_inputs(spark, sf_dir)
    return P.run_staged(spark, t, i, k=3, width=width, name="latest")


@register("latest_metrics", _ENRICHED_SQL + _M1H)
def q_latest_metrics(spark, sf_dir):
    lay = _metrics_log(spark, sf_dir)
    return latest.latest_per_key(tbl.read_table(spark, lay.metrics), P.METRIC_KEYS,
                                 ["batch_id", "ingestion_time"]).select(*P.METRIC_COLS)


@register("view_sector_latest", _ENRICHED_SQL + O.metrics_cte(3_600_000) +
          "\nSELECT window_start, window_end, sector, trade_count, total_value, avg_price FROM metrics")
def q_view_sector_latest(spark, sf_dir):
    lay = _metrics_log(spark, sf_dir)
    P.latest_sector_view(spark, lay).createOrReplaceTempView("view_sector_latest")
    # ingestion_time, the view's last column, is wall-clock
    return spark.sql("SELECT window_start, window_end, sector, trade_count, total_value, avg_price "
                     "FROM view_sector_latest")


@register("symbol_recent_trades", _ENRICHED_SQL + O.RECENT_TRADES)
def q_symbol_recent_trades(spark, sf_dir):
    return latest.newest_per_key(enriched(spark, sf_dir), ["symbol"], ["trade_timestamp", "seq"], 5)


@register("symbol_recent_trades_sorted", _ENRICHED_SQL + O.RECENT_TRADES + " AND symbol LIKE '%7'")
def q_symbol_recent_trades_sorted(spark, sf_dir):
    """Newest trades of some symbols from a table laid out by symbol and time: its files and row
    groups of other symbols are skipped by their statistics."""
    e = enriched(spark, sf_dir)
    path = scratch_path(spark, "laid-out")
    tbl.write_batch(e, path, 0)
    tbl.compact(spark, path, sort_by=["symbol", "trade_timestamp"])
    symbols = [r[0] for r in e.where(F.col("symbol").like("%7")).select("symbol").distinct().orderBy("symbol").collect()]
    rows = tbl.read_table(spark, path).where(F.col("symbol").isin(symbols)).select(*e.columns)
    return latest.newest_per_key(rows, ["symbol"], ["trade_timestamp", "seq"], 5)


@register("retention_kept", _ENRICHED_SQL + O.metrics_cte(60_000) +
          O.RETENTION_KEPT)
def q_retention_kept(spark, sf_dir):
    """Metrics stamped with ingestion_time = window_end, then rows older than 2 days deleted."""
    m = metrics.sector_metrics(enriched(spark, sf_dir), "1 minute")
    path = scratch_path(spark, "retain")
    tbl.write_batch(m.withColumn("ingestion_time", F.col("window_end")), path, 0, stamp_ingestion=False,
                    day_of="ingestion_time")
    now = m.agg(F.max("window_end")).first()[0]
    tbl.retain(spark, path, "ingestion_time", "2 days", now=now)
    return tbl.read_table(spark, path).drop("batch_id")


def _sliced_table(spark, sf_dir, k=3):
    e = enriched(spark, sf_dir)
    path = scratch_path(spark, "compact")
    cuts = feed.time_cuts(e, "trade_timestamp", k)
    for b in range(len(cuts) + 1):
        tbl.write_batch(feed.time_slice(e, "trade_timestamp", cuts, b), path, b)
    return e, path


@register("compact_same_rows", _ENRICHED_SQL + "\nSELECT * FROM enriched")
def q_compact_same_rows(spark, sf_dir):
    e, path = _sliced_table(spark, sf_dir)
    tbl.compact(spark, path)
    return tbl.read_table(spark, path).select(*e.columns)


@register("commit_history", _ENRICHED_SQL + O.commit_history_sql(3))
def q_commit_history(spark, sf_dir):
    _e, path = _sliced_table(spark, sf_dir)
    tbl.compact(spark, path)
    return tbl.recent_history(spark, path, 5).select("version", "operation", "rows")
