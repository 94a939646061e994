"""Long-running deployment of the staged pipeline.

    spark-submit -m tidemark.plans.app --bootstrap host:9092 --root s3://bucket/path

Reads the two topics, runs the enrichment query and the metrics query (and
the serving copy) side by side with processing-time triggers, each with its
own checkpoint, and waits for any of them to stop (then fails the app so the
scheduler restarts it from the checkpoints). With ``--files`` the topics are
JSON-lines folders instead of Kafka.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import sink_projection
from ..operators.metrics import sector_metrics
from ..session import build_session
from ..sinks import table as tbl
from ..sinks.upsert import upsert
from ..sources.topic import parse_info, parse_trades, read_topic
from ..streaming.enrich_batches import enrich_micro_batch
from ..streaming.enrich_stream import stream_union
from ..operators.constraints import METRICS_CONSTRAINTS
from .pipelines import _ENRICHED_TABLE_SCHEMA, METRIC_KEYS, ROW_CHECKS, Layout, start_rejects, write_checked


def start_all(spark: SparkSession, lay: Layout, *, bootstrap: str | None, files: bool, max_per_trigger: int | None,
              enrich_every: str, metrics_every: str, serving_every: str, width: str, watermark: str,
              fold_every: int = 100):
    def topic(name: str) -> DataFrame:
        if files:
            return read_topic(spark, name, path=f"{lay.root}/in_{name}", max_per_trigger=max_per_trigger)
        return read_topic(spark, name, bootstrap=bootstrap, max_per_trigger=max_per_trigger)

    def parsed(name, parse):
        raw = topic(name)
        return parse(raw, seq_from="offset")[0] if "offset" in raw.columns else parse(raw)[0]

    for d in (f"{lay.enriched}/data", f"{lay.root}/in_stock-trades", f"{lay.root}/in_stock-info"):
        fs, p = tbl._fs(spark, d)
        fs.mkdirs(p)
    t, i = parsed("stock-trades", parse_trades), parsed("stock-info", parse_info)
    q_enrich = (stream_union(t, i).writeStream.queryName("enrich")
                .foreachBatch(lambda df, b: enrich_micro_batch(df, b, lay.enriched, lay.enrich_state))
                .option("checkpointLocation", lay.ckpt_enrich).trigger(processingTime=enrich_every).start())

    src = tbl.read_table_stream(spark, lay.enriched, _ENRICHED_TABLE_SCHEMA)
    m = sector_metrics(src.drop("batch_id", "ingestion_time"), width, watermark=watermark)
    def metrics_sink(df: DataFrame, b: int) -> None:
        write_checked(df, lay.metrics, b, METRICS_CONSTRAINTS,
                      lambda ok: upsert(ok, lay.metrics, b, METRIC_KEYS, policy="update"))
        if b > 0 and b % fold_every == 0:
            tbl.compact(spark, lay.metrics, keys=METRIC_KEYS)  # fold the update log

    q_metrics = (m.writeStream.queryName("metrics").outputMode("update")
                 .foreachBatch(metrics_sink)
                 .option("checkpointLocation", lay.ckpt_metrics).trigger(processingTime=metrics_every).start())

    src2 = tbl.read_table_stream(spark, lay.enriched, _ENRICHED_TABLE_SCHEMA)
    q_serving = (src2.writeStream.queryName("serving")
                 .foreachBatch(lambda df, b: write_checked(
                     df.where(F.col("symbol").isNotNull()), lay.serving, b, ROW_CHECKS,
                     lambda ok: tbl.write_batch(sink_projection(ok), lay.serving, b)))
                 .option("checkpointLocation", lay.ckpt_serving).trigger(processingTime=serving_every).start())
    q_rejects = start_rejects(spark, lay, {"trades": topic("stock-trades"), "info": topic("stock-info")},
                              processingTime=serving_every)
    return [q_enrich, q_metrics, q_serving, q_rejects]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--bootstrap")
    ap.add_argument("--files", action="store_true")
    ap.add_argument("--root", required=True)
    ap.add_argument("--max-per-trigger", type=int, help="intake cap a trigger; none unless given")
    ap.add_argument("--enrich-every", default="1 minute")
    ap.add_argument("--metrics-every", default="1 minute")
    ap.add_argument("--serving-every", default="30 seconds")
    ap.add_argument("--width", default="1 minute")
    ap.add_argument("--watermark", default="5 minutes")
    a = ap.parse_args(argv)
    spark = build_session(extra={"spark.scheduler.mode": "FAIR"})
    queries = start_all(spark, Layout(a.root.rstrip("/")), bootstrap=a.bootstrap, files=a.files,
                        max_per_trigger=a.max_per_trigger, enrich_every=a.enrich_every,
                        metrics_every=a.metrics_every, serving_every=a.serving_every,
                        width=a.width, watermark=a.watermark)
    spark.streams.awaitAnyTermination()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()
    raise SystemExit("a streaming query stopped")


if __name__ == "__main__":
    main()
