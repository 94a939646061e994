"""Keyed sinks, constraints, retention, compaction and the metrics rounding rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from support import day
from pyspark.sql import functions as F

from tidemark.operators import constraints, metrics
from tidemark.session import scratch_path
from tidemark.sinks import table as tbl
from tidemark.sinks import upsert


def test_insert_ignore_within_and_across_batches(spark, mk):
    path = scratch_path(spark, "t-ignore")
    keys = ["symbol", "trade_timestamp", "volume"]
    b0 = mk.trades([("S", day("10:00"), 2, "1.00", 5), ("S", day("10:00"), 1, "2.00", 5)])
    upsert.upsert(b0, path, 0, keys)
    b1 = mk.trades([("S", day("10:00"), 3, "3.00", 5), ("S", day("10:01"), 4, "4.00", 5)])
    upsert.upsert(b1, path, 1, keys)
    rows = sorted((r.seq, str(r.price)) for r in tbl.read_table(spark, path).collect())
    assert rows == [(1, "2.00"), (4, "4.00")]
    # replaying a committed batch changes nothing
    upsert.upsert(b1, path, 1, keys)
    assert tbl.read_table(spark, path).count() == 2


def test_insert_ignore_joins_only_where_keys_can_meet(spark, mk, monkeypatch):
    """A batch whose range the table does not reach is written without a join, and no row of it is lost."""
    from pyspark.sql.classic.dataframe import DataFrame

    path, keys, joins = scratch_path(spark, "t-ignore-range"), ["symbol", "trade_timestamp", "volume"], []
    join = DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda self, *a, **k: joins.append(a[-1]) or join(self, *a, **k))
    batches = [[("S", day("10:00"), 1)], [("S", day("11:00"), 2), ("S", day("11:00"), 3), ("S", None, 4)],
               [("S", None, 5)], [("S", day("10:30"), 6), ("S", day("11:00"), 7)]]
    for n, rows in enumerate(batches):
        upsert.upsert(mk.trades(rows), path, n, keys, prune_on="trade_timestamp")
        assert joins.count("left_anti") == (n == 3)
    assert sorted(r.seq for r in tbl.read_table(spark, path).collect()) == [1, 2, 4, 5, 6]


def test_upsert_update_latest_wins_and_replay(spark):
    path = scratch_path(spark, "t-update")
    w = dt.datetime(2024, 1, 1, 10, 0)
    schema = "window_start timestamp, sector string, trade_count bigint"
    upsert.upsert(spark.createDataFrame([(w, "S", 1)], schema), path, 0, ["window_start", "sector"], policy="update")
    upsert.upsert(spark.createDataFrame([(w, "S", 2)], schema), path, 1, ["window_start", "sector"], policy="update")
    view = upsert.latest_view(tbl.read_table(spark, path), ["window_start", "sector"])
    assert [r.trade_count for r in view.collect()] == [2]
    # replay batch 0 (its folder is rewritten) - batch 1 still wins: order is batch_id
    upsert.upsert(spark.createDataFrame([(w, "S", 1)], schema), path, 0, ["window_start", "sector"], policy="update")
    view = upsert.latest_view(tbl.read_table(spark, path), ["window_start", "sector"])
    assert [r.trade_count for r in view.collect()] == [2]


def test_constraint_rejects_with_reasons(spark, mk):
    from tidemark.operators import asof

    info = mk.info([("SYMBOL123", day("09:00"), 0, "A"), ("S", day("09:00"), 9, "A")])
    trades = mk.trades([("SYMBOL123", day("10:00"), 1), ("S", day("10:00"), 2), ("S", day("10:00"), 3)])
    e = asof.enrich_asof(trades, info)
    e = e.unionByName(e.limit(0)).withColumn(
        "price", F.when(F.col("seq") == 2, F.lit(None)).otherwise(F.col("price")))
    extra = mk.trades([("S", day("11:00"), 4)])
    e = e.unionByName(asof.enrich_asof(extra, info)).unionByName(asof.enrich_asof(extra, info))
    ok, rej = constraints.check_constraints(e, constraints.ENRICHED_CONSTRAINTS)
    reasons = sorted(r.reason for r in rej.collect())
    assert reasons == ["duplicate key", "price is null", "symbol longer than 8"]
    assert ok.count() == 2


def test_retention_keeps_row_exactly_at_limit(spark):
    path = scratch_path(spark, "t-retain")
    now = dt.datetime(2024, 1, 10, 12, 0)
    rows = [(1, now - dt.timedelta(days=1)), (2, now - dt.timedelta(days=2)), (3, now - dt.timedelta(days=3))]
    df = spark.createDataFrame(rows, "id int, ingestion_time timestamp")
    tbl.write_batch(df, path, 0, stamp_ingestion=False)
    tbl.retain(spark, path, "ingestion_time", "2 days", now=now)
    assert sorted(r.id for r in tbl.read_table(spark, path).collect()) == [1, 2]
    assert [r.operation for r in tbl.recent_history(spark, path).collect()] == ["delete", "append"]


def test_compaction_same_rows_fewer_files(spark, mk):
    path = scratch_path(spark, "t-compact")
    for b in range(4):
        df = mk.trades([("S", day("10:00") + i, b * 100 + i) for i in range(20)]).repartition(3)
        tbl.write_batch(df, path, b)
    before = sorted(tuple(r) for r in tbl.read_table(spark, path).drop("ingestion_time", "batch_id").collect())
    _, files_before = tbl.table_bytes(spark, path)
    tbl.compact(spark, path)
    _, files_after = tbl.table_bytes(spark, path)
    after = sorted(tuple(r) for r in tbl.read_table(spark, path).drop("ingestion_time", "batch_id").collect())
    assert before == after and files_after < files_before and files_after == 1
    h = tbl.recent_history(spark, path, 5).collect()
    assert [r.operation for r in h][:1] == ["compact"] and h[0].version == 4


def test_avg_rounds_half_up(spark):
    # 128 prices: one 0.01, the rest 0.00; the average 0.000078125 is an exact half
    rows = [("S", Decimal("0.01") if i == 0 else Decimal("0.00"), 1, 1_704_103_200_000 + i, i) for i in range(128)]
    e = spark.createDataFrame(rows, "sector string, price decimal(18,2), volume int, trade_timestamp bigint, seq bigint")
    e = e.withColumn("trade_value", (F.col("price") * F.col("volume")).cast("decimal(28,8)"))
    r = metrics.sector_metrics(e, "1 hour").first()
    assert str(r.avg_price) == "0.00007813" and r.trade_count == 128


def test_latest_per_key_and_newest_n(spark):
    from tidemark.operators import latest

    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 30), ("b", 1, 5)], "k string, t int, v int")
    assert sorted(tuple(r) for r in latest.latest_per_key(df, ["k"], ["t"]).collect()) == [("a", 3, 30), ("b", 1, 5)]
    top = latest.newest_per_key(df, ["k"], ["t"], 2).collect()
    assert sorted((r.k, r.t, r.rank) for r in top) == [("a", 2, 2), ("a", 3, 1), ("b", 1, 1)]


def test_retention_drops_old_folders_unread(spark):
    path = scratch_path(spark, "t-retain2")
    now = dt.datetime(2024, 1, 10, 12, 0)
    schema = "id int, ingestion_time timestamp"
    rows = [[(1, now - dt.timedelta(days=5))], [(2, now - dt.timedelta(days=3)), (3, now - dt.timedelta(hours=1))],
            [(4, now), (5, None), (6, now - dt.timedelta(days=2, hours=1))]]
    for b, part in enumerate(rows):
        tbl.write_batch(spark.createDataFrame(part, schema), path, b, stamp_ingestion=False, day_of="ingestion_time")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("retain", "retain")
    tbl.retain(spark, path, "ingestion_time", "2 days", now=now)
    assert list(jobs.getJobIdsForGroup("retain")) == []                  # nothing is read
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.id for r in tbl.read_table(spark, path).collect()) == [3, 4, 5]
    days = {b: tbl._values(spark, f"{path}/data/batch_id={b}", "day") for b in range(3)}
    assert [len(days[b]) for b in range(3)] == [0, 1, 3]                 # the day of the limit stays, filtered
    last = tbl.recent_history(spark, path, 1).first()
    assert last.operation == "delete" and last.version == 3
    tbl.retain(spark, path, "ingestion_time", "0 days", now=now + dt.timedelta(days=9))
    assert [r.id for r in tbl.read_table(spark, path).collect()] == [5]
    tbl.compact(spark, path)
    assert [(r.id, r.batch_id) for r in tbl.read_table(spark, path).collect()] == [(5, 2)]


def test_reads_after_a_rewrite_take_its_rows_and_later_batches(spark, mk):
    path = scratch_path(spark, "t-base")
    for b in range(3):
        tbl.write_batch(mk.trades([("S", day("10:00"), b)]), path, b)
    tbl.compact(spark, path)
    tbl.write_batch(mk.trades([("S", day("10:00"), 3)]), path, 3)
    tbl.fold_before(spark, path, 3, lambda rows: rows.where("seq <> 1"))
    got = sorted((r.seq, r.batch_id) for r in tbl.read_table(spark, path).collect())
    assert got == [(0, 2), (2, 2), (3, 3)]
    assert tbl.live_dirs(spark, path) == ["base/upto=2/gen=1", "data/batch_id=3"]
    plan = tbl.read_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan                # earlier batches are pruned
    seen = sorted(r.batch_id for r in spark.read.parquet(f"{path}/data").collect())
    assert seen == [0, 1, 2, 3]                                           # streams still find all


def test_compaction_leaves_large_files(spark, mk):
    path = scratch_path(spark, "t-compact2")
    for b in range(3):
        tbl.write_batch(mk.trades([("S", day("10:00") + i, b * 100 + i) for i in range(10)]).repartition(2), path, b)
    assert tbl.compact(spark, path, target_bytes=1) == -1  # every file already "large"
    v = tbl.compact(spark, path)
    assert v == 3 and tbl.table_bytes(spark, path)[1] == 1


def test_jdbc_sink_reraises(spark, mk):
    """No database is started: an unknown JDBC URL must fail the batch, not be swallowed."""
    import pytest

    from tidemark.sinks.jdbc import jdbc_sink

    sink = jdbc_sink("jdbc:tidemark-none://nowhere/db", "enriched_trades")
    with pytest.raises(Exception):
        sink(mk.trades([("S", day("10:00"), 1)]), 0)


def test_overflowing_trade_is_rejected_with_a_reason(mk):
    from decimal import Decimal

    from tidemark.operators.asof import enrich_asof
    from tidemark.operators.constraints import ENRICHED_CONSTRAINTS, check_constraints

    t = mk.trades([("A", 1000, 0, Decimal("9999999999999999.99"), 2_000_000_000), ("A", 1001, 1)])
    ok, bad = check_constraints(enrich_asof(t, mk.info([])), ENRICHED_CONSTRAINTS)
    assert [r.seq for r in ok.collect()] == [1]
    assert [(r.seq, r.reason) for r in bad.collect()] == [(0, "trade_value out of decimal(28,8)")]


def test_batch_id_of_another_query_is_an_error(spark, monkeypatch):
    from pyspark import SparkContext

    from tidemark.session import scratch_path
    from tidemark.sinks import table as tbl

    path = scratch_path(spark, "other-query")
    query = {"id": "q1"}
    monkeypatch.setattr(SparkContext, "getLocalProperty", lambda self, key: query["id"])
    tbl.write_batch(spark.range(3), path, 0)
    assert tbl.write_batch(spark.range(5), path, 0) == -1      # a replay writes nothing
    files = sorted(r[0] for r in spark.read.parquet(f"{path}/data").selectExpr("_metadata.file_path").distinct().collect())
    tbl.write_batch(spark.range(5), path, 0)
    assert files == sorted(r[0] for r in spark.read.parquet(f"{path}/data").selectExpr("_metadata.file_path")
                           .distinct().collect())
    assert tbl.read_table(spark, path).count() == 3
    query["id"] = "q2"
    with pytest.raises(ValueError, match="another query"):
        tbl.write_batch(spark.range(2), path, 0)
    assert tbl.read_table(spark, path).count() == 3


def test_batchwise_refuses_what_it_cannot_do(spark):
    from tidemark.plans.pipelines import layout, start_enrichment

    for kw in ({"ttl": "24 hours", "late": "history"}, {"watermark": "5 minutes"}):
        with pytest.raises(ValueError, match="ttl|batchwise"):
            start_enrichment(spark, layout(spark, "refuse"), **kw)


def test_sorted_layout_skips_files_of_other_symbols(spark, mk):
    path = scratch_path(spark, "t-sorted")
    for b in range(2):
        tbl.write_batch(mk.trades([(f"S{i % 40:02d}", day("10:00") + i * 7 % 1000, b * 4000 + i) for i in range(4000)]), path, b)
    size, _ = tbl.table_bytes(spark, path)
    tbl.compact(spark, path, target_bytes=size // 8, sort_by=["symbol", "trade_timestamp"])
    spans = spark.read.parquet(f"{path}/base").groupBy(F.input_file_name()).agg(
        F.min("symbol").alias("lo"), F.max("symbol").alias("hi")).orderBy("lo").collect()
    assert len(spans) >= 6 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
    wanted = tbl.read_table(spark, path).where("symbol = 'S07'")
    assert "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,S07)]" in wanted._jdf.queryExecution().executedPlan().toString()
    assert wanted.count() == 200 and sum(s.lo <= "S07" <= s.hi for s in spans) <= 2
