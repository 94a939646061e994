"""Event-time firing, late corrections, and the state of the foreachBatch engine."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from support import day

from tidemark.operators import asof
from tidemark.plans import pipelines as P
from tidemark.sinks import table as tbl
from tidemark.streaming import enrich_batches as EB
from tidemark.streaming import feed

MIN, SEC = 60_000, 1000
T0 = day("10:00")


def _emissions(spark, mk, slices):
    """Feeds slices of (ms after T0, volume) trades of one sector; the emissions a slice, in order:
    (window minute, trades, volume, kind)."""
    lay = P.layout(spark, "t-firing")
    feed.append_json(mk.info([("S", T0 - 10 * MIN, 1, "A")]), lay.in_info)
    out, seq = [], 10
    for rows in slices:
        trades = []
        for ms, volume in rows:
            seq += 1
            trades.append(("S", T0 + ms, seq, "2.00", volume))
        feed.append_json(mk.trades(trades), lay.in_trades)
        feed.run_available(lambda: P.start_enrichment(spark, lay, late="history"))
        had = tbl.read_table(spark, lay.metrics).count() if out else 0
        feed.run_available(lambda: P.start_firing_metrics(spark, lay))
        m = tbl.read_table(spark, lay.metrics)
        got = m.select(((F.unix_millis("window_start") - T0) / MIN).cast("int").alias("w"), "trade_count", "total_volume",
                       "kind", "batch_id").collect()
        got = sorted((r.batch_id, r.w, r.trade_count, r.total_volume, r.kind) for r in got)[had:]
        out.append([g[1:] for g in got])
    return out


def test_windows_fire_close_and_are_corrected(spark, mk):
    got = _emissions(spark, mk, [
        [(5 * SEC, 1), (40 * SEC, 2)],                 # clock at 0:35: the mark at 0:30 has passed
        [(44 * SEC, 4)],                               # clock at 0:39: no new mark
        [(50 * SEC, 8), (70 * SEC, 16)],               # clock at 1:05: the first window closes
        [(20 * SEC, 32), (4 * MIN, 64)],               # late into a closed window: corrected
        [(30 * SEC, 128), (6 * MIN + 10 * SEC, 1)],    # again; then the clock is at 6:05
        [(59 * SEC, 256), (61 * SEC, 512)],            # the first window is gone, the second is not
    ])
    assert got[0] == [(0, 2, 3, "early")]
    assert got[1] == []
    assert got[2] == [(0, 4, 15, "final")]
    assert sorted(got[3]) == [(0, 5, 47, "correction"), (1, 1, 16, "final")]
    assert sorted(got[4]) == [(0, 6, 175, "correction"), (4, 1, 64, "final")]
    assert got[5] == [(1, 2, 528, "correction")]


def test_an_unchanged_window_fires_once_and_a_closed_one_always(spark, mk):
    got = _emissions(spark, mk, [[(5 * SEC, 1), (40 * SEC, 0)], [(50 * SEC + 5 * MIN, 1)]])
    assert got[0] == [(0, 2, 1, "early")]
    assert (0, 2, 1, "final") in got[1]


@pytest.mark.parametrize("cut", [1, 2, 3, 5])
def test_ttl_counts_gaps_between_batches(spark, mk, cut):
    """However the events are cut into batches, the foreachBatch engine gives the batch result."""
    H = 60 * MIN
    trades = [("S", T0 + int(h * H), 100 + k) for k, h in enumerate([1, 20, 50, 51, 76, 76.5, 120])]
    trades += [("X", T0 + 5 * H, 200), ("X", T0 + 40 * H, 201)]
    info = [("S", T0, 1, "A"), ("S", T0 + 44 * H, 2, "B"), ("S", T0 + 75 * H, 3, "C"), ("X", T0 + 39 * H, 4, "D"),
            ("Y", T0 + 2 * H, 5, "E")]
    want = asof.enrich_asof(mk.trades(trades), mk.info(info), ttl="24 hours")
    lay = P.layout(spark, "t-ttl")
    events = sorted([(ms, 1, r) for r in trades for ms in [r[1]]] + [(r[1], 0, r) for r in info], key=lambda e: e[:2])
    for k in range(0, len(events), -(-len(events) // cut)):
        part = events[k:k + -(-len(events) // cut)]
        feed.append_json(mk.trades([r for _, kind, r in part if kind]), lay.in_trades)
        feed.append_json(mk.info([r for _, kind, r in part if not kind]), lay.in_info)
        feed.run_available(lambda: P.start_enrichment(spark, lay, ttl="24 hours"))
    assert sorted(map(tuple, P.enriched_rows(spark, lay).collect())) == sorted(map(tuple, want.collect()))


def test_carried_state_holds_the_symbols_of_the_batch_only(spark, mk):
    path = P.layout(spark, "t-state").state
    idle = [(f"I{k}", T0, k, "A") for k in range(500)]
    tbl.write_batch(asof.latest_info(mk.info([*idle, ("S", T0, 900, "B")])), path, 0, stamp_ingestion=False)
    seen = spark.createDataFrame([("S",), ("new",)], "symbol string")
    seed = EB.carried_state(spark, path, 1, seen)
    assert [(r.symbol, r.sector) for r in seed.collect()] == [("S", "B")]
    # idle symbols are dropped ahead of the aggregate and of its exchange
    plan = seed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_a_late_trade_reads_the_folders_of_its_day(spark, mk):
    lay = P.layout(spark, "t-days")
    D = EB.DAY_MS
    d0 = T0 // D
    for k in range(6):                                      # a day a batch
        feed.append_json(mk.info([("S", T0 + k * D - 1, 10 + k, f"A{k}"), (f"I{k}", T0 + k * D, 50 + k, "Z")]), lay.in_info)
        feed.append_json(mk.trades([("S", T0 + k * D, 100 + k)]), lay.in_trades)
        feed.run_available(lambda: P.start_enrichment(spark, lay, late="history"))
    days = EB.InfoDays(spark, lay.info_log)
    known = days.known([d0 + 2], 6)
    files = [r[0] for r in known.select(F.input_file_name()).distinct().collect()]
    assert {f.split("/day=")[1].split("/")[0] for f in files} == {str(d0 + 2)}
    # the other days are pruned by their folders, not read and filtered
    assert len(re.findall(r"PartitionFilters: \[[^\]]*day#\d+L? [=I]", known._jdf.queryExecution().toString())) >= 2
    # an info that comes late changes the days after its own
    feed.append_json(mk.info([("S", T0 + D + 5, 70, "late")]), lay.in_info)
    feed.append_json(mk.trades([("S", T0 + D + 4, 200)]), lay.in_trades)
    feed.run_available(lambda: P.start_enrichment(spark, lay, late="history"))
    feed.append_json(mk.trades([("S", T0 + D + 6, 201), ("S", T0 + 2 * D - 2, 202), ("S", T0 + 7 * D, 203),
                                ("S", T0 - 2 * D, 204), ("I3", T0 + 9 * D, 205)]), lay.in_trades)
    feed.run_available(lambda: P.start_enrichment(spark, lay, late="history"))
    got = {r.seq: r.sector for r in P.enriched_rows(spark, lay).collect()}
    assert [got[100 + k] for k in range(6)] == [f"A{k}" for k in range(6)]
    assert [got[k] for k in range(200, 206)] == ["A1", "late", "late", "A5", "UNKNOWN", "Z"]


def test_replayed_history_batch_sees_what_the_first_run_saw(spark, mk):
    from tidemark.streaming.enrich_stream import stream_union

    lay = P.layout(spark, "t-replay-days")
    batches = [([("S", T0, 2)], [("S", T0 - 1, 1, "A")]), ([("S", T0 + EB.DAY_MS, 4)], [("S", T0 + 5, 3, "B")])]
    for n, (t, i) in enumerate(batches):
        EB.enrich_micro_batch_history(stream_union(mk.trades(t), mk.info(i)), n, lay.enriched, lay.info_log)
    before = sorted(map(str, EB.InfoDays(spark, lay.info_log)._read("before", 9).collect()))
    t, i = batches[1]
    EB.enrich_micro_batch_history(stream_union(mk.trades(t), mk.info(i)), 1, lay.enriched, lay.info_log)
    assert sorted(map(str, EB.InfoDays(spark, lay.info_log)._read("before", 9).collect())) == before
    assert sorted(r.sector for r in P.enriched_rows(spark, lay).collect()) == ["A", "B"]


def test_metrics_leave_out_the_same_late_rows_in_both_forms(spark, mk):
    """One query or two: a row behind the watermark counts in neither."""
    trades = [("S", T0, 1, "1.00", 1), ("S", T0 + 20 * MIN, 2, "1.00", 2), ("S", T0 + 10 * MIN, 3, "1.00", 4),
              ("S", T0 + 16 * MIN, 4, "1.00", 8)]
    got = []
    for start in ([lambda: P.start_enrichment(spark, lay), lambda: P.start_metrics(spark, lay)],
                  [lambda: P.start_unified(spark, lay)]):
        lay = P.layout(spark, "t-late-forms")
        feed.append_json(mk.info([("S", T0 - MIN, 9, "A")]), lay.in_info)
        for part in (trades[:2], trades[2:]):
            feed.append_json(mk.trades(part), lay.in_trades)
            for s in start:
                feed.run_available(s)
        got.append(sorted(map(tuple, P.latest_metrics(spark, lay).collect())))
    assert got[0] == got[1] and sorted(r[-1] for r in got[0]) == [1, 2, 8]


def test_windows_fire_in_a_session_with_the_default_state_store(spark, mk):
    """A session that is not built here names no state store; the operator needs RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    had = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert _emissions(spark, mk, [[(5 * SEC, 1), (40 * SEC, 2)]]) == [[(0, 2, 3, "early")]]
    finally:
        spark.conf.set(key, had)
