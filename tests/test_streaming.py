"""Streaming behaviour on explicit micro-batches."""

from __future__ import annotations

import pytest
from support import day, ms
from pyspark.sql import functions as F

from tidemark.plans import pipelines as P
from tidemark.sinks import table as tbl
from tidemark.sources import topic
from tidemark.streaming import feed


def _run(spark, mk, batches, **kw):
    """batches: list of (trade rows, info rows). One availableNow run per batch."""
    lay = P.layout(spark, "t-stream")
    for trades, infos in batches:
        feed.append_json(mk.trades(trades), lay.in_trades)
        feed.append_json(mk.info(infos), lay.in_info)
        feed.run_available(lambda: P.start_enrichment(spark, lay, **kw))
    return lay


def _sectors(spark, lay):
    return [r.sector for r in P.enriched_rows(spark, lay).orderBy("trade_timestamp", "seq").collect()]


ENGINES = [dict(engine="batchwise"), dict(engine="state")]


@pytest.mark.parametrize("kw", ENGINES)
def test_stale_info_in_later_batch_stream(spark, mk, kw):
    lay = _run(spark, mk, [([], [("S", day("10:05"), 1, "B")]),
                           ([("S", day("10:06"), 3)], [("S", day("10:00"), 2, "A")])], **kw)
    assert _sectors(spark, lay) == ["B"]


@pytest.mark.parametrize("kw,want", [(dict(engine="batchwise"), "B"), (dict(engine="state"), "B"),
                                     (dict(engine="state", late="history", watermark="2 hours"), "A"),
                                     (dict(engine="batchwise", late="history"), "A")])
def test_late_trade_current_state_vs_history(spark, mk, kw, want):
    lay = _run(spark, mk, [([], [("S", day("10:00"), 1, "A")]),
                           ([], [("S", day("12:00"), 2, "B")]),
                           ([("S", day("11:00"), 3)], [])], **kw)
    assert _sectors(spark, lay) == [want]


def test_history_mode_drops_trades_behind_watermark(spark, mk):
    # the exactness horizon of late='history' is the watermark delay
    lay = _run(spark, mk, [([], [("S", day("10:00"), 1, "A")]),
                           ([], [("S", day("12:00"), 2, "B")]),
                           ([("S", day("11:00"), 3), ("S", day("12:01"), 4)], [])],
               engine="state", late="history", watermark="5 minutes")
    assert _sectors(spark, lay) == ["B"]


def test_bad_json_goes_to_rejects(spark):
    lines = ['{bad', '{"symbol": null, "price": 1.0, "volume": 1, "trade_timestamp": 5, "seq": 1}',
             '{"symbol": "S", "price": 1.0, "volume": 1, "trade_timestamp": null, "seq": 2}',
             '{"symbol": "S", "price": 1.239, "volume": 1, "trade_timestamp": 7, "seq": 3}']
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    ok, rej = topic.parse_trades(raw)
    assert [(r.symbol, str(r.price)) for r in ok.collect()] == [("S", "1.24")]
    assert sorted(r.reason for r in rej.collect()) == ["malformed", "null symbol", "null trade_timestamp"]


def _metrics_run(spark, mk, batches, output_mode="update"):
    lay = P.layout(spark, "t-metrics")
    for trades in batches:
        feed.append_json(mk.trades(trades), lay.in_trades)
        feed.append_json(mk.info([]), lay.in_info)
        feed.run_available(lambda: P.start_enrichment(spark, lay))
        feed.run_available(lambda: P.start_metrics(spark, lay, "1 minute", output_mode=output_mode))
    return {r.window_start.strftime("%H:%M") for r in P.latest_metrics(spark, lay).collect()}


def test_late_row_behind_watermark_is_dropped(spark, mk):
    got = _metrics_run(spark, mk, [[("S", day("10:00"), 1)], [("S", day("12:00"), 2)],
                                   [("S", day("12:00:02"), 3)], [("S", day("11:00"), 4)]])
    assert "11:00" not in got and {"10:00", "12:00"} <= got


def test_append_holds_back_open_window(spark, mk):
    batches = [[("S", day("10:00"), 1)], [("S", day("10:20"), 2)]]
    upd = _metrics_run(spark, mk, batches, "update")
    app = _metrics_run(spark, mk, batches, "append")
    assert upd == {"10:00", "10:20"} and app == {"10:00"}


def test_restart_replays_last_batch_without_duplicates(spark, mk):
    lay = _run(spark, mk, [([("S", day("10:01"), 2)], [("S", day("10:00"), 1, "A")]),
                           ([("S", day("10:03"), 4)], [("S", day("10:02"), 3, "B")])])
    before = sorted(tuple(r) for r in P.enriched_rows(spark, lay).collect())
    fs, p = tbl._fs(spark, f"{lay.ckpt_enrich}/commits")
    last = max(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())
    fs.delete(tbl._fs(spark, f"{lay.ckpt_enrich}/commits/{last}")[1], False)
    feed.run_available(lambda: P.start_enrichment(spark, lay))  # re-executes batch `last`
    after = sorted(tuple(r) for r in P.enriched_rows(spark, lay).collect())
    assert before == after and len(after) == 2


def test_sink_errors_propagate(spark, mk):
    lay = P.layout(spark, "t-fail")
    feed.append_json(mk.trades([("S", day("10:00"), 1)]), lay.in_trades)

    def boom(df, batch_id):
        raise RuntimeError("sink down")

    def start():
        src = topic.read_topic(spark, "trades", path=lay.in_trades)
        return (src.writeStream.foreachBatch(boom).option("checkpointLocation", lay.ckpt)
                .trigger(availableNow=True).start())

    with pytest.raises(Exception):
        feed.run_available(start)


def test_rate_limit_one_file_per_trigger(spark, mk):
    lay = P.layout(spark, "t-rate")
    for i in range(3):
        feed.append_json(mk.trades([("S", day("10:00") + i, i)]).coalesce(1), lay.in_trades)

    def start():
        src, _ = topic.parse_trades(topic.read_topic(spark, "trades", path=lay.in_trades, max_per_trigger=1))
        return (src.writeStream.foreachBatch(lambda df, b: tbl.write_batch(df, lay.out, b))
                .option("checkpointLocation", lay.ckpt).trigger(availableNow=True).start())

    feed.run_available(start)
    assert len(tbl.committed_batches(spark, lay.out)) == 3


def test_observed_enrichment_counters(spark, mk):
    lay = P.layout(spark, "t-observe")
    feed.append_json(mk.trades([("S", day("10:01"), 2), ("X", day("10:01"), 3)]), lay.in_trades)
    feed.append_json(mk.info([("S", day("10:00"), 1, "A")]), lay.in_info)
    q = P.start_enrichment(spark, lay, engine="state")
    q.awaitTermination()
    seen = [p["observedMetrics"]["enrich"] for p in q.recentProgress if "enrich" in p.get("observedMetrics", {})]
    assert seen and seen[0]["enriched_count"] == 2 and seen[0]["unknown_count"] == 1
    assert ms("2024-01-01 10:00") == day("10:00")


@pytest.mark.parametrize("batches,want", [
    # gap of 25 h between the first trade and the second: the info expired
    ([([("S", day("11:00", 1), 2)], [("S", day("10:00", 1), 1, "A")]), ([("S", day("12:00", 2), 3)], [])],
     ["A", "UNKNOWN"]),
    # trades every 23 h keep the symbol alive
    ([([("S", day("09:00", 2), 2)], [("S", day("10:00", 1), 1, "A")]), ([("S", day("08:00", 3), 3)], [])],
     ["A", "A"]),
])
def test_stream_ttl(spark, mk, batches, want):
    lay = _run(spark, mk, batches, engine="state", ttl="24 hours", watermark="5 minutes")
    assert _sectors(spark, lay) == want


def test_long_running_app_matches_batch(spark, mk):
    """The deployment wiring: three concurrent queries with processing-time triggers.

    Both inputs are in place before the queries start, so the first micro-batch
    holds trades and infos together (arrival order is then irrelevant)."""
    from tidemark.operators import asof, metrics
    from tidemark.plans import app

    lay = P.layout(spark, "t-app")
    trades = mk.trades([("S", day("10:01"), 2, "2.50", 4), ("S", day("10:03"), 4, "3.00", 1),
                        ("X", day("10:02"), 5)])
    info = mk.info([("S", day("10:00"), 1, "A"), ("S", day("10:02"), 3, "B")])
    feed.append_json(info, f"{lay.root}/in_stock-info")
    feed.append_json(trades, f"{lay.root}/in_stock-trades")
    qs = app.start_all(spark, lay, bootstrap=None, files=True, max_per_trigger=10, enrich_every="1 second",
                       metrics_every="1 second", serving_every="1 second", width="1 minute",
                       watermark="5 minutes")
    try:
        for q in qs:
            q.processAllAvailable()
        qs[1].processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    want = asof.enrich_asof(trades, info)
    got = P.enriched_rows(spark, lay)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
    m_want = sorted(tuple(r) for r in metrics.sector_metrics(want, "1 minute").collect())
    assert sorted(tuple(r) for r in P.latest_metrics(spark, lay).collect()) == m_want
    assert tbl.read_table(spark, lay.serving).count() == 3


def test_state_fold_keeps_results_and_replay(spark, mk):
    """Folding the foreachBatch engine's state log changes no result, and a replay
    of the folding batch still reads the state as of before it."""
    from tidemark.streaming import enrich_batches as EB

    lay = P.layout(spark, "t-fold")
    batches = [([("S", day("10:01"), 2)], [("S", day("10:00"), 1, "A")]),
               ([], [("S", day("10:30"), 3, "B")]),
               ([("S", day("10:31"), 5)], [("S", day("10:05"), 4, "C")]),  # stale C loses to B
               ([("S", day("10:40"), 6)], [])]
    for trades, infos in batches:
        feed.append_json(mk.trades(trades), lay.in_trades)
        feed.append_json(mk.info(infos), lay.in_info)
        feed.run_available(lambda: P.start_enrichment(spark, lay))
    EB.fold_state(spark, lay.enrich_state, 3)
    assert tbl.recent_history(spark, lay.enrich_state, 1).first().operation == "fold"
    st = EB.carried_state(spark, lay.enrich_state, 3).collect()
    assert [(r.symbol, r.sector) for r in st] == [("S", "B")]
    assert _sectors(spark, lay) == ["A", "B", "B"]


def test_metrics_with_null_sector_are_rejected(spark, mk):
    """missing='null' gives a NULL sector group, which the serving key forbids."""
    from tidemark.operators import asof

    lay = P.layout(spark, "t-reject")
    trades = mk.trades([("S", day("10:01"), 2), ("X", day("10:02"), 3)])
    info = mk.info([("S", day("10:00"), 1, "A")])
    enriched = asof.enrich_asof(trades, info, missing="null").withColumn(
        "event_timestamp", F.timestamp_millis("trade_timestamp"))
    tbl.write_batch(enriched, lay.enriched, 0)
    feed.run_available(lambda: P.start_metrics(spark, lay, "1 minute"))
    assert [r.sector for r in P.latest_metrics(spark, lay).collect()] == ["A"]
    rej = tbl.read_table(spark, f"{lay.metrics}_rejects").collect()
    assert [r.reason for r in rej] == ["sector is null"]


def test_history_batchwise_exact_for_any_trade_order(spark):
    """Infos first, then trade slices newest-first: every trade is late, and the
    history mode still equals the batch as-of on the whole fixture."""
    from support import SF_SMALL

    from tidemark.operators import asof
    from tidemark.plans import catalog

    t, i = catalog.event_inputs(spark, SF_SMALL)
    lay = P.layout(spark, "t-hist-order")
    cuts = feed.time_cuts(t, "trade_timestamp", 3)
    feed.append_json(i, lay.in_info)
    for s in reversed(range(len(cuts) + 1)):
        feed.append_json(feed.time_slice(t, "trade_timestamp", cuts, s), lay.in_trades)
        feed.run_available(lambda: P.start_enrichment(spark, lay, engine="batchwise", late="history"))
    got = P.enriched_rows(spark, lay)
    want = asof.enrich_asof(t, i)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("cut", [0, 3])
def test_state_engine_orders_a_symbols_rows_as_arrays(monkeypatch, cut):
    """pandas' own sort costs more a call than the few rows of a symbol; rows may come in several parts."""
    import pandas as pd

    from tidemark.streaming import enrich_stream as ES

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

    p = ES.EnrichProcessor()
    p.latest = Value()
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    nan = float("nan")
    rows = pd.DataFrame([("S", 2, 5, 30, 1, 7, None, None, nan, nan), ("S", nan, nan, 20, 0, 6, "c", "B", 2, 20),
                         ("S", 1, 5, 20, 1, 5, None, None, nan, nan), ("S", nan, nan, 20, 0, 4, "c", "A", 1, 20),
                         ("S", 1, 5, 10, 1, 3, None, None, nan, nan)],
                        columns=["symbol", "price", "volume", "ev_ms", "ev_ord", "ev_seq", "company", "sector", "market_cap",
                                 "info_timestamp"])
    parts = [rows] if not cut else [rows[:cut], rows[cut:]]
    out = pd.concat(p.handleInputRows(("S",), iter(parts), None))
    assert list(out.columns) == [f.name for f in ES.OUT_SCHEMA.fields]
    assert [(r.seq, r.sector) for r in out.itertuples()] == [(3, None), (5, "A"), (7, "A")]
    assert p.latest.held == ("c", "A", 1, 20, 4)


def test_history_state_fills_many_symbols_a_call(spark, monkeypatch):
    """A call costs milliseconds whatever it holds, so symbols meet in shards; rows are those of the batch form."""
    from support import SF_SMALL

    from tidemark.operators import asof
    from tidemark.plans import catalog
    from tidemark.streaming import enrich_stream as ES

    monkeypatch.setattr(ES, "SHARDS", 3, raising=False)
    t, i = catalog.event_inputs(spark, SF_SMALL)
    assert t.select("symbol").distinct().count() == 15
    lay, keys = P.layout(spark, "t-shards"), []

    def start():
        keys.append(P.start_enrichment(spark, lay, engine="state", late="history"))
        return keys[-1]

    feed.feed_in_slices({"trades": (t, "trade_timestamp", lay.in_trades), "info": (i, "info_timestamp", lay.in_info)}, 3, [start])
    assert max(p["stateOperators"][0]["numRowsTotal"] for q in keys for p in q.recentProgress) <= 3
    got, want = P.enriched_rows(spark, lay), asof.enrich_asof(t, i)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_history_state_keeps_longs_and_nulls(spark):
    """Longs that no double holds, beside rows without a market cap, volume, price or company."""
    from decimal import Decimal

    from tidemark.operators import asof
    from tidemark.schemas import INFO_SCHEMA, TRADE_SCHEMA

    big = 2**53 + 1
    info = spark.createDataFrame([("S", "c", "A", big, 1000, 1), ("S", None, "B", None, 2000, big), ("T", "d", None, 5, 1500, 4)], INFO_SCHEMA)
    trades = spark.createDataFrame(
        [("S", Decimal("1.25"), None, 1500, big), ("S", None, 3, 2500, big + 2), ("S", Decimal("2.00"), 4, 500, 7),
         ("T", Decimal("3.10"), 2**31 - 1, 1500, 8), ("N", Decimal("1.00"), 1, 3000, 9)], TRADE_SCHEMA)
    lay = P.layout(spark, "t-longs")
    feed.append_json(trades.where("seq < 100"), lay.in_trades)
    feed.append_json(info, lay.in_info)
    feed.run_available(lambda: P.start_enrichment(spark, lay, engine="state", late="history", watermark="1 hour"))
    feed.append_json(trades.where("seq >= 100"), lay.in_trades)    # late, so their infos come from the state
    feed.run_available(lambda: P.start_enrichment(spark, lay, engine="state", late="history", watermark="1 hour"))
    want = asof.enrich_asof(trades, info)
    assert sorted(P.enriched_rows(spark, lay).collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_history_processor_against_brute_force(seed):
    """Ties, missing seqs and symbols, several parts a call, infos dropped behind the watermark."""
    import random

    import pandas as pd

    from tidemark.streaming import enrich_stream as ES

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

    class Times:
        at = 0

        def getCurrentWatermarkInMs(self):
            return self.at

    r = random.Random(seed)
    p, times, seen, kept = ES.HistoryProcessor(), Times(), [], []
    p.hist = Value()
    for batch in range(4):
        rows = []
        for n in range(r.choice([1, 5, 60])):
            trade, no_seq = r.random() < 0.6, r.random() < 0.1
            ms = r.randint(times.at + 1, times.at + 30) if batch else r.randint(-2, 30)
            sym = r.choice(["A", "B", "C", "D", None])
            seq = 0 if no_seq else 1000 * batch + n + 2**60
            rows.append((sym, None if trade else f"c{batch}-{n}", None, 1 if trade else None, 7, ms, seq, trade + 4 * no_seq))
            if not trade and sym and ms > 0:
                seen.append((sym, ms, -(2**63) if no_seq else -seq, f"c{batch}-{n}"))
        df = pd.DataFrame(rows, columns=ES._WIRE)
        cut = r.randint(0, len(df))
        out = list(p.handleInputRows((1,), iter(x for x in (df[:cut], df[cut:]) if len(x)), times))
        got = [(x.symbol, x.trade_timestamp, x.company) for d in out for x in d.itertuples()]
        want = []
        for sym, _, _, _, _, ms, _, bits in rows:
            if bits & 1:
                known = [x[1:] for x in seen if x[0] == sym and x[1] <= ms]
                tie = {x[2] for x in known if x[:2] == max(known)[:2]}       # some without a seq may share a time
                want.append((sym, ms, tie))
        assert len(got) == len(want)
        assert all(g[:2] == w[:2] and (g[2] in w[2] if w[2] else g[2] is None) for g, w in zip(got, want))
        if p.hist.held:
            import pyarrow as pa

            kept = pa.ipc.open_stream(p.hist.held[0]).read_all().to_pylist()
            old = [x["symbol"] for x in kept if x["info_timestamp"] < times.at]
            assert len(old) == len(set(old)) and {x["symbol"] for x in kept} == {x[0] for x in seen}
        times.at += 20
