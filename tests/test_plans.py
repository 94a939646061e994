"""Physical-plan properties the scale design depends on.

Checked with AQE off and broadcast disabled, i.e. the plan a large input gets
before runtime re-planning.
"""

from __future__ import annotations

import re

import pytest
from support import SF_SMALL

from tidemark.operators import asof, latest, metrics
from tidemark.plans import catalog
from tidemark.sources import fixtures as fx


@pytest.fixture
def big_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_asof_plan_shape(spark, big_plan):
    t, i = catalog.event_inputs(spark, SF_SMALL)
    p = plan(asof.enrich_asof(t, i, bucket="1 hour"))
    # trade buckets, infos' buckets, the carry by symbol, and one exchange of the rows themselves
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 4 and "Join" not in p
    # the in-bucket window is partitioned by symbol AND bucket (a hot symbol is split)
    assert re.search(r"Window \[.*\], \[symbol#\d+, _b#\d+L\]", p)
    # what crosses by symbol alone has been combined to a row a bucket before
    by_symbol = re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\)", p)
    assert "Aggregate" in p[by_symbol.end():].split("Scan", 1)[0]


def test_bucketed_ttl_plan_splits_hot_symbols(spark, big_plan):
    t, i = catalog.event_inputs(spark, SF_SMALL)
    p = plan(asof.enrich_asof(t, i, bucket="1 hour", ttl="24 hours"))
    # the trades are shuffled once, by (symbol, ms), to meet their answers
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, trade_timestamp#\d+L", p)
    m = re.search(r"Window \[.*\], \[symbol#\d+, _b#\d+L\]", p)
    assert m
    # ... and reads its (symbol, bucket) join directly: no exchange in between
    between = p[m.end():].split("SortMergeJoin", 1)[0]
    assert "Exchange" not in between
    # trade times are de-duplicated map-side before any exchange of them
    assert p.count("HashAggregate(keys=[symbol#") >= 2


def test_plain_asof_is_one_window_per_symbol(spark, big_plan):
    t, i = catalog.event_inputs(spark, SF_SMALL)
    p = plan(asof.enrich_asof(t, i, bucket=None))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1


def test_metrics_pre_aggregate_before_shuffle(spark, big_plan):
    e = catalog.enriched(spark, SF_SMALL, bucket=None)
    p = plan(metrics.sector_metrics(e, "1 minute"))
    head = p.split("Exchange hashpartitioning(window", 1)
    assert len(head) == 2 and "partial_count" in head[1].split("Exchange", 1)[0]


def test_newest_n_limits_before_shuffle(spark, big_plan):
    e = catalog.enriched(spark, SF_SMALL, bucket="1 hour")  # not yet partitioned by symbol
    p = plan(latest.newest_per_key(e, ["symbol"], ["trade_timestamp", "seq"], 5))
    final, rest = p.split("Exchange hashpartitioning(symbol", 1)
    assert "WindowGroupLimit" in final and "Partial" in rest.split("Exchange", 1)[0]


def test_dedup_and_latest_combine_map_side(spark, big_plan):
    e = catalog.enriched(spark, SF_SMALL, bucket=None)
    for df in (latest.dedup_first(e, ["symbol", "trade_timestamp", "volume"]),
               asof.latest_info(fx.info_from_events(spark, SF_SMALL))):
        p = plan(df)
        assert "partial_min" in p or "partial_max" in p


def test_scan_reads_only_needed_columns(spark, big_plan):
    _, i = catalog.event_inputs(spark, SF_SMALL)
    p = plan(asof.latest_info(i))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", p) or re.findall(r"FileScan parquet[^\n]*", p)
    assert scans and all("value" not in s for s in scans)
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(event_type,signup\)", p)


def test_hot_symbol_bucketed_equals_plain(spark, mk):
    """One symbol holds most rows; the bucketed plan still gives the plain result."""
    base = 1_704_067_200_000
    trades = [("HOT", base + j * 7_000, j) for j in range(600)] + [("COLD", base + j * 50_000, 1000 + j)
                                                                    for j in range(100)]
    infos = [("HOT", base + j * 97_000, 5000 + j, f"s{j % 3}") for j in range(40)] + \
            [("COLD", base + 3_000, 6000, "c")]
    t, i = mk.trades(trades), mk.info(infos)
    a = sorted(tuple(r) for r in asof.enrich_asof(t, i, bucket=None).collect())
    b = sorted(tuple(r) for r in asof.enrich_asof(t, i, bucket="1 minute").collect())
    assert a == b and len(a) == 700


def test_auto_plan_choice_is_size_checked(spark, monkeypatch):
    t, i = catalog.event_inputs(spark, SF_SMALL)
    assert asof.choose_bucket(t, i, "auto") is None  # small input: plain window
    monkeypatch.setattr(asof, "AUTO_PLAIN_MAX_BYTES", 0)
    assert asof.choose_bucket(t, i, "auto") == asof.AUTO_BUCKET
    assert asof.choose_bucket(t, i, "2 hours") == "2 hours"


def test_auto_plan_stays_plain_where_no_symbol_is_large(spark, mk, monkeypatch):
    """Past the size limit the largest symbol's share decides, so volume per row does not jump with the size."""
    day_ms = 86_400_000
    i = mk.info([(f"S{k}", day_ms, k, "a") for k in range(100)])
    even = mk.trades([(f"S{k % 100}", day_ms * (k // 100 + 1), k) for k in range(400)])
    hot = mk.trades([("S1" if k % 2 else f"S{k % 100}", day_ms * (k // 100 + 1), k) for k in range(400)])
    monkeypatch.setattr(asof, "AUTO_PLAIN_MAX_BYTES", asof.estimated_bytes(even, i) // 20)
    assert asof.choose_bucket(even, i, "auto") is None
    assert asof.choose_bucket(hot, i, "auto") == asof.AUTO_BUCKET
    p = plan(latest.dedup_first(asof.enrich_asof(even, i), ["symbol", "trade_timestamp", "volume"]))
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1
