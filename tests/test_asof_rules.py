"""Hand-written cases for the as-of rules (FIXTURES.md section 3, C1-C6, C14, C15)."""

from __future__ import annotations

import pytest
from support import day

from tidemark.operators import asof, events

PLANS = [dict(bucket=None), dict(bucket="1 hour"), dict(bucket="1 minute")]


def sectors(df):
    return [r.sector for r in df.orderBy("trade_timestamp", "seq").collect()]


@pytest.mark.parametrize("plan", PLANS)
def test_basic_asof(mk, plan):
    info = mk.info([("S", day("10:00"), 1, "A"), ("S", day("10:02"), 3, "B")])
    trades = mk.trades([("S", day("10:01"), 2), ("S", day("10:03"), 4)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["A", "B"]


@pytest.mark.parametrize("plan", PLANS)
def test_unordered_arrival(mk, plan):
    info = mk.info([("S", day("10:02"), 2, "B"), ("S", day("10:00"), 4, "A")])
    trades = mk.trades([("S", day("10:03"), 1), ("S", day("10:01"), 3)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["A", "B"]


@pytest.mark.parametrize("plan", PLANS)
def test_same_ms_info_first(mk, plan):
    info = mk.info([("S", day("10:00"), 2, "A")])
    trades = mk.trades([("S", day("10:00"), 1)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["A"]


@pytest.mark.parametrize("plan", PLANS)
def test_two_infos_same_ms_first_wins(mk, plan):
    info = mk.info([("S", day("10:00"), 1, "A"), ("S", day("10:00"), 2, "B")])
    trades = mk.trades([("S", day("10:01"), 3)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["A"]
    assert asof.latest_info(info).first().sector == "A"


def test_stale_info_in_later_batch(mk):
    batch1 = mk.info([("S", day("10:05"), 1, "B")])
    state = asof.latest_info(batch1)
    info2 = mk.info([("S", day("10:00"), 2, "A")])
    trades2 = mk.trades([("S", day("10:06"), 3)])
    assert sectors(asof.enrich_asof(trades2, info2, seed=state)) == ["B"]
    assert asof.latest_info(info2, seed=state).first().sector == "B"


def test_record_vs_column_level(mk, spark):
    info = mk.info([("S", day("10:00"), 1, "A", "c1"), ("S", day("10:01"), 2, None, "c2")])
    trades = mk.trades([("S", day("10:02"), 3)])
    rec = asof.enrich_asof(trades, info).first()
    assert (rec.company, rec.sector) == ("c2", "UNKNOWN")
    u = events.union_events(trades, info)
    for kw in (dict(), dict(bucket_on="event_ms", bucket="1 minute")):
        ff = asof.forward_fill(u, ["company", "sector"], ["symbol"], ["event_ms", "record_type", "seq"], **kw)
        row = events.trades_only(ff).first()
        assert (row.company, row.sector) == ("c2", "A")


@pytest.mark.parametrize("plan", PLANS)
def test_no_info(mk, plan):
    trades = mk.trades([("S", day("10:00"), 1)])
    info = mk.info([("X", day("09:00"), 2, "A")])
    r = asof.enrich_asof(trades, info, **plan).first()
    assert (r.company, r.sector, r.market_cap, r.info_timestamp) == ("UNKNOWN", "UNKNOWN", 0, 0)
    r = asof.enrich_asof(trades, info, missing="null", **plan).first()
    assert (r.company, r.sector, r.market_cap, r.info_timestamp) == (None, None, None, None)


@pytest.mark.parametrize("plan", [dict(), dict(bucket="1 hour")])
def test_ttl_expires_after_gap(mk, plan):
    info = mk.info([("S", day("10:00", 1), 1, "A")])
    trades = mk.trades([("S", day("11:00", 1), 2), ("S", day("12:00", 2), 3)])
    assert sectors(asof.enrich_asof(trades, info, ttl="24 hours", **plan)) == ["A", "UNKNOWN"]


def test_ttl_refreshed_by_trades(mk):
    info = mk.info([("S", day("10:00", 1), 1, "A")])
    trades = mk.trades([("S", day("09:00", 2), 2), ("S", day("08:00", 3), 3)])
    assert sectors(asof.enrich_asof(trades, info, ttl="24 hours")) == ["A", "A"]


@pytest.mark.parametrize("plan", PLANS)
def test_non_positive_info_ignored(mk, plan):
    info = mk.info([("S", 0, 1, "A")])
    trades = mk.trades([("S", day("10:00"), 2)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["UNKNOWN"]


@pytest.mark.parametrize("plan", PLANS)
def test_symbols_are_isolated(mk, plan):
    info = mk.info([("S1", day("10:00"), 1, "A")])
    trades = mk.trades([("S2", day("10:01"), 2)])
    assert sectors(asof.enrich_asof(trades, info, **plan)) == ["UNKNOWN"]


def test_trade_value_exact(mk):
    info = mk.info([("S", day("10:00"), 1, "A")])
    trades = mk.trades([("S", day("10:01"), 2, "12.34", 1000)])
    r = asof.enrich_asof(trades, info).first()
    assert str(r.trade_value) == "12340.00000000"
