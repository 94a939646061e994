from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture
def mk(spark):
    """Builders for hand-written trades and infos."""
    from decimal import Decimal

    from tidemark.schemas import INFO_SCHEMA, TRADE_SCHEMA

    class Mk:
        def trades(self, rows):
            # rows: (symbol, ts_ms, seq) or (symbol, ts_ms, seq, price, volume)
            full = []
            for r in rows:
                sym, ts, seq = r[:3]
                price = Decimal(str(r[3])) if len(r) > 3 else Decimal("1.00")
                vol = r[4] if len(r) > 4 else 1
                full.append((sym, price, vol, ts, seq))
            return spark.createDataFrame(full, TRADE_SCHEMA)

        def info(self, rows):
            # rows: (symbol, ts_ms, seq, sector) or (symbol, ts_ms, seq, sector, company)
            full = []
            for r in rows:
                sym, ts, seq, sector = r[:4]
                company = r[4] if len(r) > 4 else f"co-{sector}"
                full.append((sym, company, sector, 100, ts, seq))
            return spark.createDataFrame(full, INFO_SCHEMA)

    return Mk()
