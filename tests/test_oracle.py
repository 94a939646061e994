"""Every registered query against its DuckDB SQL on the small tables.

The streaming keys start real queries (file source, availableNow) and take a
while, so only a representative subset of them runs here; the full set runs
through ``tools/oracle_check.py``.
"""

from __future__ import annotations

import os

import duckdb
import pytest
from support import SF_SMALL

import __spark_entry__ as E
from tidemark.plans import catalog
from tools.oracle_check import TABLES, digest, type_mismatches

SLOW = {"stream_ingest_trades", "stream_enrich", "stream_enrich_history", "stream_sector_metrics",
        "stream_sector_metrics_append", "staged_enriched", "pipeline_staged", "early_results",
        "latest_metrics", "view_sector_latest", "stream_enrich_ttl", "stream_enrich_batchwise",
        "pipeline_unified", "stream_enrich_history_batchwise", "stream_dedup_keys",
        "early_event_results", "late_corrections", "stream_enrich_ttl_batchwise", "stream_enrich_counters",
        "stream_enrich_late_history", "pipeline_staged_late", "pipeline_unified_late", "stream_rejects"}
FAST = sorted(k for k in catalog.oracle_sql() if k not in SLOW)
STREAM_SAMPLE = ["stream_enrich", "stream_sector_metrics", "stream_enrich_history", "late_corrections",
                 "stream_enrich_ttl_batchwise", "pipeline_unified_late"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _check(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert len(srows) == len(orows)
    assert digest(df.columns, srows) == digest(rel.columns, orows)
    assert type_mismatches(df.schema, rel) == {}


@pytest.mark.parametrize("key", FAST)
def test_batch_query_matches_oracle(spark, con, key):
    _check(spark, con, key)


@pytest.mark.parametrize("key", STREAM_SAMPLE)
def test_stream_query_matches_oracle(spark, con, key):
    _check(spark, con, key)


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"window_start", "window_end", "sector", "trade_count", "total_value",
                               "avg_price", "total_volume"}
    assert df.count() > 0
