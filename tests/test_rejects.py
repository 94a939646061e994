"""Documents that the parsers turn down are kept, and a replayed batch is counted once."""

from __future__ import annotations

import json
import os

from tidemark.plans import pipelines as pl
from tidemark.sinks import table as tbl


def _lines(folder, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{len(os.listdir(folder))}.json", "w") as f:
        f.write("\n".join(rows))


TRADE = {"symbol": "A", "price": 1.5, "volume": 2, "trade_timestamp": 1_704_067_200_000, "seq": 1}


def test_rejects_are_kept(spark, tmp_path):
    lay = pl.Layout(str(tmp_path))
    _lines(lay.in_trades, [json.dumps(TRADE), "not json", json.dumps(TRADE | {"symbol": None})])
    _lines(lay.in_info, ["{"])
    pl.start_rejects(spark, lay).awaitTermination()
    got = sorted((r.topic, r.reason) for r in tbl.read_table(spark, lay.rejects).collect())
    assert got == [("info", "malformed"), ("trades", "malformed"), ("trades", "null symbol")]


def test_replayed_batch_is_counted_once(spark, tmp_path):
    """The enrichment's last commit is lost after the metrics query has read the batch."""
    lay = pl.Layout(str(tmp_path))
    _lines(lay.in_trades, [json.dumps(TRADE), json.dumps(TRADE | {"seq": 2, "volume": 3})])
    os.makedirs(lay.in_info)
    pl.start_enrichment(spark, lay).awaitTermination()
    pl.start_metrics(spark, lay).awaitTermination()
    commits = f"{lay.ckpt_enrich}/commits"
    for f in os.listdir(commits):
        if f.strip(".").startswith("0"):
            os.remove(f"{commits}/{f}")
    pl.start_enrichment(spark, lay).awaitTermination()
    pl.start_metrics(spark, lay).awaitTermination()
    assert [r.trade_count for r in pl.latest_metrics(spark, lay).collect()] == [2]
    assert pl.enriched_rows(spark, lay).count() == 2
