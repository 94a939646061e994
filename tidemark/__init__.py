"""tidemark: as-of enrichment and event-time metrics on Spark DataFrames.

Batch operators live in ``operators``; Structured Streaming forms in
``streaming``; lake-table sinks and maintenance in ``sinks``; JSON/topic
sources and the fixture derivation in ``sources``; column helpers in
``functions``; the query catalogue and pipelines in ``plans``.
"""

__version__ = "0.1.0"

from .operators.asof import enrich_asof, forward_fill, latest_info  # noqa: E402
from .operators.constraints import ENRICHED_CONSTRAINTS, METRICS_CONSTRAINTS, check_constraints  # noqa: E402
from .operators.events import union_events  # noqa: E402
from .operators.latest import dedup_first, latest_per_key, newest_per_key  # noqa: E402
from .operators.metrics import sector_metrics  # noqa: E402
from .operators.stats import enrich_stats, observe_enrichment  # noqa: E402
from .session import build_session  # noqa: E402
from .sources.topic import parse_info, parse_json, parse_trades, read_topic  # noqa: E402
from .streaming.enrich_stream import enrich_stream  # noqa: E402

__all__ = [
    "ENRICHED_CONSTRAINTS", "METRICS_CONSTRAINTS", "build_session", "check_constraints", "dedup_first",
    "enrich_asof", "enrich_stats", "enrich_stream", "forward_fill", "latest_info", "latest_per_key",
    "newest_per_key", "observe_enrichment", "parse_info", "parse_json", "parse_trades", "read_topic",
    "sector_metrics", "union_events",
]
