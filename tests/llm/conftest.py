from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """(doc_id, text) pairs as a documents table with an extra, clashing column each."""
    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), "x", 1.0) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", hash string, size double").repartition(3)
    return make
