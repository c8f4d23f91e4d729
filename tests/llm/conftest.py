from __future__ import annotations

import pytest


@pytest.fixture
def make_docs(spark):
    """A documents table of (text, ...) rows: doc_id from 0, or (doc_id, text, lang, source) tuples."""

    def build(rows):
        full = [row if isinstance(row, tuple) else (i, row, "en", "s0") for i, row in enumerate(rows)]
        full = [(*row, len(row[1] or "")) for row in full]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema)

    return build
