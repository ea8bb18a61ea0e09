from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text, source) as a documents table with an extra, clashing column."""
    def make(rows, schema=DOCS + ", size long"):
        full = [(i, t, "en", s, None if t is None else len(t), -1) for i, t, s in rows]
        return spark.createDataFrame(full, schema)
    return make
