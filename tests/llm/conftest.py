from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, kind long, items int, score int"


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang), with columns whose names clash."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", 0, "k", 1, 2, 3) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
