from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents of (doc_id, text, source), with columns whose names the operators use inside."""

    def build(rows):
        rows = [(r + ("s",))[:3] if len(r) == 2 else r for r in rows]
        full = [(i, t, None, s, len(t or ""), 1, "x", None) for i, t, s in rows]
        return spark.createDataFrame(full, DOCS + ", key int, hit string, spans string")

    return build


@pytest.fixture
def word():
    """The n-th of many distinct words."""
    return lambda n: "w" + "".join(chr(97 + int(c)) for c in str(n))
