"""Helpers of the operator tests."""

import pytest


@pytest.fixture
def docs_frame(spark):
    """Documents from ``(doc_id, text)`` pairs, with the driver table's columns."""

    def make(rows, extra=()):
        names = "doc_id long, text string, lang string, source string, n_chars long"
        names += "".join(f", {c} string" for c in extra)
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) + ("x",) * len(extra) for i, t in rows]
        return spark.createDataFrame(full, names)

    return make
