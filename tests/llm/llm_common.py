import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True)
def workers_path(spark):
    """Python workers find the package whatever folder pytest runs in."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


#: Columns whose names clash with those that operators use inside or return.
CLASHING = ["_key", "class", "component", "block", "n_words", "score", "matches", "copy", "hash", "value"]


@pytest.fixture
def docs_of(spark):
    """Documents from ``(doc_id, text)`` rows, with extra columns of clashing names; sources s0, s1, ..., null."""

    def make(rows, lang="en"):
        extra = ", ".join(f"`{c}` string" for c in CLASHING)
        full = [(i, t, lang, f"s{k % 3}" if k % 4 else None, len(t) if t is not None else None, *["x"] * len(CLASHING)) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")

    return make
