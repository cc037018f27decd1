from pathlib import Path

import pytest


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as documents, with the other columns and one whose name clashes with results."""

    def make(rows):
        full = [(i, t, "en", s[0] if s else "a", len(t or ""), "mine") for i, t, *s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size string")

    return make
