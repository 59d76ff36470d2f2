import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples."""

    def make(rows, extra=""):
        rows = [(*r, *(None, None)[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    return make
