import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_frame(spark):
    """Documents of (doc_id, text) pairs, with the other columns of the table."""
    def build(rows, **columns):
        full = [(i, t, columns.get("lang", "en"), columns.get("source", "s"), len(t or ""))
                for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long")
    return build
