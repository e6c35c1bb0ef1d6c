from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) pairs, with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    def make(*rows):
        out = spark.createDataFrame(list(rows), DOCS)
        return out.withColumns({name: F.lit("x") for name in ("score", "n_words", "key", "node", "label", "chunk")})

    return make
