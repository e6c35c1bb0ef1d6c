from __future__ import annotations

import os
import sys
from datetime import timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__  # noqa: E402, F401  names its own folder when imported, before the tests name theirs
from clickloom import build_session  # noqa: E402
from clickloom.sources.tables import use_local_folder  # noqa: E402
from moments import at  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    use_local_folder(str(tmp_path_factory.mktemp("scratch")))
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_raw(spark):
    """Raw rows of JSON texts, one load second apart: newer ones come later."""
    from pyspark.sql import functions as F

    def make(*texts: str):
        rows = [
            (text, "f", i, at("12:00") + timedelta(seconds=i)) for i, text in enumerate(texts)
        ]
        schema = (
            "value string, metadata_filename string, metadata_file_row_number long, loaded_at timestamp_ntz"
        )
        return spark.createDataFrame(rows, schema).select(
            F.try_parse_json("value").alias("raw_data"),
            "metadata_filename",
            "metadata_file_row_number",
            "loaded_at",
        )

    return make


@pytest.fixture(scope="session")
def make_events(spark):
    """Valid, priced events from (event_id, user_id, time[, event_type, product_id, value]) tuples."""

    def make(rows):
        full = [
            (
                row[0],
                row[1],
                at(row[2]) if isinstance(row[2], str) else row[2],
                row[3] if len(row) > 3 else "page_view",
                row[4] if len(row) > 4 else None,
                row[5] if len(row) > 5 else None,
                "web",
            )
            for row in rows
        ]
        schema = (
            "event_id string, user_id string, event_at_ts timestamp_ntz, event_type string, "
            "product_id string, value decimal(21,2), utm_source string"
        )
        return spark.createDataFrame(full, schema)

    return make
