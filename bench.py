"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local threads, ``BENCH_SCRATCH`` the
folder of intermediate tables. Each query runs to completion into a sink that drops the rows, three times
or until four seconds are spent; the median counts. One small query on the smallest data warms the JVM up and is not counted. ``land_raw``
is the time to turn all messages into the raw table the other queries read, ``load_dimensions`` that to
load and measure the dimension tables; both are part of the events per second. The session facts are also
timed on the next smaller data, so that a slope can be read.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom import build_session  # noqa: E402
from clickloom.sources.tables import use_local_folder  # noqa: E402
from clickloom.testbed.catalog import QUERIES, product_dim, raw_table, user_dim, version_dim  # noqa: E402

HEADLINE = [
    "parse_events",
    "validate_events",
    "quarantine",
    "dedup_events",
    "price_asof",
    "event_gaps",
    "sessionize",
    "session_revenue",
    "session_products_viewed",
    "fact_sessions",
    "scd2_snapshot",
    "dq_suite",
    "ingest_roundtrip",
    "stream_sessions",
    "refresh_facts",
]
RUNS, ENOUGH = 3, 4.0


def timed(spark, sf_dir: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def median(spark, sf_dir: str, name: str) -> float:
    runs: list[float] = []
    while len(runs) < RUNS and sum(runs) < ENOUGH:
        runs.append(timed(spark, sf_dir, name))
    return round(statistics.median(runs), 3)


def load(spark, sf_dir: str) -> dict[str, float]:
    began = time.perf_counter()
    raw_table(spark, sf_dir)
    landed = time.perf_counter()
    for dimension in (product_dim, user_dim, version_dim):
        dimension(spark, sf_dir)
    return {"land_raw": round(landed - began, 3), "load_dimensions": round(time.perf_counter() - landed, 3)}


def events_per_second(spark, sf_dir: str, seconds: dict[str, float]) -> int:
    """Events turned from messages into session facts in a second, landing and dimensions included."""
    spent = seconds["land_raw"] + seconds["load_dimensions"] + seconds["fact_sessions"]
    return round(spark.read.parquet(f"{sf_dir}/events.parquet").count() / spent)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    use_local_folder(os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="clickloom-bench-"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = os.path.dirname(sf_dir)
    smallest = os.path.join(folder, "sf0.001")
    QUERIES["fact_sessions"](spark, smallest if os.path.isdir(smallest) else sf_dir).count()

    seconds = load(spark, sf_dir)
    seconds |= {name: median(spark, sf_dir, name) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "events_per_sec_landing_included": events_per_second(spark, sf_dir, seconds),
    }
    smaller = os.path.join(folder, "sf0.01")
    if os.path.isdir(smaller) and smaller != sf_dir:
        small = load(spark, smaller)
        small["fact_sessions"] = median(spark, smaller, "fact_sessions")
        result["smaller"] = {"sf": "0.01", "queries": small, "events_per_sec_landing_included": events_per_second(spark, smaller, small)}
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
