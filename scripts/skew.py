"""Task times of the session facts on skewed events, from Spark's event log.

    python scripts/skew.py SCRATCH_FOLDER [events, default 20000000]

A third of the events belong to one user, a sixth to one minute of that user, and a quarter name one
product; the dimensions are declared too large to broadcast. Prints the slowest and the median task of
every stage with ten tasks or more that took a second, as one JSON line each.
"""

from __future__ import annotations

import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from clickloom import build_session  # noqa: E402
from clickloom.operators.asof import price_asof  # noqa: E402
from clickloom.operators.lookup import measure  # noqa: E402
from clickloom.plans.marts import fact_sessions  # noqa: E402
from clickloom.sources.tables import materialize, use_local_folder  # noqa: E402

USERS, PRODUCTS, DAYS = 100_000, 50_000, 30


def skewed_events(spark, n: int):
    hot = F.col("id") % 3 == 0
    second = F.when(F.col("id") % 6 == 0, F.col("id") % 60).otherwise(F.xxhash64("id") % F.lit(DAYS * 86_400))
    product = F.when(F.col("id") % 4 == 0, F.lit("prod-0")).otherwise(F.concat(F.lit("prod-"), F.col("id") % PRODUCTS))
    kinds = F.array(*[F.lit(k) for k in ("product_view", "add_to_cart", "checkout", "page_view")])
    start = F.lit("2025-01-01 00:00:00").cast("timestamp")
    return spark.range(n, numPartitions=64).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(hot, F.lit("guest")).otherwise(F.concat(F.lit("user-"), F.pmod(F.xxhash64("id"), F.lit(USERS)))).alias("user_id"),
        F.timestamp_seconds(F.unix_seconds(start) + F.abs(second)).cast("timestamp_ntz").alias("event_at_ts"),
        F.get(kinds, (F.col("id") % 4).cast("int")).alias("event_type"),
        product.alias("product_id"),
        F.lit(1).alias("quantity"),
        F.concat(F.lit("source-"), F.col("id") % 5).alias("utm_source"),
    )


def main() -> None:
    folder, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20_000_000
    log = os.path.join(folder, "event-log")
    os.makedirs(log, exist_ok=True)
    use_local_folder(os.path.join(folder, "tables"))
    spark = build_session(
        "skew",
        "local[8]",
        **{
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": "64",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8m",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log}",
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    versions = spark.range(PRODUCTS).select(
        F.concat(F.lit("prod-"), "id").alias("product_id"),
        F.lit("2.50").cast("decimal(10,2)").alias("price"),
        F.lit("2025-01-01").cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    users = spark.range(USERS).select(F.concat(F.lit("user-"), "id").alias("user_id"), F.lit("FR").alias("country"))
    prices = measure(versions, "product_id", ["price", "valid_from", "valid_to"], 0)
    people = measure(users, "user_id", ["country"], 0)
    events = materialize(price_asof(materialize(skewed_events(spark, n), "events"), prices), "priced")
    print("sessions", fact_sessions(events, people).count())
    spark.stop()

    tasks: dict[int, list[float]] = {}
    for name in os.listdir(log):
        with open(os.path.join(log, name)) as lines:
            for line in lines:
                if '"SparkListenerTaskEnd"' in line:
                    event = json.loads(line)
                    run = (event.get("Task Metrics") or {}).get("Executor Run Time", 0) / 1000
                    tasks.setdefault(event["Stage ID"], []).append(run)
    for stage, seconds in sorted(tasks.items()):
        if len(seconds) >= 10 and max(seconds) >= 1:
            middle = statistics.median(seconds)
            print(json.dumps({"stage": stage, "tasks": len(seconds), "median_s": round(middle, 2), "slowest_s": max(seconds), "ratio": round(max(seconds) / max(middle, 0.001), 1)}))


if __name__ == "__main__":
    main()
