"""Mergeable distinct counts: one small sketch per user and minute, merged for whatever is asked.

An exact distinct count has to see every value again for each grouping. A sketch of the products viewed in a minute
is made once; sketches of minutes are united for sessions, days or countries, and united sketches can be kept and
united further, so a later run never goes back to the events. Small sets are counted almost exactly; beyond some
hundred values the estimate has a standard error of ``relative_error``. Exact counts remain the default elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import epoch_minute
from clickloom.schemas import PRODUCT_VIEW

#: Binary logarithm of a sketch's number of buckets.
LG_BUCKETS = 12


def relative_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Standard error of an estimate, as a part of the true count."""
    return 1.04 / (1 << lg_buckets) ** 0.5


def viewed_sketches(events: DataFrame, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """user_id, minute and viewed: a sketch of the products viewed, for minutes with a product view."""
    views = events.where((F.col("event_type") == PRODUCT_VIEW) & F.col("product_id").isNotNull())
    by_minute = views.groupBy("user_id", epoch_minute(F.col("event_at_ts")).alias("minute"))
    return by_minute.agg(F.hll_sketch_agg("product_id", lg_buckets).alias("viewed"))


def united(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """One sketch per group; they are united in the map tasks first, so a group of very many rows stays cheap."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("viewed").alias("viewed"))


def estimate(sketch: str | Column = "viewed") -> Column:
    return F.hll_sketch_estimate(sketch)


def session_sketches(sketches: DataFrame, minutes: DataFrame) -> DataFrame:
    """user_id, session_index and viewed, from the sketches of minutes and the minutes' session numbers."""
    numbered = sketches.join(minutes.select("user_id", "minute", "session_index"), ["user_id", "minute"])
    return united(numbered, "user_id", "session_index")


def products_viewed_approx(events: DataFrame, minutes: DataFrame, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """``products_viewed`` by sketches: (user, session_index, distinct_products_viewed)."""
    found = session_sketches(viewed_sketches(events, lg_buckets), minutes)
    return found.select("user_id", "session_index", estimate().alias("distinct_products_viewed"))
