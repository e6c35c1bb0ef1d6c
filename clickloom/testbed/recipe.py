"""Dirty clickstream messages and their dimensions, by arithmetic on the given tables.

Every row of the tables is used. Defects (upper-case types, repeated ids, missing and unknown users
and products, two timestamp formats, text that is not JSON) depend on the event number only, so a SQL
engine can state the same data independently. Each message carries the wall-clock text, user number
and so on of its event; all messages go through JSON text and come back through the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the recipe.
MIN_EVENT_TS = "2024-01-01 00:00:00"
PRICE_CHANGE = "2024-01-16 00:00:00"
FIRST_LOAD = "2024-01-01 00:00:00"

_FIELDS = {
    "event_id": "cast(if(event_id % 20 = 7, event_id - 1, event_id) as string)",
    "event_type": """
        case when event_id % 13 = 0 then upper(clean_type) else clean_type end""",
    "user_id": """
        case when event_id % 10 = 0 then null
             when event_id % 41 = 0 then 'user-x9999'
             when user_id % 5 = 4 then concat('user-x', user_id)
             else concat('user-', user_id) end""",
    "product_id": """
        case when clean_type = 'page_view' then null
             when event_id % 23 = 0 then 'prod-x9999'
             when event_id % 29 = 0 then null
             when k >= 80 then concat('prod-x', k)
             else concat('prod-', k) end""",
    "platform": "if(event_id % 2 = 0, 'web', 'mobile')",
    "ip_address": "concat('198.51.100.', event_id % 5)",
    "user_agent": "concat('agent-', event_id % 4)",
    "utm_source": "concat('source-', event_id % 5)",
    "utm_medium": "concat('medium-', event_id % 3)",
    "utm_campaign": "if(event_id % 4 = 3, null, concat('campaign-', event_id % 4))",
    "order_id": "if(clean_type = 'checkout', concat('order-', event_id), null)",
    "quantity": """
        case when clean_type = 'checkout' then cast(1 + event_id % 10 as int)
             when clean_type in ('add_to_cart', 'remove_from_cart') then 1 end""",
}
_CLEAN_TYPE = """
    case event_type when 'signup' then 'page_view' when 'view' then 'product_view'
         when 'click' then 'add_to_cart' when 'error' then 'remove_from_cart'
         when 'purchase' then 'checkout' end"""
_ISO_TEXT = "concat(replace(cast(ts as string), ' ', 'T'), '+00:00')"
_EPOCH = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
# A third of the timestamps are numbers in JSON, so the field cannot be one typed column: the object
# text gets the number or the quoted text put in.
_TIMESTAMP_JSON = f"""if(event_id % 10 < 7, concat('"', {_ISO_TEXT}, '"'), cast({_EPOCH} as string))"""


def events_table(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    if files:
        events = events.repartitionByRange(files, "event_id")
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "clean_type", F.expr(_CLEAN_TYPE)
    )


def messages(
    spark: SparkSession, sf_dir: str, malformed: bool = False, files: int | None = None
) -> DataFrame:
    """(event number, ts, value): one JSON text per event, null fields left out.

    With ``malformed``, every 50th event sends a cut-off text first.
    """
    fields = F.to_json(F.struct(*[F.expr(e).alias(name) for name, e in _FIELDS.items()]))
    stamped = F.concat(
        F.lit('{"event_timestamp":'), F.expr(_TIMESTAMP_JSON), F.lit(","), F.expr("substring(fields, 2)")
    )
    texts = events_table(spark, sf_dir, files).withColumn("fields", fields).withColumn("value", stamped)
    if malformed:
        cut_off = F.concat(F.lit('{"event_id":"'), F.col("event_id").cast("string"))
        both = F.when(F.col("event_id") % 50 == 3, F.array(cut_off, "value")).otherwise(F.array("value"))
        texts = texts.withColumn("value", F.explode(both))
    return texts.select("event_id", "ts", "value")


def raw_events(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Raw table: messages as variants, loaded one second apart in event order."""
    return messages(spark, sf_dir, files=files).select(
        F.try_parse_json(F.col("value")).alias("raw_data"),
        F.lit("messages").alias("metadata_filename"),
        F.col("event_id").alias("metadata_file_row_number"),
        F.expr("timestampadd(SECOND, event_id, timestamp_ntz'2024-02-01 00:00:00')").alias("loaded_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select(
        F.concat(F.lit("prod-"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )


def raised_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second product load: every price up by a tenth."""
    raised = (F.col("price") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(10,2)")
    return products(spark, sf_dir).withColumn("price", raised)


def product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions per product: the price, and a tenth more from the middle of the period on."""
    change = F.lit(PRICE_CHANGE).cast("timestamp_ntz")
    first = (
        products(spark, sf_dir)
        .withColumn("valid_from", F.lit(FIRST_LOAD).cast("timestamp_ntz"))
        .withColumn("valid_to", change)
    )
    second = (
        raised_products(spark, sf_dir)
        .withColumn("valid_from", change)
        .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
    )
    return first.unionByName(second)


HISTORY_DAYS = 30


def daily_versions(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """A long history: a price for each product and day, from an hour of its own on; the last one lasts."""
    catalogue = products(spark, sf_dir).repartition(files) if files else products(spark, sf_dir)
    number = F.substring_index("product_id", "-", -1).cast("bigint")
    begins = "timestampadd(HOUR, cast(24 * k + number % 24 as int), timestamp_ntz'2024-01-01 00:00:00')"
    raised = (F.col("price") + F.col("k")).cast("decimal(10,2)")
    days = catalogue.withColumns({"number": number, "k": F.explode(F.sequence(F.lit(0), F.lit(HISTORY_DAYS - 1)))})
    ends = f"if(k < {HISTORY_DAYS - 1}, timestampadd(DAY, 1, {begins}), null)"
    return days.select("product_id", raised.alias("price"), F.expr(begins).alias("valid_from"), F.expr(ends).alias("valid_to"))


def _extra_products(rows: DataFrame, prefix: str, key: str, name: str) -> DataFrame:
    return rows.select(
        F.concat(F.lit(prefix), F.col(key).cast("string")).alias("product_id"),
        F.col(name).alias("product_name"),
        F.lit("EXTRA").alias("category"),
        F.col(key).cast("decimal(10,2)").alias("price"),
    )


def first_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products, and one product per supplier that the second catalogue no longer lists."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return products(spark, sf_dir).unionByName(_extra_products(suppliers, "old-", "s_suppkey", "s_name"))


def second_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with every third price raised and every seventh category blanked, and new products."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    number = F.substring_index("product_id", "-", -1).cast("bigint")
    raised = (F.col("price") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(10,2)")
    changed = products(spark, sf_dir).select(
        "product_id",
        "product_name",
        F.when(number % 7 != 0, F.col("category")).alias("category"),
        F.when(number % 3 == 0, raised).otherwise(F.col("price")).alias("price"),
    )
    return changed.unionByName(_extra_products(nations, "new-", "n_nationkey", "n_name"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the name of their nation as country, and the guest."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    registered = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
            "registration_date"
        ),
        F.col("n_name").alias("country"),
    )
    guest = spark.range(1).select(
        F.lit("guest").alias("user_id"),
        F.lit(None).cast("date").alias("registration_date"),
        F.lit(None).cast("string").alias("country"),
    )
    return registered.unionByName(guest)
