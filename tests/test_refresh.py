import json

import pytest
from pyspark.sql import functions as F

from clickloom.operators.quality import QualityError
from clickloom.plans import refresh as refresh_module
from clickloom.plans.refresh import RefreshConfig, published_run, read_published, refresh, register_views
from clickloom.schemas import PRODUCT_SCHEMA, USER_SCHEMA
from clickloom.session import sizing
from clickloom.sources.tables import write_table


def event(event_id, minute, **fields):
    return json.dumps(
        {
            "event_id": event_id,
            "event_timestamp": f"2025-12-01T10:{minute:02d}:00+00:00",
            "event_type": "checkout",
            "user_id": "user-1",
            "product_id": "prod-1",
            "quantity": 2,
            **fields,
        }
    )


@pytest.fixture
def job(spark, make_raw, tmp_path):
    from decimal import Decimal

    raw = make_raw(event("1", 0), event("1", 0), event("2", 40), event("3", 41, product_id="x"))

    class Job:
        warehouse = str(tmp_path / "warehouse")
        users = spark.createDataFrame([("user-1", None, "FR"), ("guest", None, None)], USER_SCHEMA)

        def run(self, run_id, loaded_at="2025-11-01 00:00:00", price="5.00", raw=raw, users=None, **options):
            products = spark.createDataFrame([("prod-1", "Lamp", "Home", Decimal(price))], PRODUCT_SCHEMA)
            config = RefreshConfig(self.warehouse, run_id, loaded_at, **options)
            return refresh(spark, config, raw, products, users or self.users)

        def read(self, table):
            return read_published(spark, self.warehouse, table)

    return Job()


def test_first_run_publishes_every_table(spark, job):
    assert published_run(spark, job.warehouse) is None
    with pytest.raises(LookupError):
        job.read("fact_sessions")
    facts = job.run("1")
    assert published_run(spark, job.warehouse) == "1"
    assert facts.count() == job.read("fact_sessions").count() == 2
    assert {str(r["total_session_revenue"]) for r in facts.collect()} == {"10.00"}
    assert [r["reject_reason"] for r in job.read("quarantine").collect()] == ["unknown_product"]
    assert {r["session_id"] for r in job.read("sessionized").collect()} == {"user-1-1", "user-1-2"}
    assert job.read("events").count() == 2
    assert job.read("products").count() == 1
    assert job.read("checks").where("passed").count() == 14


def test_product_history_carries_on(spark, job):
    job.run("1")
    job.run("2", "2025-12-01 10:30:00", price="6.00")
    assert published_run(spark, job.warehouse) == "2"
    assert job.read("product_versions").count() == 2
    revenue = {r["session_id"]: str(r["total_session_revenue"]) for r in job.read("fact_sessions").collect()}
    assert revenue == {"user-1-1": "10.00", "user-1-2": "12.00"}


def test_failed_check_leaves_the_published_run(spark, job, make_raw):
    job.run("1")
    # Unknown event types are valid records; the accepted-values check stops them here.
    strange = make_raw(event("9", 0, event_type="teleport"))
    with pytest.raises(QualityError, match="events.event_type.accepted_values"):
        job.run("2", raw=strange)
    assert published_run(spark, job.warehouse) == "1"
    assert job.read("fact_sessions").count() == 2
    # The run can be repeated under its number once its input is right, but not after publication.
    job.run("2")
    assert published_run(spark, job.warehouse) == "2"
    with pytest.raises(ValueError, match="published already"):
        job.run("2")
    assert job.read("product_versions").count() == 1


def test_users_missing_from_the_dimension_stop_the_run(spark, job, make_raw):
    guests = make_raw(event("1", 0, user_id=None))
    with pytest.raises(QualityError, match="sessions.user_id.relationships"):
        job.run("1", raw=guests, users=job.users.where("user_id <> 'guest'"))


def test_dimensions_too_large_to_broadcast_give_the_same_tables(spark, job):
    want = {tuple(r) for r in job.run("1").collect()}
    quarantine = {tuple(r) for r in job.read("quarantine").collect()}
    assert {tuple(r) for r in job.run("2", max_broadcast_bytes=0).collect()} == want
    assert {tuple(r) for r in job.read("quarantine").collect()} == quarantine


def test_gap_and_cutoff_are_parameters(spark, job):
    assert job.run("1", gap_minutes=60).count() == 1
    assert job.read("sessionized").select("session_id").distinct().count() == 1
    assert job.run("2", min_event_ts="2025-12-01 10:30:00").count() == 1


def test_all_records_valid_or_none(spark, job, make_raw):
    job.run("1", raw=make_raw(event("1", 0)))
    assert job.read("quarantine").count() == 0
    job.run("2", raw=make_raw(event("1", 0, product_id="x")))
    assert job.read("events").count() == 0
    assert job.read("fact_sessions").count() == 0
    assert job.read("quarantine").count() == 1


def test_nothing_to_do(spark, job, make_raw):
    job.run("1", raw=make_raw(event("1", 0)).where(F.lit(False)))
    assert job.read("fact_sessions").count() == 0
    assert job.read("quarantine").count() == 0


def test_sizing():
    assert sizing(1) == {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": str(128 * 2**20),
    }
    assert sizing(2**40)["spark.sql.shuffle.partitions"] == "4096"
    assert sizing(100 * 2**40) == {
        "spark.sql.shuffle.partitions": "100000",
        "spark.sql.files.maxPartitionBytes": str(512 * 2**20),
    }


def test_published_tables_in_sql(spark, job):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    job.run("1", raw_bytes=3_000_000_000)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    register_views(spark, job.warehouse)
    row = spark.sql(
        "select user_country, sum(total_session_revenue) as revenue from fact_sessions group by user_country"
    ).first()
    assert (row["user_country"], str(row["revenue"])) == ("FR", "20.00")
    assert spark.table("quarantine").count() == 1


def test_partitions_follow_the_size_of_the_raw_table(spark, job, make_raw, tmp_path, monkeypatch):
    path = tmp_path / "raw"
    raw = write_table(make_raw(*[event(str(i), i % 60) for i in range(200)]), str(path))
    seen = []
    monkeypatch.setattr(refresh_module, "sizing", lambda size: seen.append(size) or {})
    job.run("1", raw=raw)
    job.run("2", raw=raw, raw_bytes=7)
    assert seen == [sum(f.stat().st_size for f in path.glob("*.parquet")), 7]
    many = sizing(10**12)
    assert int(many["spark.sql.shuffle.partitions"]) > 3000


def test_guests_by_visitor(job, make_raw):
    raw = make_raw(*[event(str(i), i, user_id=None, ip_address=f"10.0.0.{i % 2}", user_agent="a") for i in range(4)], event("9", 5))
    assert job.run("1", raw=raw).count() == 2
    facts = {r["session_id"]: r["total_events_in_session"] for r in job.run("2", raw=raw, split_guests=True).collect()}
    assert sorted(facts.values()) == [1, 2, 2] and sum(k.startswith("guest:") for k in facts) == 2
    assert job.read("checks").where("not passed").count() == 0


def test_a_run_has_no_fewer_partitions_than_the_session(spark, job, monkeypatch):
    from clickloom.plans import refresh as module

    seen, build = [], module._build
    monkeypatch.setattr(module, "_build", lambda session, *rest: (seen.append(session.conf.get("spark.sql.shuffle.partitions")), build(session, *rest))[1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        job.run("1", raw_bytes=1)
        job.run("2", raw_bytes=30 * 256 * 2**20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == ["24", "30"]
