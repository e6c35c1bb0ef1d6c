"""What the physical plans must look like for the jobs to hold at scale."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from clickloom.operators.asof import price_asof
from clickloom.operators.lookup import measure
from clickloom.operators.sessions import event_gaps, session_metrics, session_minutes, with_session_index
from clickloom.plans.marts import fact_sessions
from clickloom.plans.refresh import table_checks
from clickloom.plans.staging import parse_events, valid_events, validate_events
from clickloom.sources.tables import materialize


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df):
    return plan(df).split("\n\n\n")[0]


@pytest.fixture(scope="module")
def raw(make_raw):
    message = (
        '{"event_id":"1","event_timestamp":1764000000,"event_type":"checkout","user_id":"u",'
        '"product_id":"p","quantity":1,"platform":"web"}'
    )
    strange = message.replace('"u"', '"nobody"'), message.replace('"p"', '"nothing"')
    return materialize(make_raw(*[message] * 50, *strange), "raw")


@pytest.fixture
def sort_merge(spark):
    """Planning without automatic broadcasts, as for large inputs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(params=["small", "large"])
def dims(request, spark):
    options = {"max_broadcast_bytes": 0} if request.param == "large" else {}
    products = spark.createDataFrame([("p",)], "product_id string")
    users = spark.createDataFrame([("u", "FR")], "user_id string, country string")
    versions = products.selectExpr(
        "product_id",
        "cast(1 as decimal(10,2)) as price",
        "timestamp_ntz'2025-01-01' as valid_from",
        "cast(null as timestamp_ntz) as valid_to",
    )
    return (
        request.param,
        measure(products, "product_id", **options),
        measure(users, "user_id", **options),
        measure(versions, "product_id", **options),
    )


def pipeline(raw, dims):
    _, products, users, versions = dims
    return price_asof(valid_events(validate_events(parse_events(raw), products, users)), versions)


def test_no_nested_loops_products_or_python(raw, dims, sort_merge):
    events = pipeline(raw, dims)
    for df in (events, session_metrics(session_minutes(events)), with_session_index(events)):
        text = plan(df)
        for forbidden in ("NestedLoop", "CartesianProduct", "EvalPython", "PandasUDF", "MapInPandas"):
            assert forbidden not in text


def test_dimensions_are_broadcast_only_within_the_bound(raw, dims, sort_merge):
    shape = tree(pipeline(raw, dims))
    if dims[0] == "small":
        assert shape.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in shape
    else:
        assert shape.count("SortMergeJoin") == 3 and "Broadcast" not in shape


def test_events_without_a_key_are_spread_in_shuffled_lookups(raw, dims, sort_merge):
    if dims[0] == "large":
        exchanges = [line for line in plan(pipeline(raw, dims)).splitlines() if "hashpartitioning" in line]
        assert sum("xxhash64(event_id" in line for line in exchanges) == 3


def test_hot_partitions_of_shuffled_lookups_can_be_split(raw, dims, sort_merge):
    if dims[0] == "large":
        # Both inputs of each join are sorted shuffles, with no aggregate in between.
        shape = tree(pipeline(raw, dims))
        assert "HashAggregate" not in shape and "SortAggregate" not in shape


def test_large_dimension_with_few_unknown_keys_leaves_events_in_place(spark, raw, sort_merge):
    users = spark.range(100).selectExpr("concat('user-', id) as user_id", "'FR' as country")
    products = spark.range(100).selectExpr("concat('prod-', id) as product_id")
    large = {"max_broadcast_bytes": 1000}
    judged = validate_events(
        parse_events(raw), measure(products, "product_id", **large), measure(users, "user_id", **large)
    )
    text = plan(judged)
    assert "hashpartitioning" not in text and text.count("BroadcastHashJoin LeftOuter") == 2
    assert {r["reject_reason"] for r in judged.collect()} == {"unknown_product"}


def test_nothing_unknown_needs_no_join(spark, make_raw, sort_merge):
    good = make_raw(
        '{"event_id":"1","event_timestamp":1764000000,"event_type":"checkout","user_id":"u","product_id":"p"}'
    )
    products = spark.createDataFrame([("p",)], "product_id string")
    users = spark.createDataFrame([("u",)], "user_id string")
    large = {"max_broadcast_bytes": 0}
    judged = validate_events(
        parse_events(good), measure(products, "product_id", **large), measure(users, "user_id", **large)
    )
    assert "Join" not in plan(judged)
    assert judged.first()["is_valid_record"]


def test_small_dimensions_leave_one_shuffle_of_events(raw, dims):
    if dims[0] == "small":
        exchanges = re.findall(r"hashpartitioning\((\w+)#", plan(pipeline(raw, dims)))
        assert exchanges.count("event_id") == 1
        # The others are the distinct keys of the two dimensions.
        assert sorted(exchanges) == ["event_id", "product_id", "user_id"]


def test_copies_are_cut_before_the_shuffle(raw, dims):
    shape = tree(valid_events(parse_events(raw).withColumns({"is_valid_record": F.lit(True), "reject_reason": F.lit("")})))
    assert re.search(r"WindowGroupLimit.*\n.*Sort.*\n.*Exchange.*\n.*WindowGroupLimit", shape)


def test_scan_reads_only_the_fields_a_query_needs(raw):
    text = plan(parse_events(raw).select("event_id", "platform"))
    fields = re.search(r"ReadSchema: struct<raw_data:struct<(.*?)>>", text).group(1)
    # event_id, event time (as text) and platform: three columns of the shredded variant.
    assert len(fields.split(",")) == 3
    assert "IsNotNull(raw_data" in re.search(r"PushedFilters: (.*)", text).group(1)


def test_user_window_runs_over_aggregated_minutes(make_events, sort_merge):
    events = materialize(make_events([("a", "u", "10:00")]), "events")
    text = plan(session_metrics(session_minutes(events)))
    exchanges = re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)
    assert [re.sub(r"#\d+L?", "", keys) for keys in exchanges] == ["user_id, minute", "user_id"]


def test_sessions_reach_events_by_user_and_minute(make_events, sort_merge):
    events = materialize(make_events([("a", "u", "10:00")]), "events")
    text = plan(with_session_index(events))
    exchanges = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)]
    # Events by (user, minute); minutes by (user, minute), by user for the window, and back.
    assert sorted(exchanges) == ["user_id", "user_id, minute", "user_id, minute", "user_id, minute"]


def windows_by_user(text):
    """Window steps over a user as a whole."""
    return len(re.findall(r"Arguments: \[.*windowspecdefinition\(user_id#\d+, minute#", text))


def test_facts_order_a_user_once(spark, make_events, sort_merge):
    """The session minutes are the only place where a user's rows are put in order; the facts read them."""
    events = materialize(make_events([("a", "u", "10:00")]), "events")
    users = measure(spark.createDataFrame([("u", "FR")], "user_id string, country string"), "user_id", ["country"])
    minutes = session_minutes(events)
    # Idle time and running number: two functions over one sort of one shuffle by user.
    exchanges = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan(minutes))
    assert [re.sub(r"#\d+L?", "", keys) for keys in exchanges] == ["user_id, minute", "user_id"]
    facts = plan(fact_sessions(events, users))
    assert "Window" not in facts and windows_by_user(facts) == 0


def test_checks_do_not_join_events_to_their_sessions(spark, make_events, sort_merge):
    events = materialize(make_events([("a", "u", "10:00")]), "events")
    users = measure(spark.createDataFrame([("u", "FR")], "user_id string, country string"), "user_id", ["country"])
    minutes = materialize(session_minutes(events), "minutes")
    facts = materialize(fact_sessions(events, users, minutes=minutes), "facts")
    text = plan(table_checks(events, minutes, facts, users))
    exchanges = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)]
    assert exchanges.count("event_id") == 1
    # Distinct minutes of the events meet the distinct minutes that have a session.
    assert len(re.findall(r"SortMergeJoin LeftAnti", text.split("\n\n\n")[0])) <= 2
    assert {r["passed"] for r in table_checks(events, minutes, facts, users).collect()} == {True}


def test_gaps_order_instants_within_a_second(make_events, sort_merge):
    text = plan(event_gaps(materialize(make_events([("a", "u", "10:00")]), "events")))
    specs = set(re.findall(r"windowspecdefinition\(([^)]*?) ASC", re.sub(r"#\d+L?", "", text)))
    assert specs == {"user_id, second, event_at_ts", "user_id, minute, second", "user_id, minute"}
