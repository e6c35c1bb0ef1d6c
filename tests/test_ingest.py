import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import text_field
from clickloom.operators.lookup import measure
from clickloom.operators.sessions import session_metrics, session_minutes
from clickloom.plans.refresh import RefreshConfig, publish
from clickloom.plans.staging import parse_events, valid_events, validate_events
from clickloom.sources.dimensions import load_dimension, read_products, read_users
from clickloom.sources.dated import closed_dates, write_batch
from clickloom.sources.messages import message_values, parse_messages, read_text, stream_text
from clickloom.sources.raw import LAKE_SCHEMA, read_lake, read_raw, stream_lake
from clickloom.sources.tables import shared_dir, write_table
from clickloom.streaming.events import (
    PublishedDimensions,
    first_copies,
    judge_again,
    live_sessions,
    read_routed,
    route_events,
    route_published,
    stream_events,
)
from clickloom.streaming.landing import (
    autoload,
    batch_counts,
    compact,
    keep_landing,
    keep_loading,
    land_files,
    land_messages,
    load_batches,
    start_table,
    unloaded_batches,
)

START = 1764000000


def message(event_id, minute=0, **fields):
    return json.dumps({"event_id": event_id, "event_timestamp": START + 60 * minute, **fields})


@pytest.fixture
def folder(tmp_path):
    """Message folder with a writer, plus places for the tables of the run."""
    (tmp_path / "in").mkdir()

    class Folder:
        source = str(tmp_path / "in")
        lake, lake_offsets = str(tmp_path / "lake"), str(tmp_path / "lake-offsets")
        raw, raw_offsets = str(tmp_path / "raw"), str(tmp_path / "raw-offsets")
        out, out_offsets = str(tmp_path / "out"), str(tmp_path / "out-offsets")

        def put(self, name, *lines):
            (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

        def land(self, spark, max_files=1000, archive=None, **options):
            source = stream_text(spark, self.source, max_files, archive=archive)
            land_messages(source, self.lake, self.lake_offsets, continuous=False, **options).awaitTermination()
            return self.counts(spark)

        def counts(self, spark):
            """Received, written and malformed messages of each batch."""
            return sorted(tuple(r)[1:] for r in batch_counts(read_lake(spark, self.lake)).collect())

        def load(self, spark, offsets=None, max_files=1000):
            files = stream_lake(spark, self.lake, max_files)
            offsets = offsets or self.raw_offsets
            autoload(files, self.lake, self.raw, offsets, continuous=False).awaitTermination()
            return read_raw(spark, self.raw)

        def files(self, place):
            return sorted(str(p) for p in (tmp_path / place).rglob("*.parquet"))

    return Folder()


def test_malformed_messages_become_dead_letters(spark, folder):
    folder.put("a", message("1"), "{bad", '{"event_id":"0","event_id":"2"}', "", "not json")
    counts = folder.land(spark)
    lake = read_lake(spark, folder.lake)
    events = lake.where("kind = 'event'").select(text_field(F.col("raw_data"), "event_id").alias("id"))
    assert sorted(r["id"] for r in events.collect()) == ["1", "2"]
    dead = lake.where("kind = 'dead_letter'")
    assert sorted(r["raw_text"] for r in dead.collect()) == ["", "not json", "{bad"]
    assert counts == [(5, 2, 3)]


def test_counts_do_not_depend_on_the_progress_a_query_keeps(spark, folder):
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        for i in range(8):
            folder.put(f"m{i}", message(str(i)), *["{bad"] * (i == 3))
        counts = folder.land(spark, max_files=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(counts) == 8 and [sum(c) for c in zip(*counts)] == [9, 8, 1]


def test_a_repeated_batch_replaces_its_first_try(spark, folder):
    lake = spark.createDataFrame([(None, "x", None, "dead_letter", None, "b")], LAKE_SCHEMA).drop("batch")
    parts = ("kind", "ingest_date")
    for _ in range(2):
        write_batch(lake, folder.lake, "q-0000000001", parts)
    assert read_lake(spark, folder.lake).count() == 1
    write_batch(lake, folder.lake, "q-0000000002", parts)
    assert read_lake(spark, folder.lake).count() == 2


def test_landed_files_leave_the_inbox(spark, folder, tmp_path):
    for i in range(3):
        folder.put(f"m{i}", message(str(i)))
        folder.land(spark, archive=str(tmp_path / "done"))
    # A file is moved when the batch after its own is committed.
    assert len(list((tmp_path / "in").iterdir())) <= 1
    assert read_lake(spark, folder.lake).count() == 3


def test_closed_dates_are_few_files_and_lose_or_double_nothing(spark, folder):
    for i in range(6):
        folder.put(f"m{i}", message(str(i)), "{bad")
    days = F.lit("2025-01-01 12:00:00").cast("timestamp")
    folder.land(spark, max_files=1, loaded_at=days)
    folder.load(spark, max_files=2)
    rows = lambda: sorted(r["id"] for r in read_raw(spark, folder.raw).select(text_field(F.col("raw_data"), "event_id").alias("id")).collect())
    want = rows()
    assert want == [str(i) for i in range(6)] and len(folder.files("raw")) >= 6
    for _ in range(2):  # repeating it changes nothing
        compact(spark, folder.lake, folder.raw, before="2025-01-02")
        assert rows() == want and folder.counts(spark) == [(2, 1, 1)] * 6
        assert [str(d) for d in closed_dates(spark, folder.raw)] == ["2025-01-01"]
        assert not [f for f in folder.files("raw") if "/open/" in f] and len(folder.files("raw/closed")) == 1
    folder.put("late", message("7"))
    folder.land(spark)
    assert folder.load(spark).count() == 7
    assert compact(spark, folder.lake, folder.raw, before="2025-01-02") == {"raw": [], "lake": []}
    # A loader with a new checkpoint loads what is open once more, and doubles nothing.
    assert folder.load(spark, offsets=folder.raw_offsets + "-2").count() == 7


def test_rows_of_closed_dates_are_merged_and_unloaded_ones_wait(spark, folder):
    day = F.lit("2025-01-01 12:00:00").cast("timestamp")
    day_before = {"before": "2025-01-02"}

    def ids():
        raw = read_raw(spark, folder.raw).select(text_field(F.col("raw_data"), "event_id").alias("id"))
        return sorted(r["id"] for r in raw.collect())

    folder.put("a", message("1"), "{bad")
    folder.land(spark, loaded_at=day)
    # The loader is behind, first with all and then with one batch: nothing is closed or removed.
    assert compact(spark, folder.lake, folder.raw, **day_before) == {"raw": [], "lake": []}
    folder.load(spark)
    folder.put("b", message("2"))
    folder.land(spark, loaded_at=day)
    assert compact(spark, folder.lake, folder.raw, **day_before) == {"raw": [], "lake": []}
    assert folder.load(spark).count() == 2 and ids() == ["1", "2"]
    first = compact(spark, folder.lake, folder.raw, **day_before)
    assert [str(d) for d in first["raw"]] == [str(d) for d in first["lake"]] == ["2025-01-01"]
    # Batches come for the closed date, twice: seen at once, kept in open until loaded, then merged.
    for name in ("3", "4"):
        want = [str(i + 1) for i in range(int(name))]
        folder.put(name, message(name))
        folder.land(spark, loaded_at=day)
        assert read_lake(spark, folder.lake).where("kind = 'event'").count() == int(name)
        assert compact(spark, folder.lake, folder.raw, **day_before) == {"raw": [], "lake": []}
        folder.load(spark)
        assert ids() == want
        merged = compact(spark, folder.lake, folder.raw, **day_before)
        assert ids() == want and [str(d) for d in merged["raw"]] == [str(d) for d in merged["lake"]] == ["2025-01-01"]
        assert not [f for place in ("raw", "lake") for f in folder.files(place) if "/open/" in f]
    assert sum(r for r, _, _ in folder.counts(spark)) == 5 and len(folder.files("raw/merged")) == 1
    with pytest.raises(ValueError):
        compact(spark, folder.lake, None, **day_before)


def test_a_batch_repeated_after_the_close_replaces_itself(spark, folder):
    rows = spark.createDataFrame([(None, t, None, "dead_letter", datetime(2025, 1, 1).date(), "b") for t in "xy"], LAKE_SCHEMA)
    parts = ("kind", "ingest_date")
    for batch in ("q-1", "q-2"):
        write_batch(rows.drop("batch"), folder.lake, batch, parts)
    for batch in ("q-2", "q-3"):
        compact(spark, folder.lake, folder.raw, before="2025-01-02")
        write_batch(rows.drop("batch"), folder.lake, batch, parts)
        assert read_lake(spark, folder.lake).count() == (4 if batch == "q-2" else 6)
    compact(spark, folder.lake, folder.raw, before="2025-01-02")
    assert folder.counts(spark) == [(2, 0, 2)] * 3


def test_queue_records_without_a_broker(spark):
    records = spark.createDataFrame([(bytearray(b'{"event_id":"1"}'), 0), (None, 1), (bytearray(b"\xc3\xa9{"), 2)], "value binary, offset long")
    parsed = parse_messages(message_values(records))
    assert [(r["kind"], r["raw_text"]) for r in parsed.select("kind", "raw_text").collect()] == [
        ("event", None),
        ("dead_letter", ""),
        ("dead_letter", "é{"),
    ]


def test_restart_lands_only_new_files_and_an_empty_batch_writes_nothing(spark, folder):
    folder.put("a", message("1"))
    folder.land(spark)
    before = folder.files("lake")
    assert folder.land(spark) == [(1, 1, 0)]
    assert folder.files("lake") == before
    folder.put("b", message("2"))
    folder.land(spark)
    assert read_lake(spark, folder.lake).count() == 2


def test_autoload_takes_each_file_once_and_notes_where_rows_came_from(spark, folder):
    folder.put("a", message("1"), message("2"), "{bad")
    folder.land(spark)
    assert folder.load(spark).count() == 2
    folder.put("b", message("3"))
    folder.land(spark)
    raw = folder.load(spark)
    assert raw.count() == 3
    assert raw.select("metadata_filename", "metadata_file_row_number").distinct().count() == 3
    path = "%/lake/open/kind=event/ingest_date=%/batch=%.parquet"
    assert raw.where(f"metadata_filename like '{path}' and loaded_at is not null").count() == 3
    assert read_raw(spark, folder.raw, since="2999-01-01").count() == 0


def test_continuous_query(spark, folder):
    folder.put("a", message("1"))
    query = land_messages(stream_text(spark, folder.source, max_files=1), folder.lake, folder.lake_offsets)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_lake(spark, folder.lake).count() == 1


def test_records_of_one_batch_may_differ_in_keys_and_types(spark, folder):
    folder.put(
        "a",
        message("1", quantity=1),
        json.dumps({"event_id": "2", "event_timestamp": "2025-11-24T16:00:00+00:00", "quantity": 1.0}),
        json.dumps({"event_id": "3", "event_timestamp": START, "extra": {"a": [1]}}),
    )
    folder.land(spark)
    events = parse_events(folder.load(spark))
    got = {r["event_id"]: (r["event_at_ts"], r["quantity"]) for r in events.collect()}
    same = datetime(2025, 11, 24, 16, 0)
    assert got == {"1": (same, 1), "2": (same, 1), "3": (same, None)}


def test_lake_is_partitioned_by_local_date(spark, folder):
    folder.put("a", message("1"))
    folder.land(spark, loaded_at=F.lit("2025-01-01 23:30:00").cast("timestamp"))
    assert all("kind=event/ingest_date=2025-01-02" in path for path in folder.files("lake"))


def test_batch_parse_of_text(spark, folder):
    folder.put("a", message("1"), "{bad")
    kinds = parse_messages(read_text(spark, folder.source)).groupBy("kind").count()
    assert {tuple(r) for r in kinds.collect()} == {("event", 1), ("dead_letter", 1)}


def raw_stream(spark, folder, **options):
    folder.land(spark)
    folder.load(spark)
    schema = read_raw(spark, folder.raw).schema
    reader = spark.readStream.schema(schema).options(**options)
    return stream_events(reader.parquet(f"{folder.raw}/open"))


def emitted(spark, stream, folder):
    """What a stream emits in append mode over all that is there."""
    start_table(stream, folder.out, folder.out_offsets, continuous=False).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder.out}/open").collect()


def test_streaming_dedup_keeps_one_of_the_copies_sent(spark, folder):
    folder.put("a", message("1"), message("1", minute=1), message("2"), '{"event_id":"3","event_timestamp":"junk"}')
    got = emitted(spark, first_copies(raw_stream(spark, folder)).select("event_id", "event_at_ts"), folder)
    assert sorted(r["event_id"] for r in got) == ["1", "2"]
    assert {r["event_at_ts"].minute for r in got if r["event_id"] == "1"} <= {0, 1}


def test_streaming_dedup_remembers_copies_across_restarts(spark, folder):
    folder.put("a", *[message("hot", minute=m % 3) for m in range(100)], message("1"))
    for name, new in (("b", "2"), ("c", "3")):
        got = emitted(spark, first_copies(raw_stream(spark, folder)).select("event_id"), folder)
        folder.put(name, message("hot", minute=4), message("1", minute=5), message(new, minute=6))
    assert sorted(r["event_id"] for r in got) == ["1", "2", "hot"]


def arriving(spark, folder, *batches):
    """A typed stream whose micro-batches are the given messages."""
    path = f"{folder.raw}-arriving"
    for batch in batches:
        folder.put("m", *batch)
        raw = parse_messages(read_text(spark, f"{folder.source}/m")).selectExpr(
            "raw_data", "'f' as metadata_filename", "0L as metadata_file_row_number", "loaded_at"
        )
        raw.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
    return stream_events(reader.parquet(path))


def test_streaming_sessions_are_the_batch_sessions(spark, folder):
    minutes = [0, 5, 36, 66, 97, 127, 200]
    sent = [message(str(i), minute=m, user_id="u", utm_source=f"s{i}") for i, m in enumerate(minutes)]
    copy = message("1", minute=6, user_id="u")
    end = message("end", minute=500, user_id="v")
    got = emitted(spark, live_sessions(arriving(spark, folder, sent[:2], [copy, *sent[2:4]], sent[4:], [end])), folder)
    columns = ["session_started_at_ts", "session_ended_at_ts", "total_events_in_session", "session_utm_source"]
    folder.put("a", *sent)
    folder.land(spark)
    priced = parse_events(folder.load(spark)).dropDuplicates(["event_id"])
    priced = priced.withColumn("value", F.lit(None).cast("decimal(21,2)")).where("event_id <> 'end'")
    want = {tuple(r) for r in session_metrics(session_minutes(priced)).select(*columns).collect()}
    assert {tuple(r[c] for c in columns) for r in got} == want and len(got) == 4


def test_late_events_on_either_side_of_the_watermark(spark, folder):
    """An hour of lateness: the watermark is at minute 60 once minute 120 has been seen."""

    def sessions(late):
        first = [message("1", minute=100, user_id="u"), message("2", minute=120, user_id="w")]
        then = [message("late", minute=late, user_id="u"), message("3", minute=121, user_id="w")]
        end = [message("end", minute=900, user_id="z")]
        got = emitted(spark, live_sessions(arriving(spark, folder, first, then, end)), folder)
        return sorted(r["total_events_in_session"] for r in got if r["user_id"] == "u")

    assert sessions(75) == [2]


def test_events_behind_the_watermark_are_dropped(spark, folder):
    first = [message("1", minute=100, user_id="u"), message("2", minute=300, user_id="w")]
    then = [message("3", minute=301, user_id="w")]  # the watermark holds for the batch after the next
    late = [message("late", minute=110, user_id="u")]
    end = [message("end", minute=900, user_id="z")]
    got = emitted(spark, live_sessions(arriving(spark, folder, first, then, late, end)), folder)
    assert sorted((r["user_id"], r["total_events_in_session"]) for r in got) == [("u", 1), ("w", 2)]


def test_stream_routing_equals_batch_validation(spark, folder):
    folder.put(
        "a",
        message("1", event_type="page_view"),
        message("2", event_type="page_view", user_id="user-9"),
        message("3", event_type="checkout"),
        '{"event_id":"4","event_timestamp":"junk"}',
    )
    products = measure(spark.createDataFrame([("p",)], "product_id string"), "product_id")
    users = measure(spark.createDataFrame([("guest",)], "user_id string"), "user_id")
    stream = raw_stream(spark, folder).drop("event_at", "event_minute")
    route_events(stream, products, users, folder.out, folder.out_offsets, continuous=False).awaitTermination()
    routed = {
        (r["event_id"], str(r["is_valid_record"]).lower(), r["reject_reason"])
        for r in read_routed(spark, folder.out).collect()
    }
    batch = validate_events(parse_events(read_raw(spark, folder.raw)), products, users)
    want = {(r["event_id"], str(r["is_valid_record"]).lower(), r["reject_reason"]) for r in batch.collect()}
    assert routed == want and len(want) == 4
    assert valid_events(batch).count() == 1


def test_dimensions_from_csv(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_name,category,price\nprod-1,Lamp,Home,10.50\n")
    (tmp_path / "users.csv").write_text("user_id,registration_date,country\nuser-1,2025-01-15,FR\nguest,,\n")
    products = load_dimension(read_products(spark, str(tmp_path / "products.csv")), str(tmp_path / "p"))
    assert str(products.first()["price"]) == "10.50"
    users = load_dimension(read_users(spark, str(tmp_path / "users.csv")), str(tmp_path / "u"))
    guest = users.where("user_id = 'guest'").first()
    assert guest["registration_date"] is None and guest["country"] is None
    # A load replaces the table.
    assert load_dimension(users.where("false"), str(tmp_path / "p")).count() == 0


def test_malformed_dimension_stops_the_load(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,product_name,category,price\nprod-1,Lamp,Home,cheap\n")
    with pytest.raises(Exception, match="MALFORMED|cheap"):
        read_products(spark, str(tmp_path / "products.csv")).collect()


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(spark.range(3), path).count() == 3
    assert write_table(spark.range(1), path).count() == 1
    assert shared_dir(spark)


def ids_in(raw):
    return sorted(r["id"] for r in raw.select(text_field(F.col("raw_data"), "event_id").alias("id")).collect())


def test_loader_takes_what_the_raw_table_lacks(spark, folder, monkeypatch):
    for i in range(5):
        folder.put(f"m{i}", message(str(i)), "{bad")
    folder.land(spark, max_files=1, loaded_at=F.lit("2025-01-01 12:00:00").cast("timestamp"))
    assert len(unloaded_batches(spark, folder.lake, folder.raw)) == 5
    # A run that stops leaves whole batches; the next one takes the rest.
    steps = []

    def failing(df, path, *args):
        if steps:
            raise OSError("stopped")
        steps.append(path)
        write_batch(df, path, *args)

    monkeypatch.setattr("clickloom.streaming.landing.write_batch", failing)
    with pytest.raises(OSError):
        load_batches(spark, folder.lake, folder.raw, max_batches=2)
    monkeypatch.undo()
    assert len(unloaded_batches(spark, folder.lake, folder.raw)) == 3
    assert load_batches(spark, folder.lake, folder.raw, max_batches=2) == 3
    assert load_batches(spark, folder.lake, folder.raw) == 0
    raw = read_raw(spark, folder.raw)
    assert ids_in(raw) == [str(i) for i in range(5)]
    assert raw.where("metadata_filename like '%/kind=event/%' and loaded_at is not null").count() == 5
    # Nothing is kept besides the table.
    assert {f.split("/raw/")[1].split("/")[0] for f in folder.files("raw")} == {"open"}


def test_loader_takes_late_batches_of_closed_dates_once(spark, folder):
    day = {"loaded_at": F.lit("2025-01-01 12:00:00").cast("timestamp")}
    folder.put("a", message("1"))
    folder.land(spark, **day)
    load_batches(spark, folder.lake, folder.raw)
    compact(spark, folder.lake, folder.raw, before="2025-01-02")
    assert unloaded_batches(spark, folder.lake, folder.raw) == []
    folder.put("b", message("2"))
    folder.land(spark, **day)
    assert load_batches(spark, folder.lake, folder.raw) == 1
    assert load_batches(spark, folder.lake, folder.raw) == 0
    assert ids_in(read_raw(spark, folder.raw)) == ["1", "2"]
    # Closed in the raw table alone, the batch is still open in the lake: its files say that it is there.
    compact(spark, None, folder.raw, before="2025-01-02")
    assert load_batches(spark, folder.lake, folder.raw) == 0
    compact(spark, folder.lake, folder.raw, before="2025-01-02")
    assert load_batches(spark, folder.lake, folder.raw) == 0
    assert ids_in(read_raw(spark, folder.raw)) == ["1", "2"]


def test_loader_on_a_clock(spark, folder):
    folder.put("a", message("1"))
    folder.land(spark)
    query = keep_loading(spark, folder.lake, folder.raw, folder.raw_offsets)
    try:
        for _ in range(120):
            if query.lastProgress and not unloaded_batches(spark, folder.lake, folder.raw):
                break
            query.awaitTermination(0.5)
    finally:
        query.stop()
    assert ids_in(read_raw(spark, folder.raw)) == ["1"]


def test_dimensions_published_under_a_running_stream(spark, folder, tmp_path):
    warehouse = str(tmp_path / "warehouse")
    users = spark.createDataFrame([("u1", None, "FR"), ("guest", None, None)], "user_id string, registration_date date, country string")

    def bring(run, *names):
        config = RefreshConfig(warehouse, run, "2025-01-01 00:00:00")
        rows = [(n, n, "c") for n in names]
        write_table(spark.createDataFrame(rows, "product_id string, product_name string, category string"), config.table("products"))
        write_table(users, config.table("users"))
        publish(spark, config)

    def route(*lines):
        folder.put(f"m{len(list((tmp_path / 'in').iterdir()))}", *lines)
        folder.land(spark)
        load_batches(spark, folder.lake, folder.raw)
        reader = spark.readStream.schema(read_raw(spark, folder.raw).schema).option("recursiveFileLookup", "true")
        events = stream_events(reader.parquet(f"{folder.raw}/open")).drop("event_at", "event_minute")
        route_published(events, warehouse, folder.out, folder.out_offsets, continuous=False).awaitTermination()
        found = read_routed(spark, folder.out).collect()
        assert len(found) == len({r["event_id"] for r in found})
        return {r["event_id"]: r["reject_reason"] for r in found}

    with pytest.raises(Exception, match="nothing has been published"):
        route(message("0", event_type="page_view"))
    bring("1", "p1")
    got = route(*[message(i, event_type="product_view", product_id=p) for i, p in (("1", "p1"), ("2", "p2"), ("3", "p3"))], message("4", event_type="checkout"))
    assert got == {"0": None, "1": None, "2": "unknown_product", "3": "unknown_product", "4": "missing_product"}
    bring("2", "p1", "p2")
    got = route(message("5", event_type="product_view", product_id="p2"))
    assert got == {"0": None, "1": None, "2": None, "3": "unknown_product", "4": "missing_product", "5": None}
    bring("3", "p1", "p2", "p3")
    dimensions = PublishedDimensions(spark, warehouse)
    assert judge_again(spark, folder.out, *dimensions.current()) == 1 and judge_again(spark, folder.out, *dimensions.current()) == 0
    got = route(message("6", event_type="product_view", product_id="p4"))
    assert got["3"] is None and got["6"] == "unknown_product" and len(got) == 7


def test_stopped_judgement_is_repeated(spark, folder, tmp_path, monkeypatch):
    products = measure(spark.createDataFrame([("p1",)], "product_id string"), "product_id")
    users = measure(spark.createDataFrame([("guest", None)], "user_id string, country string"), "user_id", ["country"])
    none = measure(products.df.where("product_id = 'x'"), "product_id")
    folder.put("a", message("1", event_type="product_view", product_id="p1"), message("2", event_type="product_view", product_id="p2"))
    folder.land(spark)
    load_batches(spark, folder.lake, folder.raw)
    events = parse_events(read_raw(spark, folder.raw))
    write_batch(validate_events(events, none, users), folder.out, "b-1", ["is_valid_record"])
    calls = []

    def stops(df, path, *args, **kwargs):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("stopped")
        write_batch(df, path, *args, **kwargs)

    monkeypatch.setattr("clickloom.streaming.events.write_batch", stops)
    with pytest.raises(OSError):
        judge_again(spark, folder.out, "1", products, users)
    monkeypatch.undo()
    assert judge_again(spark, folder.out, "1", products, users) == 1
    assert sorted((r["event_id"], r["reject_reason"]) for r in read_routed(spark, folder.out).collect()) == [("1", None), ("2", "unknown_product")]


def test_landed_files_are_moved_and_remembered_nowhere(spark, folder, tmp_path, monkeypatch):
    done = str(tmp_path / "done")
    for i in range(5):
        folder.put(f"m{i}", message(str(i)), "{bad")
    (tmp_path / "in" / ".m9").write_text("still being written")
    # A run that stops between landing and moving: the next one lands the same files in place of themselves.
    monkeypatch.setattr("clickloom.streaming.landing.move_files", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        land_files(spark, folder.source, folder.lake, done, max_files=3)
    monkeypatch.undo()
    assert len(folder.counts(spark)) == 3
    load_batches(spark, folder.lake, folder.raw)
    assert land_files(spark, folder.source, folder.lake, done, max_files=2) == 5
    assert land_files(spark, folder.source, folder.lake, done) == 0
    assert folder.counts(spark) == [(2, 1, 1)] * 5
    load_batches(spark, folder.lake, folder.raw)
    assert ids_in(read_raw(spark, folder.raw)) == [str(i) for i in range(5)]
    assert [p.name for p in (tmp_path / "in").iterdir()] == [".m9"] and len(list((tmp_path / "done").glob("*-m*"))) == 5
    # A file of the same name that comes later is another one.
    folder.put("m0", message("new"))
    assert land_files(spark, folder.source, folder.lake, done) == 1
    load_batches(spark, folder.lake, folder.raw)
    assert len(ids_in(read_raw(spark, folder.raw))) == 6
    assert {f.split("/lake/")[1].split("/")[0] for f in folder.files("lake")} == {"open"}


def test_landing_on_a_clock(spark, folder, tmp_path):
    folder.put("a", message("1"))
    query = keep_landing(spark, folder.source, folder.lake, str(tmp_path / "done"), folder.lake_offsets)
    try:
        for _ in range(120):
            if not list((tmp_path / "in").iterdir()):
                break
            query.awaitTermination(0.5)
    finally:
        query.stop()
    assert read_lake(spark, folder.lake).count() == 1


def test_a_batch_of_many_files_is_loaded_once(spark, folder, monkeypatch):
    from clickloom.streaming import landing

    rows = spark.range(24).select(
        F.try_parse_json(F.concat(F.lit('{"event_id":"'), "id", F.lit('"}'))).alias("raw_data"),
        F.lit(None).cast("string").alias("raw_text"),
        F.current_timestamp().alias("loaded_at"),
        F.lit("event").alias("kind"),
        F.lit("2024-05-01").cast("date").alias("ingest_date"),
    )
    for batch in ("a b", "q-2"):
        write_batch(rows.repartition(4), folder.lake, batch, ("kind", "ingest_date"))
    writes = []
    monkeypatch.setattr(landing, "write_batch", lambda df, path, *rest: (writes.append(path), write_batch(df, path, *rest)))
    assert folder.load(spark, max_files=1).count() == 48
    assert len(writes) == 2
    # Landed anew, it is loaded anew.
    write_batch(rows.repartition(3), folder.lake, "q-2", ("kind", "ingest_date"))
    assert folder.load(spark, max_files=1).count() == 48
    assert len(writes) == 3
