"""Alerts and weather on streams against their batch forms, state and late rows."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators import enrichment
from transitloom.operators.messages import encode_json
from transitloom.plans import testdata
from transitloom.streaming import sinks
from transitloom.streaming.alerts import trip_alert_stream
from transitloom.streaming.jobs import monitor_delays, watch_trips
from transitloom.streaming.weather import weather_enrich_stream

TRIPS = "trip_id string, stop_time_updates array<struct<stop_id:string,arrival_time:bigint,departure_time:bigint>>"
SEEN = "trip_id string, stop string, timestamp_seconds bigint"
HOUR = 3600


def _stream(spark, folder, batches, schema):
    """The batches as files, read one at a time in that order."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(df, tmp_path, name):
    job = sinks.start_files(df, f"{tmp_path}/{name}", f"{tmp_path}/{name}-cp", available_now=True)
    job.awaitTermination()
    return job


def _trip(name, *stops):
    return (name, [(stop, at, at and at + 10) for stop, at in stops])


def test_trip_alerts_in_batch(spark):
    trips = spark.createDataFrame(
        [_trip("t", ("a", 10_000), ("b", 20_000), ("c", 15_000), ("d", 30_000), ("e", None)),
         _trip("t", ("a", 10_000)), ("u", []), ("v", None), _trip(None, ("a", 10_000))], TRIPS)
    seen = spark.createDataFrame(
        [("t", "a", 10_300), ("t", "a", 12_000), ("t", "b", 19_699), ("t", "b", 18_000), ("t", "c", 15_301),
         ("t", "d", 31_201), ("w", "a", 1), (None, "a", 10_000), ("t", None, 1)], SEEN)
    for hot in ({}, {"hot_rows": 1, "hot_share": 0.0}):
        assert rows(enrichment.trip_alerts(trips, seen, **hot)) == [
            ("t", 1, "b", 20_000, "early", -301), ("t", 2, "c", 15_000, "late", None),
            ("t", 2, "c", 15_000, "out_of_order", -5_000),
            ("t", 3, "d", 30_000, "late", None), ("t", 3, "d", 30_000, "missing", None)]


def test_alerts_deal_each_side_once(spark):
    trips = spark.createDataFrame([_trip(f"t{k}", ("a", 10_000), ("b", 20_000)) for k in range(20)], TRIPS)
    seen = spark.createDataFrame([(f"t{k}", "a", 10_000 + 30 * k) for k in range(20)], SEEN)
    found = enrichment.trip_alerts(trips, seen)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "planned-" not in plan
    assert found.where("issue = 'late'").count() == 9 + 20


def test_live_alerts_equal_the_batch(spark, tmp_path):
    plans = [
        [_trip("t", ("a", 10_000), ("b", 20_000), ("c", 15_000)), _trip("u", ("a", 11_000))],
        [_trip("t", ("a", 10_000), ("b", 20_000), ("c", 15_000)), _trip("u", ("z", 21_000))],
        [_trip("w", ("a", 23_000), ("a", 23_100))],
        [(None, [("-", 900_000, None)])],
    ]
    # Out of order, and some later than what was seen after them.
    seen = [
        [("t", "b", 19_000), ("u", "a", 12_500)],
        [("t", "a", 10_100), ("u", "a", 10_900), ("t", "c", 15_900)],
        [("u", "z", 20_500), ("w", "a", 23_200), ("w", "a", 23_200)],
        [(None, None, 900_000)],
    ]
    trips = _stream(spark, f"{tmp_path}/trips", plans, TRIPS)
    vehicles = _stream(spark, f"{tmp_path}/vehicles", seen, SEEN)
    job = _run(trip_alert_stream(trips, vehicles, watermark="4 hours"), tmp_path, "alerts")
    stored = spark.read.parquet(f"{tmp_path}/alerts")
    expected = enrichment.trip_alerts(
        spark.createDataFrame(sum(plans, []), TRIPS), spark.createDataFrame(sum(seen, []), SEEN))
    assert rows(stored) == rows(expected) and stored.count() == 4
    left = [state["numRowsTotal"] for state in job.lastProgress["stateOperators"]]
    assert left == [0]


def test_missing_stops_are_told_before_the_end(spark, tmp_path):
    trips = _stream(spark, f"{tmp_path}/trips", [[_trip("t", ("a", 10_000), ("b", 90_000))]], TRIPS)
    vehicles = _stream(spark, f"{tmp_path}/vehicles", [[("t", "x", 10_000)], [(None, None, 20_000)]], SEEN)
    job = _run(trip_alert_stream(trips, vehicles, watermark="1 minute"), tmp_path, "alerts")
    found = rows(spark.read.parquet(f"{tmp_path}/alerts"), "stop", "issue")
    assert found == [("a", "late"), ("a", "missing")]  # b is still to come, and does not move the time
    assert job.lastProgress["stateOperators"][0]["numRowsTotal"] > 0


def test_a_sighting_beyond_the_watermark_is_left_out(spark, tmp_path):
    trips = _stream(spark, f"{tmp_path}/trips", [
        [_trip("t", ("a", 10_000))], [(None, [])], [(None, [])], [_trip("t", ("late", 10_000))]], TRIPS)
    vehicles = _stream(spark, f"{tmp_path}/vehicles", [
        [("t", "x", 10_000)], [(None, None, 50_000)], [(None, None, 50_000)], [("t", "a", 10_000)]], SEEN)
    _run(trip_alert_stream(trips, vehicles, watermark="1 minute"), tmp_path, "alerts")
    assert rows(spark.read.parquet(f"{tmp_path}/alerts"), "stop", "issue") == [("a", "late"), ("a", "missing")]


def test_watch_trips_reads_records(spark, tmp_path):
    trips = spark.createDataFrame(
        [("7", "R", "10:00", "2024-01-01", None, [("a", 10_000, 10_010), ("b", 20_000, 20_010)]),
         (None, None, None, None, None, [("-", 900_000, None)])],
        "trip_id string, route_id string, start_time string, start_date string, status string, "
        "stop_time_updates array<struct<stop_id:string,arrival_time:bigint,departure_time:bigint>>")
    vehicles = spark.createDataFrame(
        [(7, "a", 10_050), (None, None, 900_000)], "journey_id int, stop string, timestamp_seconds bigint")
    for name, frame in (("trip", trips), ("vehicle", vehicles)):
        encode_json(frame).write.parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema("value binary").parquet(f"{tmp_path}/{name}") for name in ("trip", "vehicle")]
    job = watch_trips(*streams, [sinks.table_writer(f"{tmp_path}/out")], f"{tmp_path}/cp", "1 hour", available_now=True)
    job.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), "trip_id", "stop", "issue") == [
        ("7", "b", "late"), ("7", "b", "missing")]


REPORTS = "place string, minute bigint, temperature double, report int"
POSITIONS = "place string, minute bigint, vehicle int"


@pytest.mark.parametrize("salts", [None, 1, 5])
def test_live_weather_equals_the_batch(spark, tmp_path, salts):
    reports = [
        [("x", 10, 1.0, 1), ("x", 40, 2.0, 2), ("y", 50, 9.0, 3)],
        [("x", 30, 3.0, 4), ("x", 40, 4.0, 5), ("x", 40, 5.0, 1), ("y", 5, None, 6), ("x", None, 7.0, 7)],
        [("x", 700, 6.0, 8)],
        [("x", 9_000, 0.0, 9)],
    ]
    positions = [
        [("x", 35, 1), ("x", 9, 2), ("y", 49, 3), ("x", None, 4), ("z", 5, 5)],
        [("x", 35, 6), ("x", 45, 7), ("y", 50, 8), ("y", 51, 9)] + [("x", 41, 100 + k) for k in range(50)],
        [("x", 699, 10), ("x", 701, 11), ("y", 800, 12)],
        [("x", 9_000, 13)],
    ]
    joined = weather_enrich_stream(
        _stream(spark, f"{tmp_path}/positions", positions, POSITIONS),
        _stream(spark, f"{tmp_path}/reports", reports, REPORTS),
        watermark="12 hours", by=["place"], tie_break=["report"], salts=salts,
    )
    _run(joined, tmp_path, "out")
    settled = [row for row in sum(positions, []) if row[1] != 9_000]
    expected = enrichment.weather_enrich(
        spark.createDataFrame(settled, POSITIONS), spark.createDataFrame(sum(reports, []), REPORTS),
        by=["place"], tie_break=["report"])
    assert rows(spark.read.schema(joined.schema).parquet(f"{tmp_path}/out")) == rows(expected, *joined.columns)


def test_live_states_need_no_setting_of_the_session(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, plain)
    try:
        joined = weather_enrich_stream(
            _stream(spark, f"{tmp_path}/positions", [[("x", 35, 1)], [("x", 9_000, 2)]], POSITIONS),
            _stream(spark, f"{tmp_path}/reports", [[("x", 30, 1.0, 1)], [("x", 9_000, 0.0, 2)]], REPORTS),
            watermark="1 hour", by=["place"], tie_break=["report"])
        _run(joined, tmp_path, "weather")
        trips = _stream(spark, f"{tmp_path}/trips", [[_trip("t", ("a", 10_000))]], TRIPS)
        seen = _stream(spark, f"{tmp_path}/seen", [[("t", "x", 10_000)], [(None, None, 20_000)]], SEEN)
        _run(trip_alert_stream(trips, seen, watermark="1 minute"), tmp_path, "alerts")
    finally:
        spark.conf.set(name, before)
    weather = spark.read.schema(joined.schema).parquet(f"{tmp_path}/weather")
    assert rows(weather) == [("x", 35, 1, 1.0, 1)]
    assert rows(spark.read.parquet(f"{tmp_path}/alerts"), "stop", "issue") == [("a", "late"), ("a", "missing")]


def test_windows_are_written_once_and_dropped(spark, tmp_path):
    vehicles = [
        [("R1", 10, "2025-01-01T10:00:00Z"), ("R1", 20, "2025-01-01T10:59:59Z"), ("R2", None, "2025-01-01T10:01:00Z")],
        [("R1", 30, "2025-01-01T10:30:00Z"), ("R1", 5, "2025-01-01T12:10:00Z"), ("R1", 1, "soon")],
        [("R9", 0, "2025-02-01T00:00:00Z")],
        [("R9", 0, "2025-02-01T00:00:00Z")],
        [("R1", 999, "2025-01-01T10:00:00Z")],
    ]
    schema = "route string, delay int, timestamp string"
    for batch in vehicles:
        encode_json(spark.createDataFrame(batch, schema)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    job = monitor_delays(stream, f"{tmp_path}/out", f"{tmp_path}/cp", watermark="2 hours", available_now=True)
    job.awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/out").select(
        F.date_format("start", "dd HH").alias("start"), "route", "positions", "mean_delay")
    assert rows(found) == [("01 10", "R1", 3, 20.0), ("01 10", "R2", 1, None), ("01 12", "R1", 1, 5.0)]
    assert job.lastProgress["stateOperators"][0]["numRowsTotal"] == 1  # the window still open


def test_late_rows_and_the_clock_of_the_test_tables(spark, tmp_path):
    events = testdata.event_rows(spark, "/root/testdata/sf0.001")
    stream = testdata.arriving_events(spark, "/root/testdata/sf0.001", f"{tmp_path}/events")
    assert stream.isStreaming and stream.columns == events.columns
    stored = spark.read.parquet(f"{tmp_path}/events")
    assert rows(stored.where("event_type <> 'clock'"), *events.columns) == rows(events)
    assert stored.select(F.input_file_name()).distinct().count() >= 4


def test_trips_of_a_group_are_settled_like_the_batch(spark, tmp_path):
    # More trips than groups, more alerts of a group than leave it in one row, all of it in one piece.
    items = spark.range(30_000).selectExpr(
        "CAST(id % 9000 AS STRING) AS trip_id", "id", "100000 + id % 7919 AS at", "CAST(id % 13 AS STRING) AS stop")
    stops = "array(struct(stop AS stop_id, at AS arrival_time, at AS departure_time), " \
            "struct('x' AS stop_id, at - id % 3 AS arrival_time, at AS departure_time))"
    trips = items.selectExpr("trip_id", f"{stops} AS stop_time_updates")
    seen = items.selectExpr("trip_id", "stop", "at + id % 1801 - 900 AS timestamp_seconds")
    clock = spark.createDataFrame([(None, None, 900_000)], SEEN)
    for name, frame in (("trips", trips), ("trips", trips.limit(0)), ("seen", seen), ("seen", clock)):
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    streams = [
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
        for name, schema in (("trips", TRIPS), ("seen", SEEN))
    ]
    alerts = trip_alert_stream(*streams, watermark="1 hour")
    job = _run(alerts, tmp_path, "alerts")
    stored = spark.read.schema(alerts.schema).parquet(f"{tmp_path}/alerts")
    expected = enrichment.trip_alerts(trips, seen)
    assert stored.count() == expected.count() > 30_000
    assert stored.exceptAll(expected).isEmpty()
    assert max(state["numRowsTotal"] for step in job.recentProgress for state in step["stateOperators"]) <= 256
    assert job.lastProgress["stateOperators"][0]["numRowsTotal"] == 0


def test_a_piece_of_several_files_is_taken_whole(spark, tmp_path):
    # One event an hour in no order, with one, five and four files a piece.
    events = spark.range(2_000).repartition(8).selectExpr(
        "id AS event_id", "timestamp_seconds(1700000000 + id * 3600) AS ts", "'seen' AS event_type")
    clock = {"ts": "2100-01-01 00:00:00", "event_type": "clock"}
    for pieces, options in ((4, {}), (4, {"file_rows": 100}), (10, {"piece_rows": 200, "file_rows": 60})):
        folder = f"{tmp_path}/{len(options)}"
        files = testdata.arriving(events, "ts", "event_id", clock, folder, **options)
        stream = testdata.arriving_stream(spark, folder, events, files)
        again = testdata.arriving_stream(spark, folder, stream)
        assert again._files == files == {0: 1, 1: 5, 2: 4}[len(options)]
        assert len(spark.read.parquet(folder).inputFiles()) == pieces * files + 1
        windows = stream.withWatermark("ts", "4 days").groupBy(F.window("ts", "1 hour")).count()
        _run(windows.select("count"), tmp_path, f"windows-{len(options)}")
        assert spark.read.parquet(f"{tmp_path}/windows-{len(options)}").agg(F.sum("count")).first()[0] == 2_000


def test_pieces_with_few_rows_have_as_many_files(spark, tmp_path):
    # Nearly all events come in the first piece.
    events = spark.range(1_000).selectExpr(
        "id AS event_id", "timestamp_seconds(1700000000 + if(id = 999, 8640000, id)) AS ts")
    folder = f"{tmp_path}/events"
    assert testdata.arriving(events, "ts", "event_id", {"ts": "2100-01-01 00:00:00"}, folder, file_rows=50) == 5
    assert len(spark.read.parquet(folder).inputFiles()) == 21
    assert spark.read.parquet(folder).where("event_id IS NOT NULL").count() == 1_000
