import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators.enrichment import windowed_delay
from transitloom.operators.messages import encode_json, read_messages
from transitloom.operators import trip_join
from transitloom.operators.trip_join import (
    distinct_trips,
    join_trip_vehicle_streams,
    join_trips_vehicles,
)
from transitloom.plans import testdata
from transitloom.schemas import TRIP, VEHICLE
from transitloom.sources.topics import topic_options
from transitloom.streaming import sinks
from transitloom.streaming.jobs import ingest_topics, store_joined_facts, store_positions

SF = "/root/testdata/sf0.001"


@pytest.fixture
def topics(spark, tmp_path):
    """Two topics as folders of several files each, and readers over them."""
    events = testdata.event_rows(spark, SF)
    batches = {"trip": testdata.trip_rows(events), "vehicle": testdata.vehicle_rows(events)}
    for name, frame in batches.items():
        encode_json(frame).repartition(4).write.parquet(f"{tmp_path}/{name}")

    def stream(name):
        reader = spark.readStream.schema("value binary").option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{tmp_path}/{name}")

    return batches, stream


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_join_equals_batch_join(spark, topics, tmp_path, salts):
    batches, stream = topics
    path = f"{tmp_path}/joined"
    job = store_joined_facts(
        stream("trip"), stream("vehicle"), [sinks.table_writer(path)], f"{tmp_path}/cp",
        watermark=None, available_now=True, salts=salts,
    )
    job.awaitTermination()
    expected = join_trips_vehicles(batches["trip"], batches["vehicle"]).drop("processed_time")
    assert rows(spark.read.parquet(path), *expected.columns) == rows(expected)


def test_trips_of_a_start_are_kept_as_one_row(spark, tmp_path):
    events = testdata.event_rows(spark, SF).withColumn("ts", F.date_trunc("month", "ts"))
    trips, vehicles = testdata.trip_rows(events), testdata.vehicle_rows(events)
    for name, frame in (("trip", trips), ("vehicle", vehicles)):
        encode_json(frame).coalesce(1).write.parquet(f"{tmp_path}/{name}")
    streams = [
        spark.readStream.schema("value binary").parquet(f"{tmp_path}/{name}") for name in ("trip", "vehicle")
    ]
    kept = []

    def write(batch, epoch_id):
        kept.append(batch.storageLevel)
        sinks.table_writer(f"{tmp_path}/out")(batch, epoch_id)

    job = store_joined_facts(*streams, [write], f"{tmp_path}/cp", None, available_now=True, salts=1)
    job.awaitTermination()
    # The join's state holds all vehicles, and the starts of the trips but not every trip.
    state = next(
        s for s in job.recentProgress[0]["stateOperators"] if s["operatorName"] == "symmetricHashJoin"
    )
    starts = trips.select("route_id", "start_date", "start_time").distinct().count()
    assert 2 * starts < trips.count()
    assert vehicles.count() < state["numRowsTotal"] <= vehicles.count() + 2 * starts
    # One sink gets the rows as they come.
    assert kept and not any(level.useMemory or level.useDisk for level in kept)
    expected = join_trips_vehicles(trips, vehicles).drop("processed_time")
    assert rows(spark.read.parquet(f"{tmp_path}/out"), *expected.columns) == rows(expected)


def test_stream_join_with_watermark_keeps_close_pairs(spark, topics, tmp_path):
    batches, stream = topics
    joined = join_trip_vehicle_streams(
        read_messages(stream("trip"), TRIP), read_messages(stream("vehicle"), VEHICLE),
        watermark="400 days", max_gap="30 MINUTES",
    )
    job = sinks.start_files(joined, f"{tmp_path}/out", f"{tmp_path}/cp", "close", available_now=True)
    job.awaitTermination()
    whole = join_trips_vehicles(batches["trip"], batches["vehicle"])
    started = F.to_timestamp(F.concat_ws(" ", "start_date", "start_time"))
    gap = F.abs(F.unix_seconds(F.to_timestamp("timestamp")) - F.unix_seconds(started))
    expected = whole.where(gap <= 1800).drop("processed_time")
    found = spark.read.parquet(f"{tmp_path}/out")
    assert expected.count() > 0
    assert rows(found, *expected.columns) == rows(expected)


def test_trips_start_in_their_zone(spark):
    trip = [("2024-01-05", "25:30")]
    starts = spark.createDataFrame(trip, "start_date string, start_time string")
    found = starts.select(
        *[F.unix_seconds(trip_join._trip_time(zone)) for zone in ("UTC", "Europe/Helsinki")]
    ).first()
    assert found[0] == 1704504600 and found[1] == found[0] - 7200


def test_ingest_resumes_without_repeating(spark, topics, tmp_path):
    batches, stream = topics
    for _ in range(2):
        jobs = ingest_topics({"vehicle": stream("vehicle")}, f"{tmp_path}/raw", available_now=True)
        jobs["vehicle"].awaitTermination()
    stored = spark.read.parquet(f"{tmp_path}/raw/vehicle")
    assert rows(stored, "journey_id") == rows(batches["vehicle"], "journey_id")


def test_fan_out_writes_every_sink_and_replay_changes_nothing(spark, topics, tmp_path):
    batches, stream = topics
    table, counts = f"{tmp_path}/rows", f"{tmp_path}/counts"
    writers = [sinks.table_writer(table), sinks.count_writer(counts, ["vehicle_type"])]
    store_positions(stream("vehicle"), writers, f"{tmp_path}/cp", available_now=True).awaitTermination()
    stored = spark.read.parquet(table)
    assert stored.count() == batches["vehicle"].count()
    assert spark.read.parquet(counts).agg(F.sum("row_count")).first()[0] == stored.count()
    epoch = stored.where("epoch_id = 1").drop("epoch_id")
    kept = [tuple(row) for row in epoch.collect()]
    replayed = spark.createDataFrame(kept, epoch.schema)
    sinks.table_writer(table)(replayed, 1)
    assert spark.read.parquet(table).count() == batches["vehicle"].count()


def test_console_sink_and_waiting(spark, topics, tmp_path):
    _, stream = topics
    vehicles = read_messages(stream("vehicle"), VEHICLE, ["vehicle_id"])
    job = sinks.start_console(vehicles, f"{tmp_path}/cp", available_now=True)
    sinks.wait_for_any(spark, 60)
    job.awaitTermination()
    assert job.exception() is None
    spark.streams.resetTerminated()


def test_windowed_delay_streams(spark, topics, tmp_path):
    batches, stream = topics
    positions = read_messages(stream("vehicle"), VEHICLE).withColumn("at", F.to_timestamp("timestamp"))
    delays = windowed_delay(positions, "at", "1 hour", watermark="400 days")
    job = (
        delays.writeStream.format("memory").queryName("delays").outputMode("complete")
        .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    )
    job.awaitTermination()
    batch = batches["vehicle"].withColumn("at", F.to_timestamp("timestamp"))
    assert rows(spark.table("delays")) == rows(windowed_delay(batch, "at", "1 hour"))


def test_repeated_trips_are_kept_once(spark, topics, tmp_path):
    batches, stream = topics
    polled = read_messages(stream("trip"), TRIP)
    once = distinct_trips(polled.unionByName(polled), watermark="400 days")
    job = sinks.start_files(once, f"{tmp_path}/out", f"{tmp_path}/cp", available_now=True)
    job.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out"), *TRIP.names) == rows(batches["trip"], *TRIP.names)


def test_topic_options():
    assert topic_options("broker:9092", "weather") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "weather", "startingOffsets": "latest"}
    more = topic_options("b:1", "t", "earliest", max_offsets_per_trigger=100, min_partitions=8)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"], more["minPartitions"]) == (
        "earliest", "100", "8")
