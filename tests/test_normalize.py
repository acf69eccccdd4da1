from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.functions.times import (
    clock_to_minutes,
    clock_to_seconds,
    clock_with_seconds,
    date_to_epoch,
    epoch_clock,
    epoch_date,
    moment_to_epoch,
    reformat_date,
)
from transitloom.operators.messages import encode_json, flatten_vehicle, parse_json, read_messages
from transitloom.operators.normalize import (
    normalize_trip_updates,
    normalize_vehicle,
    normalize_weather,
    rejected_vehicle,
)
from transitloom.schemas import RAW_TRIP_FEED, TRIP, VEHICLE, WEATHER

TOPIC = "/hfp/v2/journey/ongoing/vp/tram/0040"


def _vehicles(spark, *payloads, topic=TOPIC):
    return spark.createDataFrame([(topic, text) for text in payloads], "topic string, payload string")


@pytest.mark.parametrize(
    "payload",
    [
        "", "nonsense", "[1]", "null", "7", '{"VP":null}', '{"VP":5}', '{"VP":[1]}',
        '{"VP":{"veh":1,', '{"VP":{"spd":null}}', '{"VP":{"spd":"3"}}', '{"VP":{"acc":null}}',
        '{"VP":{"occu":[1]}}', '{"VP":{"veh":1}} rest', None,
    ],
)
def test_invalid_messages_go_to_the_reject_side(spark, payload):
    raw = _vehicles(spark, payload)
    assert normalize_vehicle(raw).count() == 0
    assert rows(rejected_vehicle(raw)) == [(TOPIC, payload)]


def test_message_without_envelope_is_kept_with_defaults(spark):
    row = normalize_vehicle(_vehicles(spark, "{}")).first()
    assert row.vehicle_id is None and row.destination == "unknown"
    assert (row.speed, row.location.speed, row.location.accuracy, row.occupancy) == (0, 0, 0, 0)


def test_normalised_vehicle_has_the_declared_shape(spark):
    schema = normalize_vehicle(_vehicles(spark, "{}")).schema
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        (f.name, f.dataType.simpleString()) for f in VEHICLE
    ]


def test_fields_are_renamed_clamped_and_typed(spark):
    payload = (
        '{"VP":{"veh":12,"oper":40,"route":"1004","dir":"2","oday":"2025-01-31","start":"23:59",'
        '"desi":"4","jrn":7,"line":30,"tst":"2025-01-31T21:59:59.1Z","tsi":1738360799,"dl":-60,'
        '"spd":-0.5,"lat":60.1,"long":24.9,"hdg":180,"acc":-1,"occu":-3,"stop":1020453,"odo":15.5,'
        '"loc":"GPS"}}'
    )
    row = normalize_vehicle(_vehicles(spark, payload)).first()
    assert row.asDict(recursive=True) == {
        "vehicle_id": 12, "vehicle_type": "tram", "operator": 40, "route": "1004", "direction": "2",
        "start_date": "2025-01-31", "start_time": "23:59", "destination": "4", "journey_id": 7,
        "line": 30, "timestamp": "2025-01-31T21:59:59.1Z", "timestamp_seconds": 1738360799,
        "delay": -60, "speed": 0.0,
        "location": {"latitude": 60.1, "longitude": 24.9, "speed": 0.0, "heading": 180, "accuracy": 0.0},
        "occupancy": 0, "stop": "1020453", "odometer": 15.5, "location_source": "GPS",
        "mqtt_topic": TOPIC,
    }


def test_explicit_null_destination_stays_null_and_mistyped_fields_become_null(spark):
    payload = '{"VP":{"veh":"7","line":1.5,"jrn":99999999999,"desi":null,"occu":1.5,"spd":true}}'
    row = normalize_vehicle(_vehicles(spark, payload)).first()
    assert row.destination is None
    assert (row.vehicle_id, row.line, row.journey_id, row.occupancy, row.speed) == (None,) * 5


@pytest.mark.parametrize(
    "topic, kind", [("/a/b", "unknown"), ("", "unknown"), (TOPIC, "tram"), ("/1/2/3/4/5/6", "6")]
)
def test_vehicle_type_comes_from_the_topic(spark, topic, kind):
    assert normalize_vehicle(_vehicles(spark, "{}", topic=topic)).first().vehicle_type == kind


def _feed(spark, *updates):
    entities = [(str(i), update) for i, update in enumerate(updates)]
    return spark.createDataFrame([(entities,)], RAW_TRIP_FEED)


def test_trip_updates(spark):
    stops = [("A", (100,), (110,)), ("B", None, (210,)), (None, (300,), None)]
    trips = normalize_trip_updates(
        _feed(
            spark,
            (("t1", "r1", "05:10:59", "20250131"), stops),
            None,
            (("t2", "r1", "25:10:00", "20250131"), []),
            (("t3", "r1", "", "20250131"), None),
            (("t4", "r1", "05:10:00", ""), None),
            (("t5", "r1", "05:10:00", None), None),
            ((None, None, "00:00:00", "20250101"), None),
        )
    )
    assert [f.dataType.simpleString() for f in trips.schema] == [
        f.dataType.simpleString() for f in TRIP
    ]
    found = {row.trip_id: row.asDict(recursive=True) for row in trips.collect()}
    assert set(found) == {"t1", "t2", ""}
    assert (found["t1"]["start_time"], found["t1"]["start_date"]) == ("05:10", "2025-01-31")
    assert found["t1"]["status"] is None
    assert [tuple(stop.values()) for stop in found["t1"]["stop_time_updates"]] == [
        ("A", 100, 110), ("B", 0, 210), ("", 300, 0)
    ]
    assert found["t2"]["start_time"] == "25:10" and found["t2"]["stop_time_updates"] == []
    assert found[""]["stop_time_updates"] == []


def test_weather(spark):
    full = (
        '{"dt":1738360799,"main":{"temp":-3.5,"humidity":80,"pressure":1001},"wind":{"speed":4.1},'
        '"clouds":{"all":75},%s"weather":[{"main":"Snow","description":"light snow"},{"main":"Mist"}]}'
    )
    broken = ['{"dt":1}', full.replace("[", "[]; ["), full % '"visibility":1,' + "x"]
    documents = [full % "", full % '"visibility":9000,', full % '"visibility":null,', *broken[:2]]
    raw = spark.createDataFrame([(text,) for text in documents], "payload string")
    found = normalize_weather(raw, 60.0, 25.0)
    assert found.columns == WEATHER.names
    expected = (60.0, 25.0, -3.5, 80, 4.1, 75, 1001, "Snow", "light snow", "2025-01-31", "21:59")
    plain = found.select(*[name for name in WEATHER.names if name != "visibility"])
    assert rows(plain) == [expected] * 3
    assert {row.visibility for row in found.collect()} == {"N/A", "9000", None}


def test_dates_and_clock_times(spark):
    texts = ["08:30", "08:30:59", "5:03:00", "25:10:00", "", "8", "08:60", "soon", None]
    frame = spark.createDataFrame([(text,) for text in texts], "t string")
    found = frame.select(
        "t", clock_to_minutes("t").alias("m"), clock_with_seconds("t").alias("w"),
        clock_to_seconds("t").alias("s"),
    ).collect()
    assert [(row.m, row.w, row.s) for row in found] == [
        ("08:30", "08:30:00", 30600), ("08:30", "08:30:00", 30659), ("05:03", "05:03:00", 18180),
        ("25:10", "25:10:00", 90600), *[(None, None, None)] * 5,
    ]
    dates = spark.createDataFrame([("20240229",), ("20230229",), ("",), ("x",), (None,)], "d string")
    found = dates.select(reformat_date("d", "yyyyMMdd", "yyyy-MM-dd").alias("d")).collect()
    assert [row.d for row in found] == ["2024-02-29", None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epochs_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = int(datetime(2025, 3, 9, 2, 30, tzinfo=timezone.utc).timestamp())
        frame = spark.createDataFrame([(moment, "2025-03-09", "2025-03-09T02:30:00Z")],
                                      "s long, d string, iso string")
        found = frame.select(
            epoch_date(F.col("s")).alias("date"), epoch_clock(F.col("s")).alias("time"),
            date_to_epoch("d").alias("day"), moment_to_epoch(frame, "iso").alias("iso"),
        ).first()
        assert tuple(found) == ("2025-03-09", "02:30", moment - 9000, moment)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_messages_survive_encoding_and_parsing(spark):
    payload = '{"VP":{"veh":1,"route":"ä","spd":2.5,"oday":"2025-01-31","start":"08:30"}}'
    vehicles = normalize_vehicle(_vehicles(spark, payload))
    records = encode_json(vehicles)
    assert '"direction":null' in records.select(F.col("value").cast("string")).first()[0]
    again = read_messages(records, VEHICLE)
    assert rows(again) == rows(vehicles)
    flat = flatten_vehicle(again)
    assert len(flat.columns) == 25
    row = flat.first()
    assert (row.start_time, row.start_date, row.vehicle_speed) == ("08:30:00", "20250131", 2.5)


def test_parsing_is_permissive_and_can_be_narrowed(spark):
    frame = spark.createDataFrame([("broken",), ('{"vehicle_id":1,"route":2}',), ("",)], "message string")
    assert sorted(map(repr, parse_json(frame, VEHICLE, columns=["vehicle_id", "route"]).collect())) == [
        "Row(vehicle_id=1, route='2')",
        "Row(vehicle_id=None, route=None)",
        "Row(vehicle_id=None, route=None)",
    ]


@pytest.mark.parametrize("after", ["\n", "\r\n", "\t", " \n ", ""])
@pytest.mark.parametrize("document", ['{"VP":{"veh":3}}', "{}", '{"VP":{"veh":3,"desi":"{x}}"},"a":{"b":[]}}'])
def test_white_space_may_stand_around_a_document(spark, document, after):
    raw = _vehicles(spark, after + document + after)
    assert normalize_vehicle(raw).count() == 1 and rejected_vehicle(raw).count() == 0


@pytest.mark.parametrize("behind", ['{"VP":{}}', " x}", ",{}", "]", "}", ',"x"]', "\x0b"])
def test_nothing_else_may_stand_behind_it(spark, behind):
    raw = _vehicles(spark, '{"VP":{"veh":3}}' + behind, "{}" + behind)
    assert normalize_vehicle(raw).count() == 0 and rejected_vehicle(raw).count() == 2
