"""Declared schemas of raw messages, normalised tables and prediction tables.

Nothing in this library infers a schema: inference would read the data twice and
turn clock times such as ``08:30`` into timestamps of the current day.

Fixed values, all of them: names and types are those of the messages, tables and files that
are read and written.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

_TEXT, _INT, _LONG, _DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# --- raw messages -----------------------------------------------------------------
# The fields of the vehicle envelope. VARIANT keeps an absent key (NULL) apart from
# an explicit JSON null, and keeps the JSON type of the value.
RAW_VEHICLE_ENVELOPE = _struct(
    VP=_struct(
        veh=_INT, oper=_INT, route=_TEXT, dir=_TEXT, oday=_TEXT, start=_TEXT,
        desi=VariantType(), jrn=_INT, line=_INT, tst=_TEXT, tsi=_LONG, dl=_INT,
        spd=VariantType(), lat=_DOUBLE, long=_DOUBLE, hdg=_INT, acc=VariantType(),
        occu=VariantType(), stop=_TEXT, odo=_DOUBLE, loc=_TEXT,
    )
)

# A decoded trip-update feed: one row per poll, entities of any kind in an array.
RAW_TRIP_FEED = _struct(
    entity=ArrayType(
        _struct(
            id=_TEXT,
            trip_update=_struct(
                trip=_struct(trip_id=_TEXT, route_id=_TEXT, start_time=_TEXT, start_date=_TEXT),
                stop_time_update=ArrayType(
                    _struct(
                        stop_id=_TEXT, arrival=_struct(time=_LONG), departure=_struct(time=_LONG)
                    )
                ),
            ),
        )
    )
)

RAW_WEATHER = _struct(
    dt=_LONG,
    main=_struct(temp=_DOUBLE, humidity=_INT, pressure=_INT),
    wind=_struct(speed=_DOUBLE),
    clouds=_struct(all=_INT),
    visibility=VariantType(),
    weather=ArrayType(_struct(main=_TEXT, description=_TEXT)),
)

# --- normalised messages ------------------------------------------------------------
TRIP = _struct(
    trip_id=_TEXT, route_id=_TEXT, start_time=_TEXT, start_date=_TEXT, status=_TEXT,
    stop_time_updates=ArrayType(
        _struct(stop_id=_TEXT, arrival_time=_LONG, departure_time=_LONG)
    ),
)

VEHICLE = _struct(
    vehicle_id=_INT, vehicle_type=_TEXT, operator=_INT, route=_TEXT, direction=_TEXT,
    start_date=_TEXT, start_time=_TEXT, destination=_TEXT, journey_id=_INT, line=_INT,
    timestamp=_TEXT, timestamp_seconds=_LONG, delay=_INT, speed=_DOUBLE,
    location=_struct(
        latitude=_DOUBLE, longitude=_DOUBLE, speed=_DOUBLE, heading=_INT, accuracy=_DOUBLE
    ),
    occupancy=_INT, stop=_TEXT, odometer=_DOUBLE, location_source=_TEXT, mqtt_topic=_TEXT,
)

WEATHER = _struct(
    latitude=_DOUBLE, longitude=_DOUBLE, temperature=_DOUBLE, humidity=_INT, wind_speed=_DOUBLE,
    cloud_coverage=_INT, pressure=_INT, visibility=_TEXT, weather_main=_TEXT,
    weather_description=_TEXT, date=_TEXT, time=_TEXT,
)

# --- stored tables ------------------------------------------------------------------
TRANSPORT_DATA = _struct(
    trip_id=_TEXT, route_id=_TEXT, start_time=_TEXT, start_date=_TEXT, status=_TEXT,
    total_stops=_INT, vehicle_id=_INT, vehicle_type=_TEXT, operator=_INT, direction=_TEXT,
    journey_id=_INT, line=_INT, speed=_DOUBLE, occupancy=_INT, delay=_INT,
    vehicle_latitude=_DOUBLE, vehicle_longitude=_DOUBLE, timestamp=_TEXT,
    timestamp_seconds=_LONG, stop=_TEXT, odometer=_DOUBLE, location_source=_TEXT,
    processed_time=TimestampType(),
)

PREDICTIONS = _struct(
    total_stops=_INT, vehicle_id=_INT, journey_id=_INT, speed=_DOUBLE, occupancy=_INT,
    vehicle_latitude=_DOUBLE, vehicle_longitude=_DOUBLE, timestamp_seconds=_LONG, stop=_INT,
    odometer=_DOUBLE, hour=_INT, day_of_week=_INT, is_weekend=_INT, vehicle_type_index=_INT,
    route_id_index=_INT, location_source_index=_INT, operator_index=_INT, direction_index=_INT,
    line_index=_INT, timestamp_numeric=_LONG, start_time_numeric=_LONG,
    start_date_numeric=_LONG, predicted_delay=_DOUBLE,
)

# --- graph files --------------------------------------------------------------------
VEHICLE_NODES = _struct(
    vehicle_id=_INT, vehicle_type=_TEXT, operator=_INT, line=_INT, speed=_DOUBLE, occupancy=_INT
)
TRIP_NODES = _struct(
    trip_id=_TEXT, route_id=_TEXT, start_time=_TEXT, start_date=_TEXT, direction=_TEXT,
    total_stops=_INT,
)
STOP_NODES = _struct(stop=_TEXT, vehicle_latitude=_DOUBLE, vehicle_longitude=_DOUBLE)
VEHICLE_TRIP_EDGES = _struct(vehicle_id=_INT, trip_id=_TEXT)
TRIP_STOP_EDGES = _struct(trip_id=_TEXT, stop=_TEXT)
STOP_PRECEDE_EDGES = _struct(stop1=_TEXT, stop2=_TEXT)
