"""Raw feed messages to normalised rows. Each function works on batches and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from transitloom.functions.times import (
    clock_to_minutes,
    epoch_clock,
    epoch_date,
    reformat_date,
)
from transitloom.functions.values import clamp_non_negative, once, topic_segment
from transitloom.schemas import RAW_VEHICLE_ENVELOPE, RAW_WEATHER

_CORRUPT = "_corrupt"
_CLAMPED = ("spd", "acc", "occu")


def _with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(_CORRUPT, StringType())])


def _kind(variant) -> Column:
    """First letters of a variant's JSON type: BIG(INT), DEC(IMAL), DOU(BLE), STR(ING), ..."""
    return F.left(F.schema_of_variant(variant), F.lit(3))


def _is_numeric(kind) -> Column:
    return kind.isin("BIG", "DEC", "DOU", "FLO")


def _clamped_double(variant, kind) -> Column:
    number = F.try_variant_get(variant, "$", "double")
    return F.when(kind.isNull() | _is_numeric(kind), clamp_non_negative(number)).cast("double")


def _clamped_int(variant, kind) -> Column:
    """Like the double, but a fraction or an overflow has no int value."""
    number = F.try_variant_get(variant, "$", "double")
    whole = F.when(kind == "BIG", F.try_variant_get(variant, "$", "int"))
    return (
        F.when(kind.isNull() | (_is_numeric(kind) & (number <= 0)), F.lit(0))
        .otherwise(whole)
        .cast("int")
    )


def parse_vehicle(raw: DataFrame, topic: str = "topic", payload: str = "payload") -> DataFrame:
    """Parse raw vehicle messages and say which are valid.

    Adds ``vp`` (the envelope's fields), ``kinds`` (JSON types of the clamped fields)
    and ``valid``. A message is rejected when the payload is not a JSON object, when
    ``VP`` is there but is not an object, or when a clamped field is there but cannot
    be compared with a number. A payload without ``VP`` is valid and yields an all-NULL
    message.
    """
    parsed = raw.select(
        F.col(topic).alias("topic"),
        F.col(payload).alias("payload"),
        once(
            F.from_json(
                payload,
                _with_corrupt(RAW_VEHICLE_ENVELOPE),
                {"columnNameOfCorruptRecord": _CORRUPT},
            )
        ).alias("message"),
    )
    vp = F.col("message.VP")
    clean = vp.isNotNull() & F.col(f"message.{_CORRUPT}").isNull()
    # One object that holds one object at most, and nothing but JSON white space around it:
    # what the typed parse has read is the whole text. Other texts are parsed again, as the
    # first of two elements: the second shows that the document was read to its end, and no
    # text can hold its own digest to feign that.
    plain = F.col("payload").rlike(r"^[ \t\r\n]*\{[^{}]*\{[^{}]*\}[^{}]*\}[ \t\r\n]*$")
    clean = clean & plain
    digest = F.md5(F.col("payload").cast("binary"))
    whole = F.concat(F.lit("["), "payload", F.lit(',"'), digest, F.lit('"]'))
    framed = F.try_parse_json(F.when(~clean, whole))
    ended = F.try_variant_get(framed, "$[1]", "string") == digest
    look = F.struct(
        F.when(ended, F.try_variant_get(framed, "$[0]", "variant")).alias("document"),
        F.struct(*[_kind(vp[name]).alias(name) for name in _CLAMPED]).alias("kinds"),
    )
    looked = parsed.select(
        "topic", "payload", vp.alias("vp"), clean.alias("clean"), once(look).alias("look")
    ).select("topic", "payload", "vp", "clean", "look.document", "look.kinds")

    envelope = F.try_variant_get("document", "$.VP", "variant")
    well_formed = F.col("clean") | (
        (_kind(F.col("document")) == "OBJ") & (envelope.isNull() | (_kind(envelope) == "OBJ"))
    )
    # Absent, a number or a boolean: comparing anything else with 0 is an error.
    clampable = F.lit(True)
    for name in _CLAMPED:
        kind = F.col(f"kinds.{name}")
        clampable = clampable & (kind.isNull() | _is_numeric(kind) | (kind == "BOO"))
    return looked.select(
        "topic",
        "payload",
        "vp",
        "kinds",
        F.coalesce(well_formed & clampable, F.lit(False)).alias("valid"),
    )


def vehicle_columns() -> list[Column]:
    """The vehicle schema's columns from what ``parse_vehicle`` adds."""
    vp = {name: F.col(f"vp.{name}") for name in RAW_VEHICLE_ENVELOPE["VP"].dataType.names}
    kind = {name: F.col(f"kinds.{name}") for name in _CLAMPED}
    speed = _clamped_double(vp["spd"], kind["spd"])
    # Absent destination gets the default, an explicit null stays null.
    destination = F.when(vp["desi"].isNull(), F.lit("unknown")).otherwise(
        F.try_variant_get(vp["desi"], "$", "string")
    )
    return [
        vp["veh"].alias("vehicle_id"),
        topic_segment("topic").alias("vehicle_type"),
        vp["oper"].alias("operator"),
        vp["route"].alias("route"),
        vp["dir"].alias("direction"),
        vp["oday"].alias("start_date"),
        vp["start"].alias("start_time"),
        destination.alias("destination"),
        vp["jrn"].alias("journey_id"),
        vp["line"].alias("line"),
        vp["tst"].alias("timestamp"),
        vp["tsi"].alias("timestamp_seconds"),
        vp["dl"].alias("delay"),
        speed.alias("speed"),
        F.struct(
            vp["lat"].alias("latitude"),
            vp["long"].alias("longitude"),
            speed.alias("speed"),
            vp["hdg"].alias("heading"),
            _clamped_double(vp["acc"], kind["acc"]).alias("accuracy"),
        ).alias("location"),
        _clamped_int(vp["occu"], kind["occu"]).alias("occupancy"),
        vp["stop"].alias("stop"),
        vp["odo"].alias("odometer"),
        vp["loc"].alias("location_source"),
        F.col("topic").alias("mqtt_topic"),
    ]


def normalize_vehicle(raw: DataFrame, topic: str = "topic", payload: str = "payload") -> DataFrame:
    """Valid raw vehicle messages as rows of the vehicle schema."""
    return parse_vehicle(raw, topic, payload).where("valid").select(*vehicle_columns())


def rejected_vehicle(raw: DataFrame, topic: str = "topic", payload: str = "payload") -> DataFrame:
    """The messages ``normalize_vehicle`` leaves out, as received."""
    return parse_vehicle(raw, topic, payload).where(~F.col("valid")).select("topic", "payload")


def explode_entities(feed: DataFrame) -> DataFrame:
    """One row per feed entity that carries a trip update."""
    return (
        feed.select(F.explode("entity").alias("entity"))
        .where("entity.trip_update IS NOT NULL")
        .select("entity.trip_update.*")
    )


def stop_times(updates) -> Column:
    """Stop-time updates as ``{stop_id, arrival_time, departure_time}``; a missing time is 0."""
    return F.transform(
        updates,
        lambda update: F.struct(
            F.coalesce(update["stop_id"], F.lit("")).alias("stop_id"),
            F.coalesce(update["arrival"]["time"], F.lit(0)).cast("bigint").alias("arrival_time"),
            F.coalesce(update["departure"]["time"], F.lit(0)).cast("bigint").alias("departure_time"),
        ),
    )


def normalize_trip_updates(feed: DataFrame) -> DataFrame:
    """Feed polls as rows of the trip schema; trips without a usable start are dropped."""
    return (
        explode_entities(feed)
        .select(
            F.coalesce("trip.trip_id", F.lit("")).alias("trip_id"),
            F.coalesce("trip.route_id", F.lit("")).alias("route_id"),
            clock_to_minutes(F.col("trip.start_time")).alias("start_time"),
            reformat_date(F.col("trip.start_date"), "yyyyMMdd", "yyyy-MM-dd").alias("start_date"),
            F.lit(None).cast("string").alias("status"),
            # A repeated field without entries is an empty list, not a missing one.
            F.coalesce(stop_times(F.col("stop_time_update")), F.array()).alias("stop_time_updates"),
        )
        .where("start_date IS NOT NULL AND start_time IS NOT NULL")
    )


def normalize_weather(
    raw: DataFrame, latitude: float, longitude: float, payload: str = "payload"
) -> DataFrame:
    """Weather documents polled for one coordinate as flat rows of the weather schema.

    A document without its time, main, wind or clouds block, or without any weather
    entry, is left out.
    """
    document = raw.select(once(F.from_json(payload, RAW_WEATHER)).alias("w")).select("w.*")
    first = F.get("weather", F.lit(0))
    visibility = F.when(F.col("visibility").isNull(), F.lit("N/A")).otherwise(
        F.try_variant_get("visibility", "$", "string")
    )
    return document.where(
        F.col("dt").isNotNull()
        & F.col("main").isNotNull()
        & F.col("wind").isNotNull()
        & F.col("clouds").isNotNull()
        & first.isNotNull()
    ).select(
        F.lit(latitude).cast("double").alias("latitude"),
        F.lit(longitude).cast("double").alias("longitude"),
        F.col("main.temp").alias("temperature"),
        F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
        F.col("clouds.all").alias("cloud_coverage"),
        F.col("main.pressure").alias("pressure"),
        visibility.alias("visibility"),
        first["main"].alias("weather_main"),
        first["description"].alias("weather_description"),
        epoch_date(F.col("dt")).alias("date"),
        epoch_clock(F.col("dt")).alias("time"),
    )
