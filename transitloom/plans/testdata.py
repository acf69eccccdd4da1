"""Transport-shaped frames over the supplied star-schema tables.

``events`` stands for vehicle positions and trip starts, ``orders`` for trip feeds,
``lineitem`` for stored facts of the graph. The edge cases the operators must cope
with are dealt out by a digit of a column, so every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.functions.times import moment_to_epoch
from transitloom.operators.messages import encode_json

LATITUDE, LONGITUDE = 60.17, 24.94
TOPIC = "/hfp/v2/journey/ongoing/vp/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_base(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their number ``k`` (0 to 99)."""
    return _event_base(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a stream."""
    schema = table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return _event_base(reader.parquet(sf_dir))


def _start_columns():
    return [
        F.concat(F.lit("R"), (F.col("k") % 20).cast("string")).alias("route"),
        F.date_format("ts", "yyyy-MM-dd").alias("start_date"),
        F.date_format("ts", "HH:00").alias("start_time"),
    ]


def vehicle_rows(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Positions: every event that is not a signup (or all), in the vehicle schema."""
    if not whole:
        rows = rows.where("event_type <> 'signup'")
    k = F.col("k")
    route, start_date, start_time = _start_columns()
    return rows.select(
        F.col("user_id").cast("int").alias("vehicle_id"),
        F.col("event_type").alias("vehicle_type"),
        (k % 5).alias("operator"),
        route,
        (k % 2 + 1).cast("string").alias("direction"),
        start_date,
        start_time,
        F.concat(F.lit("D"), (k % 7).cast("string")).alias("destination"),
        F.col("event_id").cast("int").alias("journey_id"),
        k.alias("line"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        moment_to_epoch(rows, "ts").alias("timestamp_seconds"),
        (F.floor("value").cast("int") - 50).alias("delay"),
        F.col("value").alias("speed"),
        F.struct(
            (60 + k.cast("double") / 100).alias("latitude"),
            (24 + (F.col("user_id") % 100).cast("double") / 100).alias("longitude"),
            F.col("value").alias("speed"),
            (k * 3).alias("heading"),
            (k.cast("double") / 4).alias("accuracy"),
        ).alias("location"),
        F.when(k % 10 != 0, k).alias("occupancy"),
        (k % 50).cast("string").alias("stop"),
        (F.col("value") * 8).alias("odometer"),
        F.when(k % 2 == 0, F.lit("GPS")).otherwise(F.lit("ODO")).alias("location_source"),
        F.concat(F.lit(TOPIC), F.col("event_type"), F.lit("/"), k.cast("string")).alias("mqtt_topic"),
    )


def trip_rows(rows: DataFrame, whole: bool = False) -> DataFrame:
    """Trips: every signup (or event), in the trip schema, with 0 to 7 stops or none given."""
    if not whole:
        rows = rows.where("event_type = 'signup'")
    k = F.col("k")
    route, start_date, start_time = _start_columns()
    epoch = moment_to_epoch(rows, "ts")
    stops = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(8)), F.lit(1), k % 8),
        lambda i: F.struct(
            (k + i).cast("string").alias("stop_id"),
            (epoch + i * 60).alias("arrival_time"),
            (epoch + i * 60 + 20).alias("departure_time"),
        ),
    )
    return rows.select(
        F.col("event_id").cast("string").alias("trip_id"),
        route.alias("route_id"),
        start_time,
        start_date,
        F.lit(None).cast("string").alias("status"),
        F.when(k % 10 != 9, stops).alias("stop_time_updates"),
    )


def weather_rows(rows: DataFrame) -> DataFrame:
    """Weather reports: every signup, in the weather schema."""
    k = F.col("k")
    return rows.where("event_type = 'signup'").select(
        F.lit(LATITUDE).alias("latitude"),
        F.lit(LONGITUDE).alias("longitude"),
        F.col("value").alias("temperature"),
        k.alias("humidity"),
        (k.cast("double") / 8).alias("wind_speed"),
        (k % 9).alias("cloud_coverage"),
        (1000 + k).alias("pressure"),
        F.lit("N/A").alias("visibility"),
        F.lit("Clouds").alias("weather_main"),
        F.concat(F.lit("type "), F.col("event_type")).alias("weather_description"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.date_format("ts", "HH:mm").alias("time"),
    )


def records(normalised: DataFrame, key: str, topic: str) -> DataFrame:
    """Rows as the topic records a broker would hand out."""
    value = encode_json(normalised)
    return value.select(
        F.lit(key).cast("binary").alias("key"), "value", F.lit(topic).alias("topic")
    )


def raw_vehicle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw envelopes of all events, most of them odd in one of the ways a feed can be."""
    return raw_vehicle_messages_of(event_rows(spark, sf_dir))


def raw_vehicle_messages_of(rows: DataFrame) -> DataFrame:
    """The same from event rows, which may be a stream."""
    k, value = F.col("k"), F.col("value").cast("string")
    text = k.cast("string")

    def envelope(*members):
        return F.concat(F.lit('{"VP":{"veh":'), F.col("user_id").cast("string"),
                        F.lit(',"route":"R'), text, F.lit('"'), *members, F.lit("}}"))

    speed = F.concat(F.lit(',"spd":'), value)
    named = F.lit(',"desi":"centre"')
    payloads = [
        envelope(speed, named, F.lit(',"occu":'), text, F.lit(',"acc":-1.5')),
        envelope(speed, F.lit(',"desi":null,"stop":'), text),
        envelope(named, F.lit(',"lat":60.5,"long":24.5,"dl":-30')),
        envelope(F.lit(',"spd":null'), named),
        envelope(F.concat(F.lit(',"spd":-'), value), named, F.lit(',"oper":"12"')),
        F.concat(F.lit('{"VP":{"veh":'), text),
        F.lit("{}"),
        F.lit('{"VP":null}'),
        envelope(F.lit(',"spd":"'), value, F.lit('"')),
        F.lit(""),
    ]
    # Every other round of numbers adds what may, and what may not, stand around a document.
    around = [
        F.concat(payloads[0], F.lit("\n")),
        F.concat(payloads[1], F.lit("\r\n")),
        F.concat(F.lit(" \n"), payloads[2], F.lit("\t")),
        F.concat(payloads[3], payloads[3]),
        F.concat(payloads[4], F.lit(" x}")),
        F.concat(payloads[0], F.lit(",{}")),
    ]
    payload = F.get(F.array(*payloads, *around), F.when(k % 20 < 10, k % 10).otherwise(10 + k % 6))
    topic = F.when(k % 4 == 3, F.lit("/hfp/v2")).otherwise(
        F.concat(F.lit(TOPIC), F.col("event_type"), F.lit("/"), text)
    )
    return rows.select("event_id", topic.alias("topic"), payload.alias("payload"))


def raw_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather documents of all events, some of them incomplete."""
    rows = event_rows(spark, sf_dir)
    k = F.col("k")
    text = k.cast("string")
    main = F.when(k % 10 == 3, F.lit("")).otherwise(
        F.concat(F.lit('"main":{"temp":'), F.col("value").cast("string"), F.lit(',"humidity":'),
                 text, F.lit(',"pressure":'), (1000 + k).cast("string"), F.lit("},"))
    )
    visibility = (
        F.when(k % 10 == 0, F.lit(""))
        .when(k % 10 == 1, F.lit('"visibility":null,'))
        .otherwise(F.concat(F.lit('"visibility":'), (k * 100).cast("string"), F.lit(",")))
    )
    entries = F.when(k % 10 == 2, F.lit("[]")).otherwise(
        F.concat(F.lit('[{"main":"'), F.col("event_type"), F.lit('","description":"kind '), text,
                 F.lit('"},{"main":"second","description":"second"}]'))
    )
    document = F.concat(
        F.lit('{"dt":'), moment_to_epoch(rows, "ts").cast("string"), F.lit(","), main,
        F.lit('"wind":{"speed":'), F.col("value").cast("string"), F.lit('},"clouds":{"all":'), text,
        F.lit("},"), visibility, F.lit('"weather":'), entries,
        F.when(k % 10 == 4, F.lit("")).otherwise(F.lit("}")),
    )
    return rows.select("event_id", document.alias("payload"))


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed poll per order: an entity with a trip update and one without."""
    orders = table(spark, sf_dir, "orders")
    key, digit = F.col("o_orderkey"), F.col("o_orderkey") % 10
    epoch = moment_to_epoch(orders, "o_orderdate")
    start_date = (
        F.when(digit == 1, F.lit(""))
        .when(digit == 2, F.lit("20240230"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    start_time = (
        F.when(digit == 3, F.lit(""))
        .when(digit == 4, F.lit("soon"))
        .otherwise(
            F.concat(
                F.lpad((key % 30).cast("string"), 2, "0"), F.lit(":"),
                F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"), F.lit(":07"),
            )
        )
    )
    updates = F.transform(
        F.slice(F.sequence(F.lit(1), F.lit(7)), F.lit(1), (key % 7 + 1).cast("int")),
        lambda i: F.struct(
            (F.col("o_custkey") % 500 + i).cast("string").alias("stop_id"),
            F.struct(F.when(i != 5, epoch + i * 600).alias("time")).alias("arrival"),
            F.struct((epoch + i * 600 + 30).alias("time")).alias("departure"),
        ),
    )
    none = F.slice(updates, 1, 0)
    update = F.struct(
        F.struct(
            key.cast("string").alias("trip_id"),
            F.concat(F.lit("R"), (key % 20).cast("string")).alias("route_id"),
            start_time.alias("start_time"),
            start_date.alias("start_date"),
        ).alias("trip"),
        F.when(digit == 5, F.lit(None)).when(digit == 6, none).otherwise(updates).alias("stop_time_update"),
    )
    entity = F.struct(key.cast("string").alias("id"), update.alias("trip_update"))
    alert = F.struct(F.lit("alert").alias("id"), F.when(F.lit(False), update).alias("trip_update"))
    return orders.select(F.array(entity, alert).alias("entity"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts for the delay model: all events, with gaps in label and features."""
    rows = event_rows(spark, sf_dir)
    k = F.col("k")
    route, start_date, start_time = _start_columns()
    delay = F.floor("value").cast("double") - 50
    return rows.select(
        F.col("event_id").cast("string").alias("trip_id"),
        route.alias("route_id"),
        start_time,
        start_date,
        F.lit(None).cast("string").alias("status"),
        (k % 8).alias("total_stops"),
        F.col("user_id").cast("int").alias("vehicle_id"),
        F.col("event_type").alias("vehicle_type"),
        (k % 5).alias("operator"),
        (k % 2 + 1).cast("string").alias("direction"),
        F.col("event_id").cast("int").alias("journey_id"),
        k.alias("line"),
        F.when(k % 13 != 0, F.col("value")).alias("speed"),
        F.when(k % 10 != 0, k).alias("occupancy"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.lit(float("nan"))).otherwise(delay).alias("delay"),
        (60 + k.cast("double") / 100).alias("vehicle_latitude"),
        (24 + (F.col("user_id") % 100).cast("double") / 100).alias("vehicle_longitude"),
        F.col("ts").alias("timestamp"),
        moment_to_epoch(rows, "ts").alias("timestamp_seconds"),
        (k % 50).cast("string").alias("stop"),
        (F.col("value") * 8).alias("odometer"),
        F.when(k % 2 == 0, F.lit("GPS")).otherwise(F.lit("ODO")).alias("location_source"),
    )


def graph_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored facts for the graph: all line items, with gaps in every id."""
    items = table(spark, sf_dir, "lineitem")
    percent = F.round(F.col("l_discount") * 100).cast("int")
    return items.select(
        F.when(percent != 9, F.col("l_suppkey")).alias("vehicle_id"),
        F.col("l_returnflag").alias("vehicle_type"),
        F.col("l_linenumber").alias("operator"),
        (F.col("l_partkey") % 20).cast("int").alias("line"),
        F.col("l_quantity").alias("speed"),
        F.round(F.col("l_tax") * 100).cast("int").alias("occupancy"),
        F.when(percent != 8, F.col("l_orderkey")).alias("trip_id"),
        F.concat(F.lit("R"), (F.col("l_orderkey") % 20).cast("string")).alias("route_id"),
        F.concat(F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("start_time"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("start_date"),
        F.col("l_linestatus").alias("direction"),
        F.col("l_linenumber").alias("total_stops"),
        F.when(percent != 10, F.col("l_partkey")).alias("stop"),
        F.when(percent != 0, 60 + (F.col("l_partkey") % 100).cast("double") / 100).alias("vehicle_latitude"),
        (24 + F.col("l_tax")).alias("vehicle_longitude"),
        moment_to_epoch(items, "l_shipdate").alias("timestamp_seconds"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_extendedprice").alias("price"),
    )


def arriving(
    rows: DataFrame, moment: str, key: str, clock: dict, folder: str, pieces: int = 4,
    piece_rows: int = 10_000_000, file_rows: int = 1_000_000,
) -> int:
    """Store rows in pieces in the order they arrive, some of them one or two days late by ``key``.

    There are ``pieces`` of them, or more where one would get more than ``piece_rows``. A last file
    holds one row with nothing but ``clock``, much later than all others: it tells a stream that
    their time is over.

    Returns how many files a piece has, every piece as many: its rows lie in them in no order,
    so a stream has to take it whole, or it would find those of the next file late.
    """
    spark = rows.sparkSession
    arrival = F.unix_timestamp(F.col(moment).cast("timestamp")) + F.pmod(key, F.lit(3)) * 86400
    ends = rows.agg(F.min(arrival).alias("first"), F.max(arrival).alias("last"), F.count("*").alias("rows")).first()
    pieces = max(pieces, -(-ends["rows"] // piece_rows))
    files = max(1, -(-ends["rows"] // (pieces * file_rows)))
    span = (ends["last"] - ends["first"] + pieces) // pieces
    for piece in range(pieces):
        own = rows.where(F.floor((arrival - ends["first"]) / span) == piece)
        own.repartition(files).write.mode("append").parquet(folder)
        stored = len(spark.read.schema(rows.schema).parquet(folder).inputFiles())
        for _ in range((piece + 1) * files - stored):  # a task without rows writes no file
            rows.limit(0).write.mode("append").parquet(folder)
    last = spark.range(0, 1, 1, 1).select(
        *[F.lit(clock.get(field.name)).cast(field.dataType).alias(field.name) for field in rows.schema]
    )
    last.write.mode("append").parquet(folder)
    return files


def arriving_stream(spark: SparkSession, folder: str, like: DataFrame, files: int | None = None) -> DataFrame:
    """The stored rows as a stream, piece after piece of so many files (those of ``like``, a stream
    of the same folder)."""
    files = files or like._files
    stream = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(folder)
    stream._files = files
    return stream


def arriving_events(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """All events as they arrive, and the clock."""
    rows = event_rows(spark, sf_dir)
    files = arriving(rows, "ts", "event_id", {"ts": "2100-01-01 00:00:00", "event_type": "clock"}, folder)
    return arriving_stream(spark, folder, rows, files)


def arriving_items(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """All line items as they arrive, and the clock."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    clock = {"l_shipdate": "2100-01-01 00:00:00", "l_quantity": 25.0}
    files = arriving(rows, "l_shipdate", "l_orderkey", clock, folder)
    return arriving_stream(spark, folder, rows, files)


def planned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with two planned stops per line item."""
    return planned_trips_of(table(spark, sf_dir, "lineitem"))


def planned_trips_of(items: DataFrame) -> DataFrame:
    """The same from line items, which may be a stream."""
    epoch = moment_to_epoch(items, "l_shipdate")

    def stop(column, shift):
        return F.struct(
            F.col(column).cast("string").alias("stop_id"),
            (epoch + shift).cast("bigint").alias("arrival_time"),
            (epoch + shift + 30).cast("bigint").alias("departure_time"),
        )

    updates = F.array(
        stop("l_partkey", F.lit(0)), stop("l_suppkey", (F.col("l_linenumber") - 3) * 600)
    )
    return items.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), updates.alias("stop_time_updates")
    )


def planned_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order, which stops at its parts in the order of their dates."""
    items = table(spark, sf_dir, "lineitem")
    stop = F.struct(
        moment_to_epoch(items, "l_shipdate").cast("bigint").alias("arrival_time"),
        F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"),
    )
    stops = F.transform(
        F.array_sort(F.collect_list(stop)),
        lambda stop: F.struct(
            stop["part"].cast("string").alias("stop_id"),
            # Some arrivals are not known.
            F.when(stop["part"] % 11 != 0, stop["arrival_time"]).alias("arrival_time"),
            stop["arrival_time"].alias("departure_time"),
        ),
    )
    return items.groupBy(F.col("l_orderkey").cast("string").alias("trip_id")).agg(stops.alias("stop_time_updates"))


def observed_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed positions at the stops of those trips."""
    return observed_stops_of(table(spark, sf_dir, "lineitem"))


def observed_stops_of(items: DataFrame) -> DataFrame:
    """The same from line items, which may be a stream."""
    late = F.col("l_quantity").cast("bigint") * 60 - 1500
    return items.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_partkey").cast("string").alias("stop"),
        (moment_to_epoch(items, "l_shipdate") + late).alias("timestamp_seconds"),
    )


def place_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer to nation and nation to region, as edges."""
    customer, nation = (table(spark, sf_dir, name) for name in ("customer", "nation"))

    def tag(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    return customer.select(
        tag("C_", "c_custkey").alias("src"), tag("N_", "c_nationkey").alias("dst")
    ).unionByName(
        nation.select(tag("N_", "n_nationkey").alias("src"), tag("A_", "n_regionkey").alias("dst"))
    )
