"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitloom.functions import values
from transitloom.functions.times import (
    clock_to_minutes,
    clock_to_seconds,
    clock_with_seconds,
    epoch_clock,
    epoch_date,
    moment_to_epoch,
    reformat_date,
)
from transitloom.operators import (
    analysis,
    enrichment,
    features,
    graph,
    metrics,
    motifs,
    normalize,
    ordering,
    places,
    traversal,
    trip_join,
    visits,
)
from transitloom.operators.messages import (
    decode_value,
    encode_json,
    flatten_vehicle,
    parse_json,
    read_messages,
)
from transitloom.operators.sampling import split_rows
from transitloom.operators.trip_join import join_trips_vehicles
from transitloom.plans import delay_model, graph_tables, testdata
from transitloom.schemas import (
    PREDICTIONS,
    STOP_NODES,
    STOP_PRECEDE_EDGES,
    TRANSPORT_DATA,
    TRIP,
    TRIP_NODES,
    TRIP_STOP_EDGES,
    VEHICLE,
    VEHICLE_NODES,
    VEHICLE_TRIP_EDGES,
)
from transitloom.sources import catalog, files
from transitloom.sources.graph_store import StoredEdges, StoredNodes
from transitloom.storage import materialize, new_path
from transitloom.streaming.alerts import trip_alert_stream
from transitloom.streaming.jobs import (
    ingest_topics,
    monitor_delays,
    publish_vehicles,
    store_joined_facts,
    store_positions,
)
from transitloom.streaming.sinks import count_writer, start_files, table_writer
from transitloom.streaming.weather import weather_enrich_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- normalising raw messages -------------------------------------------------------
@_query
def vehicle_normalize(spark, sf_dir):
    rows = normalize.normalize_vehicle(testdata.raw_vehicle_messages(spark, sf_dir))
    return rows.select(
        "vehicle_id", "vehicle_type", "operator", "route", "destination", "delay", "speed",
        F.col("location.latitude").alias("latitude"),
        F.col("location.longitude").alias("longitude"),
        F.col("location.speed").alias("location_speed"),
        F.col("location.accuracy").alias("accuracy"),
        "occupancy", "stop", "mqtt_topic",
    )


@_query
def reject_malformed(spark, sf_dir):
    return normalize.rejected_vehicle(testdata.raw_vehicle_messages(spark, sf_dir))


@_query
def topic_segment(spark, sf_dir):
    raw = testdata.raw_vehicle_messages(spark, sf_dir)
    return raw.select("event_id", values.topic_segment("topic").alias("vehicle_type"))


@_query
def clamp_non_negative(spark, sf_dir):
    rows = testdata.event_rows(spark, sf_dir)
    speed = F.when(F.col("k") % 7 != 0, F.col("value") - 50)
    return rows.select("event_id", values.clamp_non_negative(speed).alias("speed"))


@_query
def trip_updates_normalize(spark, sf_dir):
    trips = normalize.normalize_trip_updates(testdata.trip_feed(spark, sf_dir))
    return trips.select(
        "trip_id", "route_id", "start_time", "start_date", "status",
        F.size("stop_time_updates").alias("total_stops"),
    )


@_query
def nested_stop_times(spark, sf_dir):
    updates = normalize.explode_entities(testdata.trip_feed(spark, sf_dir)).select(
        F.col("trip.trip_id").alias("trip_id"),
        normalize.stop_times(F.col("stop_time_update")).alias("stops"),
    )
    return updates.select(
        "trip_id",
        F.array_size("stops").alias("total_stops"),
        F.posexplode_outer("stops").alias("stop_sequence", "stop"),
    ).select("trip_id", "total_stops", "stop_sequence", "stop.*")


@_query
def date_reformat(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders")
    digit = F.col("o_orderkey") % 10
    compact = (
        F.when(digit == 1, F.lit(""))
        .when(digit == 2, F.lit("20240230"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    dashed = reformat_date(compact, "yyyyMMdd", "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        dashed.alias("dashed"),
        reformat_date(dashed, "yyyy-MM-dd", "yyyyMMdd").alias("compact"),
    )


@_query
def time_reformat(spark, sf_dir):
    orders = testdata.table(spark, sf_dir, "orders")
    clock = F.concat(
        F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((F.col("o_custkey") % 75).cast("string"), 2, "0"), F.lit(":07"),
    )
    return orders.select(
        "o_orderkey",
        clock_to_minutes(clock).alias("minutes"),
        clock_with_seconds(clock).alias("with_seconds"),
        clock_to_seconds(clock).alias("seconds"),
    )


@_query
def weather_normalize(spark, sf_dir):
    return normalize.normalize_weather(
        testdata.raw_weather_documents(spark, sf_dir), testdata.LATITUDE, testdata.LONGITUDE
    )


@_query
def epoch_split(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    seconds = moment_to_epoch(events, "ts")
    return events.select("event_id", epoch_date(seconds).alias("date"), epoch_clock(seconds).alias("time"))


# --- parsing and flattening ---------------------------------------------------------
def _vehicle_records(spark, sf_dir):
    vehicles = testdata.vehicle_rows(testdata.event_rows(spark, sf_dir), whole=True)
    return testdata.records(vehicles, "bus", "vehicle-positions")


_FLAT = [
    "vehicle_id", "vehicle_type", "operator", "route", "direction", "start_time", "start_date",
    "destination", "journey_id", "line", "timestamp", "timestamp_seconds", "delay", "speed",
    "latitude", "longitude", "vehicle_speed", "heading", "accuracy", "occupancy", "stop",
    "odometer", "location_source", "mqtt_topic",
]


@_query
def json_parse(spark, sf_dir):
    fields = ["vehicle_id", "route", "journey_id", "timestamp_seconds", "speed", "occupancy"]
    messages = decode_value(_vehicle_records(spark, sf_dir))
    parsed = parse_json(messages, VEHICLE, columns=[*fields, "location"])
    return parsed.select(
        *fields,
        F.col("location.latitude").alias("vehicle_latitude"),
        F.col("location.longitude").alias("vehicle_longitude"),
    )


@_query
def vehicle_flatten(spark, sf_dir):
    return flatten_vehicle(read_messages(_vehicle_records(spark, sf_dir), VEHICLE)).select(*_FLAT)


@_query
def json_encode(spark, sf_dir):
    trips = testdata.facts(spark, sf_dir).select(
        "trip_id", "route_id", "status", "total_stops", "speed", "occupancy", "stop"
    )
    return encode_json(trips).select(F.col("value").cast("string").alias("value"))


# --- joins --------------------------------------------------------------------------
_JOINED = [name for name in TRANSPORT_DATA.names if name != "processed_time"]


@_query
def trip_vehicle_join(spark, sf_dir):
    rows = testdata.event_rows(spark, sf_dir)
    joined = join_trips_vehicles(testdata.trip_rows(rows), testdata.vehicle_rows(rows))
    return joined.select(*_JOINED)


@_query
def distinct_trips(spark, sf_dir):
    trips = testdata.trip_rows(testdata.event_rows(spark, sf_dir), whole=True)
    polled = trips.unionByName(trips)
    return trip_join.distinct_trips(polled).select("trip_id", "route_id", "start_time", "start_date")


# --- features -----------------------------------------------------------------------
@_query
def time_features(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events").select("event_id", "ts")
    both = features.time_features(events, "ts").withColumnRenamed("is_weekend", "saturday_sunday")
    friday = features.time_features(both, "ts", weekend_days=(6, 7))
    return friday.withColumnRenamed("is_weekend", "friday_saturday").drop("ts")


@_query
def time_features_in_zone(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    texts = events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))
    return features.time_features(texts, "at", zone="Asia/Bangkok").drop("at")


@_query
def feature_frame(spark, sf_dir):
    return features.feature_frame(testdata.facts(spark, sf_dir))


@_query
def valid_label(spark, sf_dir):
    return features.valid_label(testdata.facts(spark, sf_dir)).select("journey_id", "delay")


@_query
def fill_missing(spark, sf_dir):
    filled = features.fill_zero(testdata.facts(spark, sf_dir))
    return filled.select("journey_id", "speed", "occupancy", "vehicle_latitude", "odometer")


@_query
def epoch_features(spark, sf_dir):
    numeric = features.to_epoch(testdata.facts(spark, sf_dir))
    return numeric.select(
        "journey_id", "timestamp_numeric", "start_time_numeric", "start_date_numeric"
    )


@_query
def schema_align(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    wanted = ["speed", "occupancy", "hour", "vehicle_type_index", "odometer"]
    return features.align_schema(facts, wanted, keep=["journey_id"])


@_query
def string_index(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir).withColumn(
        "vehicle_type", F.when(F.col("line") % 11 != 0, F.col("vehicle_type"))
    )
    encoded = features.encode_categoricals(facts)
    return encoded.select("journey_id", *[f"{name}_index" for name in features.CATEGORICAL])


@_query
def category_frequency(spark, sf_dir):
    return metrics.category_ranking(testdata.facts(spark, sf_dir), "route_id")


@_query
def assembled_rows(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    vectors = features.assemble(facts, ["speed", "occupancy", "delay", "odometer"])
    return vectors.select("journey_id")


# --- metrics, counts, histogram -----------------------------------------------------
def _scored_events(spark, sf_dir):
    rows = testdata.event_rows(spark, sf_dir)
    return rows.select(
        (F.floor("value") - 50).alias("delay"), (F.col("k") - 20).cast("double").alias("prediction")
    )


@_query
def regression_metrics(spark, sf_dir):
    scored = _scored_events(spark, sf_dir)
    both = [
        metrics.regression_metrics(scored, signed=signed).withColumn("signed", F.lit(signed))
        for signed in (False, True)
    ]
    rounded = [F.round(name, 6).alias(name) for name in ("rmse", "mae", "r2", "mape")]
    return both[0].unionByName(both[1]).select("signed", "rows", *rounded)


@_query
def row_counts(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    nodes = graph.stop_nodes(testdata.graph_facts(spark, sf_dir))
    counts = [
        metrics.row_count(facts, "facts"),
        metrics.row_count(nodes, "stops"),
        metrics.row_count(facts.where("delay < -1e9"), "impossible_delays"),
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@_query
def delay_histogram(spark, sf_dir):
    counts = metrics.histogram(testdata.facts(spark, sf_dir), "delay")
    return counts.select(
        "bin", F.round("bin_start", 6).alias("bin_start"), F.round("bin_end", 6).alias("bin_end"),
        "row_count",
    )


# --- order, batches, samples --------------------------------------------------------
@_query
def timestamp_batches(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events").select("event_id", "ts")
    return ordering.batch_id(events, ["ts", "event_id"], 1000).select("event_id", "batch_id")


@_query
def first_batch(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events")
    return ordering.first_rows(events, ["ts", "event_id"], 1000).select("event_id", "value")


@_query
def train_test_split(spark, sf_dir):
    events = testdata.table(spark, sf_dir, "events").select("event_id")
    train, test = split_rows(events, ["event_id"])
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


# --- graph --------------------------------------------------------------------------
@_query
def vehicle_nodes(spark, sf_dir):
    return graph.vehicle_nodes(testdata.graph_facts(spark, sf_dir))


@_query
def trip_nodes(spark, sf_dir):
    return graph.trip_nodes(testdata.graph_facts(spark, sf_dir))


@_query
def stop_nodes(spark, sf_dir):
    return graph.stop_nodes(testdata.graph_facts(spark, sf_dir))


@_query
def vehicle_trip_edges(spark, sf_dir):
    return graph.vehicle_trip_edges(testdata.graph_facts(spark, sf_dir))


@_query
def trip_stop_edges(spark, sf_dir):
    return graph.trip_stop_edges(testdata.graph_facts(spark, sf_dir))


@_query
def position_edges(spark, sf_dir):
    return graph.position_edges(testdata.graph_facts(spark, sf_dir))


@_query
def position_nodes(spark, sf_dir):
    return graph.position_nodes(testdata.graph_facts(spark, sf_dir))


@_query
def stop_precede(spark, sf_dir):
    return graph.stop_precede(testdata.graph_facts(spark, sf_dir))


@_query
def stop_precede_by_time(spark, sf_dir):
    return graph.stop_precede(testdata.graph_facts(spark, sf_dir), order="timestamp_seconds")


def _known_ids(spark, sf_dir):
    supplier, orders, part = (
        testdata.table(spark, sf_dir, name) for name in ("supplier", "orders", "part")
    )
    tagged = [
        supplier.where("s_acctbal > 0").select(F.concat(F.lit("V_"), "s_suppkey").alias("id")),
        orders.where("o_orderstatus <> 'P'").select(F.concat(F.lit("T_"), "o_orderkey").alias("id")),
        part.where("p_size > 10").select(F.concat(F.lit("S_"), "p_partkey").alias("id")),
    ]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@_query
def graph_edges_resolved(spark, sf_dir):
    facts = testdata.graph_facts(spark, sf_dir)
    ids = materialize(_known_ids(spark, sf_dir).distinct(), "node-ids")  # for both ends
    edges = graph_tables.stored_edges(facts)
    existing = edges.where(F.col("relation") == graph.PRECEDE)
    return graph.upsert_edges(existing, graph.resolve_edges(edges, ids, ids))


@_query
def graph_position_edges_resolved(spark, sf_dir):
    edges = graph.position_edges(testdata.graph_facts(spark, sf_dir))
    vehicles = testdata.table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return graph.resolve_edges(edges, vehicles, None, src="vehicle_id")


@_query
def graph_position_upsert(spark, sf_dir):
    facts = testdata.graph_facts(spark, sf_dir)
    vehicles = testdata.table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    moved = materialize(graph.position_relation(facts, vehicles), "moved")
    existing = moved.where("vehicle_latitude > 0")
    edges = graph.upsert_edges(graph.upsert_edges(existing, moved), moved)
    stored = edges.select("vehicle_latitude", "vehicle_longitude").distinct()
    nodes = graph.upsert_edges(stored, graph.position_nodes(facts))
    return edges.unionByName(
        nodes.select(
            F.lit(None).cast("string").alias("src"), "*", F.lit("position").alias("relation")
        )
    )


@_query
def graph_node_upsert(spark, sf_dir):
    existing = testdata.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vehicle_id"),
        F.lit("stored").alias("vehicle_type"),
        F.col("s_nationkey").alias("operator"),
        F.lit(0).alias("line"),
        F.lit(0.0).alias("speed"),
        F.lit(None).cast("int").alias("occupancy"),
    )
    incoming = testdata.graph_facts(spark, sf_dir)
    order = ["timestamp_seconds", "order_key", "line_number", "part_key", "price"]
    return graph.upsert_nodes(existing, incoming, "vehicle_id", order)


@_query
def graph_assemble(spark, sf_dir):
    # Stops only from rows that have a position, so that some endpoints lack a node.
    nodes, edges = graph_tables.assembled_graph(
        testdata.graph_facts(spark, sf_dir), stop_when="vehicle_latitude IS NOT NULL"
    )
    return _graph_rows(nodes, edges)


def _graph_rows(nodes, edges):
    return nodes.select(
        F.col("id").alias("src"), F.lit(None).cast("string").alias("dst"), "label", "color", "size"
    ).unionByName(
        edges.select(
            "src", "dst", F.col("title").alias("label"),
            F.lit(None).cast("string").alias("color"), F.lit(None).cast("int").alias("size"),
        )
    )


@_query
def graph_sample(spark, sf_dir):
    folder = new_path(spark, "graph")
    graph_tables.export_graph(testdata.graph_facts(spark, sf_dir), folder)
    shapes = {
        "nodes_vehicles": VEHICLE_NODES,
        "nodes_trips": TRIP_NODES,
        "nodes_stops": STOP_NODES,
        "edges_vehicle_trip": VEHICLE_TRIP_EDGES,
        "edges_trip_stop": TRIP_STOP_EDGES,
        "edges_stop_precede": STOP_PRECEDE_EDGES,
    }
    frames = [
        files.read_if_exists(spark, f"{folder}/{name}.csv", schema) for name, schema in shapes.items()
    ]
    return _graph_rows(*graph.sample_graph(*frames))


@_query
def graph_select(spark, sf_dir):
    facts = testdata.graph_facts(spark, sf_dir)
    nodes = graph.vehicle_nodes(facts).withColumn("id", F.concat(F.lit("V_"), "vehicle_id"))
    edges = graph.transport_edges(facts)
    found = [
        graph.select_subgraph(nodes, edges, "node", "vehicle_type", ["R"]),
        graph.select_subgraph(nodes, edges, "node", "speed", ["7", "0"]),
        graph.select_subgraph(nodes, edges, "edge", "relation", [graph.EFFECTUE]),
    ]
    named = [
        frame.withColumn("chosen_by", F.lit(name))
        for frame, name in zip(found, ("vehicle_type", "speed", "relation"))
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


@_query
def graph_k_hop(spark, sf_dir):
    edges = graph_tables.stored_edges(testdata.graph_facts(spark, sf_dir)).select("src", "dst")
    seeds = testdata.table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(
        F.concat(F.lit("V_"), "s_suppkey").alias("id")
    )
    return traversal.neighborhood(edges, seeds, 2)


@_query
def graph_degrees(spark, sf_dir):
    return traversal.degrees(graph_tables.stored_edges(testdata.graph_facts(spark, sf_dir)))


@_query
def graph_components(spark, sf_dir):
    edges = graph.transport_edges(testdata.graph_facts(spark, sf_dir)).select("src", "dst")
    return traversal.connected_components(edges.unionByName(testdata.place_edges(spark, sf_dir)))


@_query
def graph_pagerank(spark, sf_dir):
    edges = graph_tables.stored_edges(testdata.graph_facts(spark, sf_dir)).select("src", "dst")
    ranked = analysis.pagerank(edges, rounds=10)
    return ranked.select("id", F.round("rank", 12).alias("rank"))


@_query
def graph_strong_components(spark, sf_dir):
    succession = graph.precede_edges(testdata.graph_facts(spark, sf_dir), order="timestamp_seconds")
    return analysis.strong_components(succession.toDF("src", "dst"))


@_query
def travel_times(spark, sf_dir):
    return analysis.travel_times(testdata.planned_routes(spark, sf_dir))


@_query
def graph_shortest_paths(spark, sf_dir):
    times = analysis.travel_times(testdata.planned_routes(spark, sf_dir))
    seeds = testdata.table(spark, sf_dir, "part").where("p_size = 50")
    return analysis.shortest_paths(
        times, seeds.select(F.col("p_partkey").cast("string").alias("id")), delta=60 * 86400
    )


@_query
def graph_triangles(spark, sf_dir):
    edges = graph.transport_edges(testdata.graph_facts(spark, sf_dir)).select("src", "dst")
    return analysis.triangles(edges)


@_query
def graph_motifs(spark, sf_dir):
    relations = motifs.stored_relations(
        graph_tables.motif_relations(testdata.graph_facts(spark, sf_dir), "timestamp_seconds")
    )
    runs, hop, back = graph.EFFECTUE, "HOP", "BACK"
    there_and_back = motifs.find_motifs(
        relations,
        [("v", runs, "t1"), ("v", runs, "t2"), ("t1", hop, "p"), ("t2", hop, "q"), ("p", back, "q")],
        different=[("t1", "t2")],
        ordered=[("p", "q")],
    )
    same_hop = motifs.find_motifs(
        relations,
        [("v1", runs, "t1"), ("t1", hop, "p"), ("t2", hop, "p"), ("v2", runs, "t2")],
        different=[("v1", "v2")],
        ordered=[("t1", "t2")],
    )
    return there_and_back.select(
        F.lit("there and back").alias("motif"), F.col("v").alias("v1"), "t1", F.col("v").alias("v2"), "t2", "p", "q"
    ).unionByName(same_hop.select(
        F.lit("same hop").alias("motif"), "v1", "t1", "v2", "t2", "p", F.lit(None).cast("string").alias("q")
    ))


@_query
def graph_stored_upsert(spark, sf_dir):
    folder = new_path(spark, "store")
    facts = testdata.graph_facts(spark, sf_dir)
    incoming = materialize(facts.select(
        *graph.VEHICLE_COLUMNS, "trip_id", "timestamp_seconds", "order_key", "line_number", "part_key", "price"
    ), "batches")
    nodes = StoredNodes(f"{folder}/vehicles", graph.vehicle_nodes(incoming).schema, "vehicle_id", buckets=16)
    order = ["timestamp_seconds", "order_key", "line_number", "part_key", "price"]
    edges = StoredEdges(f"{folder}/edges", _vehicle_trips(incoming).schema, buckets=16)
    # The second batch comes again, after the third.
    for batch in (0, 1, 2, 1):
        part = incoming.where(F.floor(F.col("line_number") / 3) == batch)
        nodes.apply(part, batch, order)
        edges.apply(_vehicle_trips(part), batch)
    none = F.lit(None)
    return nodes.read(spark).select(
        F.concat(F.lit("V_"), "vehicle_id").alias("src"), none.cast("string").alias("dst"),
        "vehicle_type", "operator", "line", "speed", "occupancy", "batch",
    ).unionByName(edges.read(spark).select(
        "src", "dst", none.cast("string").alias("vehicle_type"), none.cast("int").alias("operator"),
        none.cast("int").alias("line"), none.cast("double").alias("speed"),
        none.cast("int").alias("occupancy"), "batch",
    ))


def _vehicle_trips(facts):
    return graph.vehicle_trip_edges(facts).select(
        F.concat(F.lit("V_"), "vehicle_id").alias("src"), F.concat(F.lit("T_"), "trip_id").alias("dst"),
        F.lit(graph.EFFECTUE).alias("relation"),
    )


def _stays(spark, sf_dir):
    rows = testdata.event_rows(spark, sf_dir)
    # Three stops, so that vehicles stay at one and come back to it.
    return rows.select(
        F.col("user_id").alias("vehicle_id"), moment_to_epoch(rows, "ts").alias("timestamp_seconds"),
        F.when(F.col("k") % 10 != 0, F.floor(F.col("k") / 34)).alias("stop"),
    )


@_query
def stop_visits(spark, sf_dir):
    return visits.stop_visits(_stays(spark, sf_dir))


@_query
def stop_visits_with_gaps(spark, sf_dir):
    return visits.stop_visits(_stays(spark, sf_dir), max_gap=2 * 86400)


@_query
def nearest_stop(spark, sf_dir):
    positions = testdata.event_rows(spark, sf_dir).select(
        "event_id", (60 + F.col("value") / 1000).alias("latitude"),
        F.when(F.col("k") % 10 != 9, 24 + F.col("k") / 50).alias("longitude"),
    )
    # Most stops lie close together, the others far out.
    key = F.col("p_partkey")
    wide = F.when(key % 4 == 0, F.lit(1.0)).otherwise(F.lit(64.0))
    stops = testdata.table(spark, sf_dir, "part").select(
        key.alias("stop"), (60 + key * 7919 % 1000 / 500.0 / wide).alias("latitude"),
        (24 + key * 7907 % 997 / 250.0 / wide).alias("longitude"),
    )
    return places.nearest_stop(positions, stops, around=60.0)


# --- enrichment and monitoring ------------------------------------------------------
def _positions_and_reports(rows):
    timed = rows.withColumn("minute", F.floor(moment_to_epoch(rows, "ts") / 60))
    reports = timed.where("event_type = 'signup'").select(
        "minute", F.col("value").alias("temperature"), F.col("event_id").alias("report_id")
    )
    return timed.where("event_type <> 'signup'").select("event_id", "minute"), reports


@_query
def weather_enrich(spark, sf_dir):
    positions, reports = _positions_and_reports(testdata.event_rows(spark, sf_dir))
    return enrichment.weather_enrich(positions, reports, tie_break=["report_id"])


@_query
def trip_alerts(spark, sf_dir):
    return enrichment.trip_alerts(testdata.planned_trips(spark, sf_dir), testdata.observed_stops(spark, sf_dir))


@_query
def trip_sync_issues(spark, sf_dir):
    return enrichment.trip_sync_issues(
        testdata.planned_trips(spark, sf_dir), testdata.observed_stops(spark, sf_dir), threshold=300
    )


@_query
def windowed_delay(spark, sf_dir):
    vehicles = testdata.vehicle_rows(testdata.event_rows(spark, sf_dir), whole=True)
    moved = vehicles.withColumn("at", F.col("timestamp_seconds").cast("timestamp"))
    return enrichment.windowed_delay(moved, "at", "1 hour").select(
        F.unix_seconds("start").alias("window_start"), "route", "positions", "mean_delay"
    )


# --- sources and sinks --------------------------------------------------------------
def _predictions(spark, sf_dir):
    """Rows of the predictions table: the features of all events and a made-up score."""
    frame = features.fill_zero(features.to_epoch(features.time_features(testdata.facts(spark, sf_dir))))
    indexes = {f"{name}_index": F.pmod(F.length(F.col(name).cast("string")), F.lit(5))
               for name in features.CATEGORICAL}
    scored = frame.withColumns(indexes).withColumn("predicted_delay", F.col("odometer") / 16)
    return scored.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in PREDICTIONS]
    )


@_query
def csv_round_trip(spark, sf_dir):
    path = new_path(spark, "predictions-csv")
    files.write_csv(_predictions(spark, sf_dir), path)
    return files.read_predictions_csv(spark, path)


@_query
def facts_csv_round_trip(spark, sf_dir):
    rows = testdata.event_rows(spark, sf_dir)
    joined = join_trips_vehicles(testdata.trip_rows(rows), testdata.vehicle_rows(rows))
    path = new_path(spark, "facts-csv")
    files.write_csv(joined, path, compression="gzip")
    return files.read_transport_csv(spark, path).select(*_JOINED)


@_query
def facts_by_date(spark, sf_dir):
    path = new_path(spark, "facts")
    files.write_facts(testdata.facts(spark, sf_dir).drop("status", "timestamp"), path)
    stored = files.read_facts(spark, path, testdata.facts(spark, sf_dir).schema)
    counts = [
        frame.groupBy(F.lit(name).alias("dates"), "start_date").agg(F.count("*").alias("row_count"))
        for name, frame in (("all", stored), ("recent", stored.where("start_date >= '2024-01-15'")))
    ]
    return counts[0].unionByName(counts[1])


@_query
def view_scan(spark, sf_dir):
    catalog.register_view(testdata.facts(spark, sf_dir))
    return catalog.read_view(spark).select("trip_id", "route_id", "start_date", "line", "odometer")


@_query
def ensure_table(spark, sf_dir):
    location = new_path(spark, "predictions")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    catalog.ensure_table(spark, name, location=location)
    catalog.append_table(_predictions(spark, sf_dir), name)
    catalog.ensure_table(spark, name, location=location)
    return catalog.read_view(spark, name)


# --- streaming ----------------------------------------------------------------------
@_query
def stream_ingest(spark, sf_dir):
    def rows():
        return testdata.event_stream(spark, sf_dir)

    folder = new_path(spark, "ingest")
    jobs = ingest_topics(
        {
            "trip": testdata.records(testdata.trip_rows(rows()), "trip", "trip-updates"),
            "vehicle": testdata.records(testdata.vehicle_rows(rows()), "bus", "vehicle-positions"),
            "weather": testdata.records(testdata.weather_rows(rows()), "sky", "weather"),
        },
        folder,
        available_now=True,
    )
    for job in jobs.values():
        job.awaitTermination()
    stored = {kind: spark.read.parquet(f"{folder}/{kind}") for kind in jobs}
    kinds = {
        "trip": ("trip_id", "start_date", "start_time"),
        "vehicle": ("journey_id", "start_date", "start_time"),
        "weather": ("temperature", "date", "time"),
    }
    parts = [
        stored[kind].select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"),
            F.col(date).alias("date"), F.col(time).alias("time"),
        )
        for kind, (key, date, time) in kinds.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def stream_to_table(spark, sf_dir):
    folder = new_path(spark, "positions")
    vehicles = testdata.vehicle_rows(testdata.event_stream(spark, sf_dir), whole=True)
    job = store_positions(
        testdata.records(vehicles, "bus", "vehicle-positions"),
        [table_writer(f"{folder}/rows"), count_writer(f"{folder}/counts", ["vehicle_type"])],
        f"{folder}/_checkpoint",
        available_now=True,
    )
    job.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select(*_FLAT)


@_query
def stream_counts(spark, sf_dir):
    folder = new_path(spark, "positions")
    vehicles = testdata.vehicle_rows(testdata.event_stream(spark, sf_dir), whole=True)
    job = store_positions(
        testdata.records(vehicles, "bus", "vehicle-positions"),
        [count_writer(f"{folder}/counts", ["vehicle_type"])],
        f"{folder}/_checkpoint",
        available_now=True,
    )
    job.awaitTermination()
    counts = spark.read.parquet(f"{folder}/counts").groupBy("vehicle_type")
    return counts.agg(F.sum("row_count").cast("bigint").alias("row_count"))


@_query
def stream_trip_vehicle_join(spark, sf_dir):
    folder = new_path(spark, "joined")
    # The feed repeats every trip with each poll.
    polled = testdata.event_stream(spark, sf_dir).withColumn("poll", F.explode(F.array(F.lit(1), F.lit(2))))
    trips = testdata.trip_rows(polled)
    vehicles = testdata.vehicle_rows(testdata.event_stream(spark, sf_dir))
    job = store_joined_facts(
        testdata.records(trips, "trip", "trip-updates"),
        testdata.records(vehicles, "bus", "vehicle-positions"),
        [table_writer(f"{folder}/rows")],
        f"{folder}/_checkpoint",
        watermark=None,
        available_now=True,
    )
    job.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select(*_JOINED)


@_query
def stream_normalize(spark, sf_dir):
    folder = new_path(spark, "normalized")
    raw = testdata.raw_vehicle_messages_of(testdata.event_stream(spark, sf_dir))
    job = publish_vehicles(
        raw,
        [table_writer(f"{folder}/published")],
        [table_writer(f"{folder}/rejected")],
        f"{folder}/_checkpoint",
        available_now=True,
    )
    job.awaitTermination()
    published = spark.read.parquet(f"{folder}/published").select(
        F.lit("published").alias("side"), F.col("mqtt_topic").alias("topic"), "vehicle_type",
        "vehicle_id", F.lit(None).cast("string").alias("payload"),
    )
    rejected = spark.read.parquet(f"{folder}/rejected").select(
        F.lit("rejected").alias("side"), "topic", F.lit(None).cast("string").alias("vehicle_type"),
        F.lit(None).cast("int").alias("vehicle_id"), "payload",
    )
    return published.unionByName(rejected)


@_query
def stream_windowed_delay(spark, sf_dir):
    folder = new_path(spark, "delays")
    events = testdata.arriving_events(spark, sf_dir, f"{folder}/events")
    job = monitor_delays(
        testdata.records(testdata.vehicle_rows(events, whole=True), "bus", "vehicle-positions"),
        f"{folder}/rows", f"{folder}/_checkpoint", watermark="4 days", available_now=True,
    )
    job.awaitTermination()
    # The sink's log names the files; the clock's own window is still open.
    return spark.read.parquet(f"{folder}/rows").select(
        F.unix_seconds("start").alias("window_start"), "route", "positions", "mean_delay"
    )


@_query
def stream_trip_sync(spark, sf_dir):
    folder = new_path(spark, "alerts")
    items = testdata.arriving_items(spark, sf_dir, f"{folder}/items")
    again = testdata.arriving_stream(spark, f"{folder}/items", items)
    alerts = trip_alert_stream(
        testdata.planned_trips_of(items), testdata.observed_stops_of(again), watermark="4 days"
    )
    start_files(alerts, f"{folder}/rows", f"{folder}/_checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{folder}/rows")


@_query
def stream_weather_enrich(spark, sf_dir):
    folder = new_path(spark, "weather")
    events = testdata.arriving_events(spark, sf_dir, f"{folder}/events")
    again = testdata.arriving_stream(spark, f"{folder}/events", events)
    positions, reports = _positions_and_reports(events)[0], _positions_and_reports(again)[1]
    joined = weather_enrich_stream(positions, reports, watermark="4 days", tie_break=["report_id"])
    start_files(joined, f"{folder}/rows", f"{folder}/_checkpoint", available_now=True).awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/rows")


# --- the delay model ----------------------------------------------------------------
def _train(spark, sf_dir):
    return delay_model.train_and_evaluate(testdata.facts(spark, sf_dir), keys=["journey_id"])


@_query
def ml_train(spark, sf_dir):
    _, scored = _train(spark, sf_dir)
    return delay_model.evaluate(scored)


@_query
def ml_importance(spark, sf_dir):
    model, _ = _train(spark, sf_dir)
    return delay_model.feature_importance(model, spark)


@_query
def ml_score(spark, sf_dir):
    model, _ = _train(spark, sf_dir)
    path = new_path(spark, "model")
    delay_model.save_model(model, path)
    frame = features.feature_frame(testdata.facts(spark, sf_dir))
    return delay_model.score(delay_model.load_model(path), frame)


@_query
def ml_batch_score(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    return delay_model.train_score_batches(facts, ["timestamp", "journey_id"], ["journey_id"])


@_query
def ml_train_check(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    _, scored = delay_model.train_and_evaluate(facts, keys=["journey_id"], trees=20)
    found = delay_model.evaluate(scored)
    return found.select("rows", (F.col("r2") > 0).alias("beats_mean"))


@_query
def ml_score_rows(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    frame = features.feature_frame(facts).withColumn("stop", F.expr("CASE WHEN line % 3 > 0 THEN stop END"))
    model = delay_model.train_delay_model(frame, trees=20)
    bounds = frame.where("stop IS NOT NULL").agg(F.min("delay").alias("low"), F.max("delay").alias("high")).first()
    inside = F.col("predicted_delay").between(bounds["low"], bounds["high"])
    return delay_model.score(model, frame, keep=["journey_id"]).select(
        "journey_id", "stop", "odometer", "hour", inside.alias("within_labels")
    )


def _without_score(scored):
    """All a scored frame returns but the score itself: whether there is one."""
    return scored.withColumn("is_scored", F.col("predicted_delay").isNotNull()).drop("predicted_delay")


@_query
def ml_score_columns(spark, sf_dir):
    return _without_score(ml_score(spark, sf_dir))


@_query
def ml_batch_columns(spark, sf_dir):
    return _without_score(ml_batch_score(spark, sf_dir))


@_query
def ml_batch_rows(spark, sf_dir):
    facts = testdata.facts(spark, sf_dir)
    scored = delay_model.train_score_batches(
        facts, ["timestamp", "journey_id"], ["journey_id"], trees=20
    )
    return scored.select("batch_id", "journey_id")
