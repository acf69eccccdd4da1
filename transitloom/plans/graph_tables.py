"""Facts to graph tables: every node and edge frame, and writing them out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitloom.operators import graph
from transitloom.operators.skew import tasks_for
from transitloom.sources.files import write_csv
from transitloom.storage import materialize


def graph_frames(facts: DataFrame) -> dict[str, DataFrame]:
    """All node and edge frames of a fact table by the name of their file."""
    return {
        "nodes_vehicles": graph.vehicle_nodes(facts),
        "nodes_trips": graph.trip_nodes(facts),
        "nodes_stops": graph.stop_nodes(facts),
        "edges_vehicle_trip": graph.vehicle_trip_edges(facts),
        "edges_trip_stop": graph.trip_stop_edges(facts),
        "edges_vehicle_position": graph.position_edges(facts),
        "edges_stop_precede": graph.precede_edges(facts),
    }


def export_graph(facts: DataFrame, folder: str) -> list[str]:
    """Write the frames that have rows as CSV; returns the names written.

    Each frame reads its own few columns of the facts, so facts are best kept in a
    columnar table. A projection is empty when no fact has its keys, which the first
    match answers; the succession is small and stored before it is looked at.
    """
    keys = {
        "nodes_vehicles": ["vehicle_id"],
        "nodes_trips": ["trip_id"],
        "nodes_stops": ["stop"],
        "edges_vehicle_trip": ["vehicle_id", "trip_id"],
        "edges_trip_stop": ["trip_id", "stop"],
        "edges_vehicle_position": ["vehicle_id", "vehicle_latitude", "vehicle_longitude"],
    }
    written = []
    for name, frame in graph_frames(facts).items():
        if name in keys:
            empty = facts.select(*keys[name]).dropna().isEmpty()
        else:
            frame = materialize(frame, name)
            empty = frame.isEmpty()
        if not empty:
            write_csv(frame, f"{folder}/{name}.csv")
            written.append(name)
    return written


def stored_edges(facts: DataFrame) -> DataFrame:
    """All tagged edges as a table of their own, for operators that read them several times."""
    return materialize(graph.transport_edges(facts), "edges")


def assembled_graph(facts: DataFrame, stop_when: str = "true") -> tuple[DataFrame, DataFrame]:
    """Nodes and titled edges of a fact table, which is read once.

    What the graph needs of it, its different visits, is stored, and so are the edges: they
    are a result themselves and give the nodes their endpoints.
    """
    visits = materialize(
        facts.groupBy("vehicle_id", "trip_id", "stop").agg(
            F.coalesce(F.bool_or(F.expr(stop_when)), F.lit(False)).alias("stop_drawn")
        ),
        "visits",
    )
    tasks = tasks_for(3 * visits.count())  # each gives three edges at most
    edges = materialize(
        graph.assemble_edges(
            graph.vehicle_trip_edges(visits), graph.trip_stop_edges(visits), graph.precede_edges(visits),
            tasks if tasks > 1 else None,
        ),
        "assembled",
    )
    return graph.assemble_fact_nodes(visits, edges, "stop_drawn"), edges


def resolved_edges(facts: DataFrame) -> DataFrame:
    """Tagged edges between existing nodes, each once."""
    ids = materialize(graph.assemble_fact_nodes(facts).select("id"), "node-ids")
    return graph.resolve_edges(stored_edges(facts), ids, ids)


def motif_relations(facts: DataFrame, order: str) -> dict[str, DataFrame]:
    """Relations for patterns of trips: a vehicle runs a trip (EFFECTUE), a trip has a hop from
    one stop to the next by time (``HOP``), and a hop has the one back (``BACK``)."""
    stored = materialize(graph.stop_precede(facts, order), "hops")
    hops = stored.select(
        F.concat(F.lit("T_"), F.col("trip_id").cast("string")).alias("trip"),
        F.concat_ws(">", "stop1", "stop2").alias("hop"), F.concat_ws(">", "stop2", "stop1").alias("back"),
    )
    return {
        graph.EFFECTUE: graph.vehicle_trip_edges(facts).select(
            F.concat(F.lit("V_"), F.col("vehicle_id").cast("string")).alias("src"),
            F.concat(F.lit("T_"), F.col("trip_id").cast("string")).alias("dst"),
        ),
        "HOP": hops.select(F.col("trip").alias("src"), F.col("hop").alias("dst")),
        "BACK": hops.select(F.col("hop").alias("src"), F.col("back").alias("dst")).distinct(),
    }
