"""The vehicle / trip / stop graph: nodes, edges, upserts, selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from transitloom.operators.ordering import next_in_group
from transitloom.operators.sampling import sample_rows
from transitloom.operators.skew import HOT_ROWS, HOT_SHARE, hot_keys, skew_join, tasks_for
from transitloom.storage import materialize

# Relation names, and id prefix, label word, colour and size per node kind.
EFFECTUE, DESSERT, SE_DEPLACE_VERS, PRECEDE = "EFFECTUE", "DESSERT", "SE_DEPLACE_VERS", "PRECEDE"
NODE_KINDS = {
    "vehicle_id": ("V_", "Vehicle", "blue", 10),
    "trip_id": ("T_", "Trip", "green", 8),
    "stop": ("S_", "Stop", "red", 6),
}
VEHICLE_COLUMNS = ("vehicle_id", "vehicle_type", "operator", "line", "speed", "occupancy")
TRIP_COLUMNS = ("trip_id", "route_id", "start_time", "start_date", "direction", "total_stops")
STOP_COLUMNS = ("stop", "vehicle_latitude", "vehicle_longitude")


def _distinct_rows(facts: DataFrame, columns: Sequence[str], required: Sequence[str]) -> DataFrame:
    # Rows without their key are dropped before the shuffle of the distinct.
    return facts.select(*columns).dropna(subset=list(required)).distinct()


def vehicle_nodes(facts: DataFrame) -> DataFrame:
    return _distinct_rows(facts, VEHICLE_COLUMNS, ["vehicle_id"])


def trip_nodes(facts: DataFrame) -> DataFrame:
    return _distinct_rows(facts, TRIP_COLUMNS, ["trip_id"])


def stop_nodes(facts: DataFrame) -> DataFrame:
    return _distinct_rows(facts, STOP_COLUMNS, ["stop"])


def vehicle_trip_edges(facts: DataFrame) -> DataFrame:
    return _distinct_rows(facts, ["vehicle_id", "trip_id"], ["vehicle_id", "trip_id"])


def trip_stop_edges(facts: DataFrame) -> DataFrame:
    return _distinct_rows(facts, ["trip_id", "stop"], ["trip_id", "stop"])


def position_edges(facts: DataFrame) -> DataFrame:
    """Vehicle to position; a position is known by both coordinates, so neither may be NULL."""
    columns = ["vehicle_id", "vehicle_latitude", "vehicle_longitude"]
    return _distinct_rows(facts, columns, columns)


def position_nodes(facts: DataFrame) -> DataFrame:
    return position_edges(facts).select("vehicle_latitude", "vehicle_longitude").distinct()


def stop_precede(
    facts: DataFrame,
    order: str | None = None,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Consecutive stops of each trip as ``(trip_id, stop1, stop2)``.

    Stops follow each other by stop id, or by the first time in column ``order``. Few trips have
    very many rows at all, which one narrow scan tells; only then the different stops are stored,
    and those of such trips counted.
    """
    if order is None:
        visits = trip_stop_edges(facts)
        sort = ["stop"]
    else:
        visits = (
            facts.dropna(subset=["trip_id", "stop"])
            .groupBy("trip_id", "stop")
            .agg(F.min(order).alias("_first"))
        )
        sort = ["_first", "stop"]
    hot = busy = hot_keys(facts.where("stop IS NOT NULL"), ["trip_id"], hot_rows, hot_share)
    if busy:
        visits = materialize(visits, "visits")  # counted, and read for either kind of trip
        suspects = visits.join(busy.joinable(busy.table.select("trip_id")), "trip_id", "left_semi")
        hot = hot_keys(suspects, ["trip_id"], hot_rows)
    # As many tasks as rows ask for; few rows stay with the session's number.
    tasks = tasks_for(busy.rows)
    paired = next_in_group(visits, "trip_id", sort, "stop", "stop2", hot, tasks if tasks > 1 else None)
    return paired.where("stop2 IS NOT NULL").select("trip_id", F.col("stop").alias("stop1"), "stop2")


def _stop_lists(facts: DataFrame) -> DataFrame | None:
    """``(trip_id, stops)``: the different stops of each trip, sorted; None if a trip has very
    many rows. Repeated stops go before the one shuffle."""
    visits = facts.select("trip_id", "stop").dropna()
    if hot_keys(visits, ["trip_id"]):
        return None
    return visits.groupBy("trip_id").agg(F.array_sort(F.collect_set("stop")).alias("stops"))


def _list_pairs(lists: DataFrame) -> DataFrame:
    """Distinct ``(stop1, stop2)`` that follow each other in a list."""
    first = F.slice("stops", F.lit(1), F.size("stops") - 1)
    pairs = F.arrays_zip(first.alias("stop1"), F.slice("stops", F.lit(2), F.size("stops")).alias("stop2"))
    return lists.select(F.inline(pairs).alias("stop1", "stop2")).distinct()


def precede_edges(facts: DataFrame, order: str | None = None) -> DataFrame:
    """Distinct stop successions over all trips."""
    lists = _stop_lists(facts) if order is None else None
    if lists is not None:
        return _list_pairs(lists)
    return stop_precede(facts, order).select("stop1", "stop2").distinct()


def _tagged(column: str, name: str | None = None):
    prefix = NODE_KINDS[name or column][0]
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def transport_edges(facts: DataFrame) -> DataFrame:
    """All edges between vehicles, trips and stops as ``(src, dst, relation)``.

    Unless a trip has very many rows, the lists of its stops give both its edges to them and
    their succession, by one shuffle.
    """
    lists = _stop_lists(facts)
    if lists is None:
        visits, succession = trip_stop_edges(facts), precede_edges(facts)
    else:
        visits = lists.select("trip_id", F.explode("stops").alias("stop"))
        succession = _list_pairs(lists)
    return (
        vehicle_trip_edges(facts)
        .select(_tagged("vehicle_id").alias("src"), _tagged("trip_id").alias("dst"),
                F.lit(EFFECTUE).alias("relation"))
        .unionByName(
            visits.select(
                _tagged("trip_id").alias("src"), _tagged("stop").alias("dst"),
                F.lit(DESSERT).alias("relation"))
        )
        .unionByName(
            succession.select(
                _tagged("stop1", "stop").alias("src"), _tagged("stop2", "stop").alias("dst"),
                F.lit(PRECEDE).alias("relation"))
        )
    )


def position_relation(facts: DataFrame, vehicles: DataFrame) -> DataFrame:
    """``(src, vehicle_latitude, vehicle_longitude, relation)`` of existing vehicles (a frame of
    vehicle ids) and the positions they moved to; a position is its own key, so merging
    position nodes is keeping each once."""
    found = resolve_edges(position_edges(facts), vehicles, None, src="vehicle_id")
    return found.select(
        _tagged("vehicle_id").alias("src"), "vehicle_latitude", "vehicle_longitude",
        F.lit(SE_DEPLACE_VERS).alias("relation"),
    )


def upsert_nodes(
    existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """Merge ``incoming`` into ``existing`` by ``key``.

    A node that comes in has all its properties set from its last incoming row by
    ``order`` (NULLs included); other existing nodes stay. ``order`` should single out
    one row per key. Both frames need ``key`` and the same properties; ``existing``
    need not have the order columns.
    """
    properties = [name for name in existing.columns if name != key]
    newest = F.struct(F.lit(1).alias("turn"), *[F.col(name).alias(f"o{i}") for i, name in enumerate(order)])
    oldest = F.struct(
        F.lit(0).alias("turn"),
        *[F.lit(None).cast(incoming.schema[name].dataType).alias(f"o{i}") for i, name in enumerate(order)],
    )
    state = F.struct(*properties).alias("state")
    rows = existing.select(key, state, oldest.alias("recency")).unionByName(
        incoming.select(key, state, newest.alias("recency"))
    )
    # max_by keeps one row per key on the map side, whatever the number of updates.
    merged = rows.where(F.col(key).isNotNull()).groupBy(key)
    return merged.agg(F.max_by("state", "recency").alias("state")).select(key, "state.*")


def resolve_edges(
    edges: DataFrame,
    src_ids: DataFrame | None,
    dst_ids: DataFrame | None,
    src: str = "src",
    dst: str = "dst",
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Edges whose endpoints exist. ``src_ids`` / ``dst_ids`` are one-column frames of node
    ids; None leaves that end unchecked."""
    checked = [(ids, column) for ids, column in ((src_ids, src), (dst_ids, dst)) if ids is not None]
    # Looked for in the edges as they come, not in the joined ones.
    hot = {column: hot_keys(edges, [column], hot_rows, hot_share) for _, column in checked}
    for ids, column in checked:
        known = ids.toDF(column).dropna().distinct()
        edges = skew_join(
            edges, known, [column], "left_semi", hot_rows, hot_share,
            unique_right=True, left_hot=hot[column],
        ).select(*edges.columns)
    return edges


def upsert_edges(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Edges of both frames, each once; applying the same frame again changes nothing."""
    return existing.unionByName(incoming).distinct()


def _styled(kind: int):
    """Column expression of one style value, chosen by the id's prefix."""
    chosen = F.when(F.lit(False), F.lit(None))
    for style in NODE_KINDS.values():
        chosen = chosen.when(F.left("id", F.lit(2)) == style[0], F.lit(style[kind]))
    return F.when(F.col("drawn") == 1, chosen)


def assemble_nodes(
    vehicles: DataFrame, trips: DataFrame, stops: DataFrame, edges: DataFrame | None = None
) -> DataFrame:
    """One node per tagged id; endpoints of ``edges`` without a node of their own are added
    with NULL label, colour and size."""
    frames = [
        frame.where(F.col(key).isNotNull()).select(_tagged(key).alias("id"))
        for frame, key in ((vehicles, "vehicle_id"), (trips, "trip_id"), (stops, "stop"))
    ]
    return _drawn(reduce(DataFrame.unionByName, frames), edges)


def assemble_fact_nodes(
    facts: DataFrame, edges: DataFrame | None = None, stop_when: str = "true"
) -> DataFrame:
    """The same nodes from one pass over facts; a fact names its stop only if ``stop_when``."""
    own = F.array(
        _tagged("vehicle_id"), _tagged("trip_id"), F.when(F.expr(stop_when), _tagged("stop"))
    )
    return _drawn(facts.select(F.explode(F.array_compact(own)).alias("id")), edges)


def _drawn(ids: DataFrame, edges: DataFrame | None) -> DataFrame:
    found = ids.withColumn("drawn", F.lit(1))
    if edges is not None:
        found = found.unionByName(
            edges.select(F.explode(F.array("src", "dst")).alias("id"), F.lit(0).alias("drawn"))
        )
    # The style follows from the id, so one flag per id is all that is aggregated.
    nodes = found.groupBy("id").agg(F.max("drawn").alias("drawn"))
    return nodes.select(
        "id",
        F.concat(_styled(1), F.lit(" "), F.substring("id", 3, 2**31 - 1)).alias("label"),
        _styled(2).alias("color"),
        _styled(3).alias("size"),
    )


def assemble_edges(
    vehicle_trip: DataFrame, trip_stop: DataFrame, stop_pairs: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Undirected titled edges, each unordered pair once with the title that came last.

    A pair comes from each frame once or twice, so it is never hot: the rows may be dealt to
    ``tasks`` as they are, before they are merged.
    """
    titles = (EFFECTUE, DESSERT, PRECEDE)
    parts = (
        (vehicle_trip, _tagged("vehicle_id"), _tagged("trip_id")),
        (trip_stop, _tagged("trip_id"), _tagged("stop")),
        (stop_pairs, _tagged("stop1", "stop"), _tagged("stop2", "stop")),
    )
    frames = [
        frame.where(a.isNotNull() & b.isNotNull()).select(
            F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"), F.lit(turn).alias("turn")
        )
        for turn, (frame, a, b) in enumerate(parts)
    ]
    every = reduce(DataFrame.unionByName, frames)
    every = every.repartition(tasks, "src", "dst") if tasks else every
    merged = every.groupBy("src", "dst").agg(F.max("turn").alias("turn"))
    title = F.get(F.array(*map(F.lit, titles)), F.col("turn"))
    return merged.select("src", "dst", title.alias("title"))


def sample_graph(
    vehicles: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    vehicle_trip: DataFrame,
    trip_stop: DataFrame,
    stop_pairs: DataFrame,
    node_sample: int = 300,
    edge_sample: int = 500,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """A tagged graph from a sample of each kind of node and edge."""

    def sampled(frame, size):
        return sample_rows(frame, frame.columns, size, seed)

    edges = assemble_edges(
        sampled(vehicle_trip, edge_sample),
        sampled(trip_stop, edge_sample),
        sampled(stop_pairs, edge_sample),
    )
    nodes = assemble_nodes(
        sampled(vehicles, node_sample), sampled(trips, node_sample), sampled(stops, node_sample), edges
    )
    return nodes, edges


def _matches(frame: DataFrame, prop: str, values: Sequence[str]):
    """The property is set (not NULL, 0, false or empty) and its text is in ``values``."""
    kind = frame.schema[prop].dataType
    value = F.col(prop)
    text = value.cast("string")
    if isinstance(kind, BooleanType):
        there = value
    elif isinstance(kind, NumericType):
        there = value != 0
        text = F.regexp_replace(text, r"\.0$", "")
    else:
        there = value != ""
    return there & text.isin([str(item) for item in values])


def select_subgraph(
    nodes: DataFrame, edges: DataFrame, item: str, prop: str, values: Sequence[str]
) -> DataFrame:
    """Ids of the nodes whose ``prop`` is in ``values``, or, with ``item="edge"``, of both
    ends of the edges whose ``prop`` is."""
    if item == "node":
        return nodes.where(_matches(nodes, prop, values)).select("id").distinct()
    if item == "edge":
        found = edges.where(_matches(edges, prop, values))
        return found.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    raise ValueError(f"item is 'node' or 'edge', not {item!r}")
