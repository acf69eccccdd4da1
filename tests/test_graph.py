import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from transitloom.operators import graph, traversal
from transitloom.plans import graph_tables, testdata
from transitloom.schemas import STOP_PRECEDE_EDGES
from transitloom.sources.files import read_if_exists

SF = "/root/testdata/sf0.001"
FACTS = "vehicle_id int, trip_id string, stop int, seen int, speed double"


def _edges(spark, pairs):
    return spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "src string, dst string")


def test_succession_by_stop_and_by_time(spark):
    facts = spark.createDataFrame(
        [(1, "t", 3, 10, 0.0), (1, "t", 1, 30, 0.0), (1, "t", 2, 20, 0.0), (1, "t", 3, 40, 0.0),
         (1, None, 9, 1, 0.0), (1, "u", None, 1, 0.0), (1, "w", 5, 1, 0.0)], FACTS)
    assert rows(graph.stop_precede(facts)) == [("t", 1, 2), ("t", 2, 3)]
    assert rows(graph.stop_precede(facts, order="seen")) == [("t", 2, 1), ("t", 3, 2)]


def test_succession_of_nothing_keeps_its_columns(spark):
    empty = graph.precede_edges(spark.createDataFrame([], FACTS))
    assert empty.columns == ["stop1", "stop2"] and empty.isEmpty()


def test_node_upsert_is_idempotent_and_last_row_wins(spark):
    schema = "id int, kind string, speed double"
    existing = spark.createDataFrame([(1, "old", 1.0), (2, "old", 2.0)], schema)
    incoming = spark.createDataFrame(
        [(2, "new", None, 5), (2, "older", 9.0, 4), (3, "new", 3.0, 1), (None, "x", 0.0, 9)],
        schema + ", seen int")
    once = graph.upsert_nodes(existing, incoming, "id", ["seen"])
    assert rows(once) == [(1, "old", 1.0), (2, "new", None), (3, "new", 3.0)]
    assert rows(graph.upsert_nodes(once, incoming, "id", ["seen"])) == rows(once)


@pytest.mark.parametrize("hot_rows", [1_000_000, 4])
def test_edges_need_both_endpoints(spark, hot_rows):
    edges = _edges(spark, [("a", "b"), ("a", "x"), ("y", "b"), (None, "b")] + [("a", "c")] * 20)
    ids = _edges(spark, [("a", "b"), ("c", "d")]).select(F.explode(F.array("src", "dst")))
    found = graph.resolve_edges(edges, ids, ids, hot_rows=hot_rows, hot_share=1 / 100)
    assert rows(found.distinct()) == [("a", "b"), ("a", "c")]
    assert found.count() == 21
    only_source = graph.resolve_edges(edges, ids, None, hot_rows=hot_rows)
    assert rows(only_source.distinct()) == [("a", "b"), ("a", "c"), ("a", "x")]
    once = graph.upsert_edges(edges, found)
    assert rows(graph.upsert_edges(once, found)) == rows(once)


def test_assembled_graph(spark):
    vehicles = spark.createDataFrame([(1,), (1,), (2,)], "vehicle_id int")
    trips = spark.createDataFrame([("t",)], "trip_id string")
    stops = spark.createDataFrame([(5,)], "stop int")
    edges = graph.assemble_edges(
        spark.createDataFrame([(1, "t"), (3, "t")], "vehicle_id int, trip_id string"),
        spark.createDataFrame([("t", 5)], "trip_id string, stop int"),
        spark.createDataFrame([(5, 6), (6, 5)], "stop1 int, stop2 int"),
    )
    assert rows(edges) == [
        ("S_5", "S_6", "PRECEDE"), ("S_5", "T_t", "DESSERT"), ("T_t", "V_1", "EFFECTUE"),
        ("T_t", "V_3", "EFFECTUE"),
    ]
    assert rows(graph.assemble_nodes(vehicles, trips, stops, edges)) == [
        ("S_5", "Stop 5", "red", 6), ("S_6", None, None, None), ("T_t", "Trip t", "green", 8),
        ("V_1", "Vehicle 1", "blue", 10), ("V_2", "Vehicle 2", "blue", 10), ("V_3", None, None, None),
    ]


def test_selection_ignores_unset_values(spark):
    nodes = spark.createDataFrame(
        [("a", 0, ""), ("b", 5, "x"), ("c", None, None)], "id string, size int, kind string")
    edges = spark.createDataFrame([("a", "b", "R"), ("b", "c", "Q")], "src string, dst string, rel string")
    assert rows(graph.select_subgraph(nodes, edges, "node", "size", ["0", "5"])) == [("b",)]
    assert rows(graph.select_subgraph(nodes, edges, "node", "kind", ["", "x"])) == [("b",)]
    assert rows(graph.select_subgraph(nodes, edges, "edge", "rel", ["R"])) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        graph.select_subgraph(nodes, edges, "label", "rel", ["R"])


def _random_pairs(seed, nodes=120, count=110):
    draw = random.Random(seed)
    pairs = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(count)]
    return pairs + [(500, other) for other in range(40)]


def _components(pairs):
    label = {str(node): str(node) for pair in pairs for node in pair}
    while True:
        changed = False
        for a, b in pairs:
            low = min(label[str(a)], label[str(b)])
            for node in (str(a), str(b)):
                if label[node] != low:
                    label[node], changed = low, True
        if not changed:
            return sorted(label.items(), key=repr)


@pytest.mark.parametrize("hot_rows", [1_000_000, 10])
def test_components_against_brute_force(spark, hot_rows):
    pairs = _random_pairs(1) + [(600, 600)] + [(700 + i, 701 + i) for i in range(30)]
    found = traversal.connected_components(_edges(spark, pairs), hot_rows, 1 / 100)
    assert rows(found) == _components(pairs)


@pytest.mark.parametrize("hot_rows, broadcast_rows", [(1_000_000, 1_000_000), (1_000_000, 0), (10, 0)])
@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_neighbourhood_against_brute_force(spark, k, hot_rows, broadcast_rows):
    pairs = _random_pairs(2)
    near = {"3": 0, "500": 0}
    for hop in range(1, k + 1):
        for a, b in pairs:
            for x, y in ((str(a), str(b)), (str(b), str(a))):
                if near.get(x, k) < hop:
                    near.setdefault(y, hop)
    seeds = spark.createDataFrame([("3",), ("500",), ("500",), (None,)], "id string")
    found = traversal.neighborhood(_edges(spark, pairs), seeds, k, hot_rows, 1 / 100, broadcast_rows)
    assert rows(found) == sorted(near.items(), key=repr)


def test_degrees_add_up(spark):
    edges = _edges(spark, _random_pairs(4))
    total = traversal.degrees(edges).agg(F.sum("out_degree"), F.sum("in_degree"), F.sum("degree")).first()
    assert tuple(total) == (150, 150, 300)


def test_edges_read_only_their_columns(spark):
    plan = graph.trip_stop_edges(testdata.graph_facts(spark, SF))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_discount:double>" in plan


def test_export_skips_empty_frames_and_reading_tolerates_them(spark, tmp_path):
    facts = testdata.graph_facts(spark, SF).where("stop IS NULL")
    written = graph_tables.export_graph(facts, str(tmp_path))
    assert "nodes_vehicles" in written and "nodes_stops" not in written
    missing = read_if_exists(spark, f"{tmp_path}/edges_stop_precede.csv", STOP_PRECEDE_EDGES)
    assert missing.schema == STOP_PRECEDE_EDGES and missing.isEmpty()


def test_resolved_edges_of_complete_facts_are_all_edges(spark):
    facts = testdata.graph_facts(spark, SF)
    assert rows(graph_tables.resolved_edges(facts)) == rows(graph.transport_edges(facts))
