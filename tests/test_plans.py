"""Physical plans of queries that read or shuffle a lot: scans, aggregates, carried columns."""

import pytest

from tests.conftest import rows
from transitloom.operators import graph, skew, traversal
from transitloom.plans.queries import all_queries
from transitloom.storage import materialize

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["graph_assemble", "weather_enrich", "trip_sync_issues"])
def test_tables_are_scanned_few_times(spark, name):
    assert _plan(all_queries()[name](spark, SF)).count("FileScan") <= 3


def test_ids_of_both_ends_come_from_one_stored_set(spark):
    plan = _plan(all_queries()["graph_edges_resolved"](spark, SF))
    assert not any(f"{table}.parquet" in plan for table in ("supplier", "orders", "part"))


def test_no_row_of_a_planned_stop_carries_its_trip(spark):
    plan = _plan(all_queries()["trip_sync_issues"](spark, SF))
    above, generated, _ = plan.partition("Generate posexplode")
    assert generated and "stop_time_updates" not in above


def test_rounds_of_components_compare_longs(spark, monkeypatch):
    plans = []

    def watched(df, name):
        plans.append((name, _plan(df)))
        return materialize(df, name)

    monkeypatch.setattr(traversal, "materialize", watched)
    edges = spark.createDataFrame(
        [("d", "c"), ("c", "b"), ("x", None), (None, "y"), ("z", "z"), ("B", "a"), (None, None)],
        "src string, dst string",
    )
    found = traversal.connected_components(edges)
    assert sorted(map(tuple, found.collect())) == [
        ("B", "B"), ("a", "B"), ("b", "b"), ("c", "b"), ("d", "b"), ("x", "x"), ("y", "y"), ("z", "z"),
    ]
    assert [plan for name, plan in plans if name == "choice"]
    assert not any("SortAggregate" in plan for _, plan in plans)


def test_inputs_of_the_trip_join_are_parsed_once(spark):
    # Both sides are read from the few columns that were stored of them.
    plan = _plan(all_queries()["trip_vehicle_join"](spark, SF))
    assert "events.parquet" not in plan and plan.count("join-side") >= 2


def test_links_are_not_shuffled_for_a_short_frontier(spark, monkeypatch):
    plans = []

    def watched(df, name):
        plans.append(_plan(df))
        return materialize(df, name)

    edges = materialize(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "src bigint, dst bigint"), "edges")
    monkeypatch.setattr(traversal, "materialize", watched)
    seeds = spark.createDataFrame([(1,)], "id bigint")
    assert traversal.neighborhood(edges, seeds, 2).count() == 3
    assert len(plans) == 3 and all("BroadcastHashJoin [src" in plan for plan in plans[1:])


def test_different_stops_are_stored_once_for_hot_trips(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(graph, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    facts = spark.createDataFrame(
        [("t", k % 50, k) for k in range(200)] + [("u", 1, 1), ("u", 2, 2)], "trip_id string, stop int, seen int")
    found = graph.stop_precede(facts, hot_rows=20)
    assert stored == ["visits"] and found.count() == 50
    plan = _plan(found)
    assert "Scan ExistingRDD[trip_id" not in plan  # nothing reads the facts again
    assert graph.stop_precede(facts).count() == 50 and stored == ["visits"]


def test_stops_and_their_succession_take_one_shuffle(spark, monkeypatch):
    facts = spark.createDataFrame(
        [(k % 7, k % 40 if k % 9 else None, k * k % 31 if k % 5 else None) for k in range(600)] + [(1, 1, 1)] * 9,
        "vehicle_id bigint, trip_id bigint, stop bigint")
    found = graph.transport_edges(facts)
    plan = _plan(found)
    assert "hashpartitioning(trip_id, stop" not in plan.replace("#", "").translate(str.maketrans("", "", "0123456789L"))
    assert "Window" not in plan and "Window" not in _plan(graph.precede_edges(facts))
    pairs = graph.stop_precede(facts).select("stop1", "stop2").distinct()
    assert rows(graph.precede_edges(facts)) == rows(pairs) and pairs.count() > 30
    monkeypatch.setattr(graph, "_stop_lists", lambda facts: None)  # as for hot trips
    assert rows(found) == rows(graph.transport_edges(facts))


def test_tasks_follow_from_counted_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    facts = spark.createDataFrame(
        [(k % 7, k % 40, k % 60) for k in range(1100)], "vehicle_id bigint, trip_id bigint, stop bigint")
    assert "hashpartitioning(trip_id" in _plan(graph.stop_precede(facts)) and ", 11)" in _plan(graph.stop_precede(facts))
    edges = materialize(graph.transport_edges(facts), "edges")
    dealt = -(-edges.count() // 100)
    found = traversal.degrees(edges)
    assert f", {dealt})" in _plan(found)
    out = dict(rows(edges.groupBy("src").count()))
    assert {row["id"]: row["out_degree"] for row in found.collect() if row["out_degree"]} == out
    edges = [graph.vehicle_trip_edges(facts), graph.trip_stop_edges(facts), graph.precede_edges(facts)]
    assert ", 23)" in _plan(graph.assemble_edges(*edges, tasks=23))
    assert rows(graph.assemble_edges(*edges, tasks=23)) == rows(graph.assemble_edges(*edges))
