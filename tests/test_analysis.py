"""Graph analysis against plain Python on small graphs, with hubs, chains and cycles."""

import itertools
import math
import random

import pytest

from tests.conftest import rows
from transitloom.operators import analysis, motifs, skew
from transitloom.storage import materialize

# Broadcast and salted joins: the second pair finds hot keys at once and broadcasts nothing.
WAYS = [{}, {"hot_rows": 5, "hot_share": 0.0, "broadcast_rows": 0}]


def _edges(spark, pairs, kind="bigint"):
    return spark.createDataFrame(pairs, f"src {kind}, dst {kind}")


def _hub(n):
    """A node on a third of all edges, in a ring of n nodes with some chords."""
    random_ = random.Random(n)
    ring = [(k, (k + 1) % n) for k in range(n)]
    chords = [(random_.randrange(n), random_.randrange(n)) for _ in range(n)]
    return ring + chords + [(0, k) if k % 2 else (k, 0) for k in range(1, n)]


def _plain_rank(pairs, rounds, seeds=None, damping=0.85, extra=()):
    links = {(a, b) for a, b in pairs if a is not None and b is not None}
    nodes = sorted({end for pair in pairs for end in pair if end is not None} | set(seeds or ()) | set(extra))
    chosen = set(seeds) if seeds else set(nodes)
    start = {node: (node in chosen) / len(chosen) for node in nodes}
    out = {node: [b for a, b in links if a == node] for node in nodes}
    rank = dict(start)
    for _ in range(rounds):
        stuck = sum(rank[node] for node in nodes if not out[node])
        after = {node: start[node] * (1 - damping + damping * stuck) for node in nodes}
        for node in nodes:
            for other in out[node]:
                after[other] += damping * rank[node] / len(out[node])
        rank = after
    return rank


@pytest.mark.parametrize("seeds, way", [(None, WAYS[0]), ([3, 99], WAYS[1])])
def test_pagerank(spark, seeds, way):
    pairs = _hub(24) + [(3, None), (None, 50), (5, 60), (5, 60), (7, 7)]
    chosen = spark.createDataFrame([(node,) for node in seeds], "id bigint") if seeds else None
    found = dict(rows(analysis.pagerank(_edges(spark, pairs), chosen, rounds=4, **way)))
    expected = _plain_rank(pairs, 4, seeds)
    assert set(found) == set(expected)
    assert all(math.isclose(found[node], expected[node], abs_tol=1e-12) for node in found)
    assert math.isclose(sum(found.values()), 1, abs_tol=1e-9)


@pytest.mark.parametrize("seeds", [None, [100, 401, 999]])
@pytest.mark.parametrize("way", WAYS)
def test_pagerank_moves_only_walks(spark, monkeypatch, seeds, way):
    monkeypatch.setattr(skew, "TASK_ROWS", 10)  # several buckets
    stored = []
    monkeypatch.setattr(analysis, "materialize", lambda df, name: stored.append((name, materialize(df, name))) or stored[-1][1])
    # Three links from the outer nodes, one of them a hub, to the inner ring, which alone goes on.
    pairs = [(100 + k, 200 + k) for k in range(40)] + [(100, 200 + k) for k in range(9)] + [(200 + k, 300 + k % 10) for k in range(40)]
    pairs += [(300 + k, 400 + k % 3) for k in range(10)] + [(400, 401), (401, 402), (402, 400), (402, 499)]
    chosen = spark.createDataFrame([(node,) for node in seeds], "id bigint") if seeds else None
    found = dict(rows(analysis.pagerank(_edges(spark, pairs), chosen, rounds=6, **way)))
    expected = _plain_rank(pairs, 6, seeds)
    assert set(found) == set(expected)
    assert all(math.isclose(found[node], expected[node], abs_tol=1e-12) for node in found)
    if not seeds:
        # A round no longer stores each node, but those that a walk of its length reaches.
        walks = [frame.count() for name, frame in stored if name == "walks"]
        assert walks == [54, 14, 4, 4, 4, 4]
        assert [name for name, _ in stored].count("links") == ("hot_rows" in way)  # the hub's own


def test_pagerank_stops_at_its_tolerance(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(analysis, "discard", lambda table: stored.append(table._stored_at))
    found = dict(rows(analysis.pagerank(_edges(spark, _hub(12)), tolerance=1e-5)))
    exact = _plain_rank(_hub(12), 200)
    assert sum(abs(found[node] - exact[node]) for node in exact) < 1e-4
    assert 5 < len(stored) < 60 and len(set(stored)) == len(stored)
    assert analysis.pagerank(_edges(spark, []), rounds=3).isEmpty()


def _plain_components(pairs):
    nodes = {end for pair in pairs for end in pair if end is not None}
    out = {node: {b for a, b in pairs if a == node and b is not None} for node in nodes}
    reach = {}
    for node in nodes:
        seen, todo = {node}, [node]
        while todo:
            for other in out[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        reach[node] = seen
    return {(node, min(other for other in reach[node] if node in reach[other])) for node in nodes}


def _tangle(seed, n, m):
    random_ = random.Random(seed)
    return [(random_.randrange(n), random_.randrange(n)) for _ in range(m)]


GRAPHS = {
    "cycles and chains": [(k, k + 1) for k in range(60)] + [(40, 20)] + [(100 + k, 100 + (k + 1) % 50) for k in range(50)],
    "random": _tangle(1, 40, 60),
    "hub": [(k, 0) if k % 3 else (0, k) for k in range(1, 60)] + [(3, 4), (4, 8)],
    "odd ends": [(1, None), (None, 2), (None, None), (3, 3), (4, 5), (5, 4), (5, 4)],
    "dag": [(a, b) for a, b in itertools.combinations(range(14), 2)],
}


def _side_by_side():
    """All graphs as one, their nodes apart."""
    return [
        tuple(None if end is None else 1000 * k + end for end in pair)
        for k, pairs in enumerate(GRAPHS.values()) for pair in pairs
    ]


def test_strong_components_of_names(spark):
    pairs = [tuple(None if end is None else f"n{end}" for end in pair) for pair in _side_by_side()]
    found = analysis.strong_components(_edges(spark, pairs, "string"))
    assert rows(found) == sorted(_plain_components(pairs), key=repr)


def test_strong_components_of_numbers_with_hot_nodes(spark):
    pairs = GRAPHS["hub"] + GRAPHS["odd ends"]
    found = analysis.strong_components(_edges(spark, pairs), **WAYS[1])
    assert rows(found) == sorted(_plain_components(pairs), key=repr)


def test_a_long_cycle_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(
        analysis, "materialize", lambda df, name: rounds.append(name) or materialize(df, name))
    n = 256
    order = list(range(n))
    random.Random(3).shuffle(order)
    pairs = list(zip(order, order[1:] + order[:1]))
    found = analysis.strong_components(_edges(spark, pairs))
    assert {row["component"] for row in found.collect()} == {0}
    assert rounds.count("taken") < 40  # n rounds without the labels' labels


def _plain_distances(weighted, seeds):
    best = dict.fromkeys(seeds, 0)
    for _ in range(len(weighted) + 1):
        for a, b, weight in weighted:
            if a in best and weight is not None and best[a] + weight < best.get(b, math.inf):
                best[b] = best[a] + weight
    return best


@pytest.mark.parametrize("delta, way", [(None, WAYS[0]), (4, WAYS[0]), (1000, WAYS[0]), (15, WAYS[1])])
def test_shortest_paths(spark, delta, way):
    random_ = random.Random(9)
    weighted = [(a, b, random_.choice([0, 1, 2, 3, 10, 12])) for a, b in _hub(20) + _tangle(4, 25, 25)]
    weighted += [(200, 201, 1), (1, 2, None)]
    frame = spark.createDataFrame(weighted, "src bigint, dst bigint, weight bigint")
    seeds = spark.createDataFrame([(5,), (5,), (300,), (None,)], "id bigint")
    found = dict(rows(analysis.shortest_paths(frame, seeds, delta, **way)))
    assert found == _plain_distances(weighted, [5, 300])


def test_rounds_follow_from_weights(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(
        analysis, "materialize", lambda df, name: rounds.append(name) or materialize(df, name))
    # 200 nodes in a star of short ways: as many rounds as for 20.
    star = [(0, k, 1.5) for k in range(1, 200)] + [(k, k + 200, 100.25) for k in range(1, 200)]
    frame = spark.createDataFrame(star, "src bigint, dst bigint, weight double")
    seeds = spark.createDataFrame([(0,)], "id bigint")
    found = dict(rows(analysis.shortest_paths(frame, seeds, delta=50.0)))
    assert len(found) == 399 and found[250] == 101.75
    assert rounds.count("distances") < 10
    with pytest.raises(ValueError, match="negative"):
        analysis.shortest_paths(spark.createDataFrame([(1, 2, -1)], "src bigint, dst bigint, weight int"), seeds)
    nothing = spark.createDataFrame([], "src bigint, dst bigint, weight int")
    assert rows(analysis.shortest_paths(nothing, seeds)) == [(0, 0)]


def test_travel_times(spark):
    trips = spark.createDataFrame(
        [("t", [("a", 10), ("b", 40), ("c", None), ("d", 90), ("e", 80), ("f", 81)]), ("u", [("a", 5), ("b", 20)]),
         ("v", []), ("w", None), ("x", [("z", 1)])],
        "trip_id string, stop_time_updates array<struct<stop_id:string,arrival_time:bigint>>")
    assert rows(analysis.travel_times(trips)) == [("a", "b", 15), ("e", "f", 1)]


@pytest.mark.parametrize("links, way", [(1000, WAYS[0]), (2, WAYS[1])])
def test_triangles(spark, links, way):
    pairs = _hub(25) + [(1, None), (4, 4), (70, 71)]
    found = analysis.triangles(_edges(spark, pairs), wedge_links=links, **way)
    plain = {frozenset(pair) for pair in pairs if None not in pair and pair[0] != pair[1]}
    nodes = sorted(set().union(*plain))
    expected = []
    for node in nodes:
        near = [other for other in nodes if frozenset((node, other)) in plain]
        closed = sum(frozenset(pair) in plain for pair in itertools.combinations(near, 2))
        pairs_of = len(near) * (len(near) - 1)
        expected.append((node, len(near), closed, 2 * closed / pairs_of if pairs_of else None))
    assert rows(found) == sorted(expected, key=repr)


def test_a_hub_is_many_keys(spark):
    pairs = [(0, k) for k in range(1, 200)] + [(k, k + 1) for k in range(1, 199)]
    stored = {}
    original = analysis.materialize

    def watched(df, name):
        stored[name] = original(df, name)
        return stored[name]

    analysis.materialize = watched
    try:
        analysis.triangles(_edges(spark, pairs + [(a, b) for a, b in itertools.combinations(range(300, 330), 2)]), wedge_links=4)
    finally:
        analysis.materialize = original
    pieces = stored["directed"].groupBy("src", "piece").count().agg({"count": "max"}).first()[0]
    assert pieces <= 4
    assert stored["directed"].where("src = 0").count() == 0  # the hub's links lead to it


def test_wedges_travel_as_pieces_of_numbers(spark, monkeypatch):
    stored = {}
    original = analysis.materialize
    monkeypatch.setattr(analysis, "materialize", lambda df, name: stored.setdefault(name, original(df, name)))
    pairs = [("hub", f"n{k}") for k in range(60)] + [(f"n{k}", f"n{k + 1}") for k in range(59)]
    pairs += [(f"c{a}", f"c{b}") for a, b in itertools.combinations(range(12), 2)]
    found = analysis.triangles(_edges(spark, pairs, "string"), wedge_links=5)
    assert dict(stored["directed"].dtypes)["dst"] == "bigint"  # not the names
    hub = stored["numbers"].where("id = 'hub'").first()["number"]
    assert stored["directed"].where(f"src = {hub}").count() == 0
    assert stored["pieces"].selectExpr("max(size(ends)) AS most").first()["most"] == 5
    counted = dict(rows(found, "id", "triangles"))
    assert counted["hub"] == 59 and counted["n0"] == 1 and counted["n5"] == 2
    assert all(counted[f"c{k}"] == 11 * 10 // 2 for k in range(12))


def test_motifs(spark):
    runs = _edges(spark, [("v1", "t1"), ("v1", "t2"), ("v2", "t3"), ("v2", "t3"), (None, "t1"), ("v3", "t2")], "string")
    hops = _edges(spark, [("t1", "a>b"), ("t2", "b>a"), ("t3", "a>b"), ("t3", "c>d"), ("t2", "x>x")], "string")
    back = _edges(spark, [("a>b", "b>a"), ("b>a", "a>b"), ("c>d", "d>c"), ("x>x", "x>x")], "string")
    relations = {"RUNS": runs, "HOP": hops, "BACK": back}
    opposite = [("v", "RUNS", "t1"), ("v", "RUNS", "t2"), ("t1", "HOP", "p"), ("t2", "HOP", "q"), ("p", "BACK", "q")]
    for hot_rows in (1_000_000, 1):
        found = motifs.find_motifs(relations, opposite, [("t1", "t2")], [("p", "q")], hot_rows, 0.0)
        assert found.columns == ["v", "t1", "t2", "p", "q"]
        assert rows(found) == [("v1", "t1", "t2", "a>b", "b>a")]
    assert rows(motifs.find_motifs(relations, [("x", "BACK", "x")])) == [("x>x",)]
    shared = motifs.find_motifs(relations, [("t", "HOP", "p"), ("u", "HOP", "p")], different=[("t", "u")])
    assert rows(shared) == [("t1", "a>b", "t3"), ("t3", "a>b", "t1")]
    with pytest.raises(ValueError, match="share no node"):
        motifs.find_motifs(relations, [("a", "RUNS", "b"), ("c", "HOP", "d")])


def test_motif_searches_share_tables(spark, monkeypatch):
    names = []
    monkeypatch.setattr(motifs, "materialize", lambda df, name: names.append(name) or materialize(df, name))
    runs = [(k % 7, k) for k in range(120)] + [(3, None), (5, 10), (5, 10)]
    hops = [(k, k * k % 11) for k in range(5, 60)] + [(k, k % 4) for k in range(30)]
    relations = motifs.stored_relations({"RUNS": _edges(spark, runs), "HOP": _edges(spark, hops)})
    pattern = [("v1", "RUNS", "t1"), ("t1", "HOP", "p"), ("t2", "HOP", "p"), ("v2", "RUNS", "t2")]
    found = motifs.find_motifs(relations, pattern, different=[("v1", "v2")], ordered=[("t1", "t2")])
    runs = {pair for pair in runs if pair[1] is not None}
    expected = [
        (v, t, p, u, w) for v, t in runs for s, p in set(hops) if s == t
        for u, q in set(hops) if q == p and t < u for w, x in runs if x == u and v != w
    ]
    assert rows(found, "v1", "t1", "p", "t2", "v2") == sorted(expected, key=repr) and expected
    # Both halves of the pattern keep the same edges; the relations stay for the next search.
    assert names.count("relation") == 2 and names.count("reduced") == 2
    assert found.count() == motifs.find_motifs(relations, pattern, [("v1", "v2")], [("t1", "t2")]).count()


def test_motifs_of_random_graphs(spark):
    pairs = sorted(set(_tangle(8, 12, 40)))
    edges = _edges(spark, pairs)
    pattern = [("a", "E", "b"), ("b", "E", "c"), ("a", "E", "d"), ("d", "E", "c")]
    found = motifs.find_motifs({"E": edges}, pattern, different=[("b", "d"), ("a", "c")])
    known = set(pairs)
    expected = {
        (a, b, c, d)
        for a, b in known for c in range(12) if (b, c) in known
        for d in range(12) if (a, d) in known and (d, c) in known and b != d and a != c
    }
    assert rows(found, "a", "b", "c", "d") == sorted(expected, key=repr)
