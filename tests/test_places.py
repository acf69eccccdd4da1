"""The nearest stop against every pair."""

import math
import random
import re

import pytest

from tests.conftest import rows
from transitloom.operators import places

POSITIONS = "id int, latitude double, longitude double"
STOPS = "stop int, latitude double, longitude double"


def _plane(latitude, longitude, around):
    return longitude * (111_320.0 * math.cos(math.radians(around))), latitude * 111_320.0


def _plain(positions, stops, around):
    known = [(stop, *_plane(a, b, around)) for stop, a, b in stops if None not in (stop, a, b)]
    out = []
    for key, latitude, longitude in positions:
        if None in (latitude, longitude) or not known:
            out.append((key, latitude, longitude, None, None))
            continue
        x, y = _plane(latitude, longitude, around)
        square, stop = min(((sx - x) * (sx - x) + (sy - y) * (sy - y), stop) for stop, sx, sy in known)
        out.append((key, latitude, longitude, stop, math.sqrt(square)))
    return sorted(out, key=repr)


def _check(spark, positions, stops, around=60.0, **options):
    found = places.nearest_stop(
        spark.createDataFrame(positions, POSITIONS), spark.createDataFrame(stops, STOPS), around, **options)
    assert rows(found) == _plain(positions, stops, around)


@pytest.mark.parametrize("options", [
    {}, {"cell": 20_000.0, "kept_stops": 12, "hot_rows": 5, "hot_share": 0.0, "broadcast_rows": 0},
])
def test_nearest_stop(spark, options):
    random_ = random.Random(3)
    # A dense town, a few stops far away, and positions between, some at one place.
    stops = [(k, 60 + random_.random() / 50, 24 + random_.random() / 50) for k in range(120)]
    stops += [(200 + k, 60 + random_.uniform(-3, 3), 24 + random_.uniform(-5, 5)) for k in range(6)]
    stops += [(500, *stops[0][1:]), (-1, *stops[1][1:]), (7, 61.0, 25.0), (None, 60.0, 24.0), (8, None, 24.0)]
    positions = [(k, 60 + random_.uniform(-1, 1), 24 + random_.uniform(-1, 1)) for k in range(80)]
    positions += [(1000 + k, 60 + random_.random() / 50, 24 + random_.random() / 50) for k in range(80)]
    positions += [(2000 + k, 60.01, 24.01) for k in range(60)] + [(3000, *stops[0][1:]), (1, None, 24.0), (2, 60.0, None)]
    _check(spark, positions, stops, **options)


def test_both_sides_of_the_axes_and_ties(spark):
    stops = [(1, 0.001, 0.0), (2, -0.001, 0.0), (3, 0.0, 90.0), (4, -45.0, -170.0)]
    positions = [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, -40.0, -100.0), (4, 10.0, 80.0), (5, -0.002, -0.001)]
    _check(spark, positions, stops, around=0.0, kept_stops=3, cell=100_000.0)
    _check(spark, positions, [(9, 5.0, 5.0)] * 3, around=0.0)


def test_no_stops_and_no_positions(spark):
    _check(spark, [(1, 60.0, 24.0), (2, None, None)], [])
    _check(spark, [], [(1, 60.0, 24.0)])
    _check(spark, [(1, None, 3.0)], [(1, 60.0, 24.0)])


def test_a_cell_measures_its_stops_once(spark):
    stops = [(float(k), float(k % 7), k) for k in range(300)]
    cells = spark.createDataFrame([(0, 0, stops)], "cx bigint, cy bigint, stops array<struct<u:double,v:double,stop:int>>")
    kept = places._kept(cells, 10.0)
    # Not for each stop the least bar of all of them.
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" in plan and not re.search(r"filter\(.*array_min", plan)
    corners = [(x, y) for x in (0.0, 10.0) for y in (0.0, 10.0)]
    bar = min(max(math.hypot(u - x, v - y) for x, y in corners) for u, v, _ in stops)
    near = [s for s in stops if math.hypot(max(s[0] - 10, -s[0], 0), max(s[1] - 10, -s[1], 0)) <= bar]
    assert [tuple(stop) for stop in kept.first()["stops"]] == near
