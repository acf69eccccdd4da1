"""Visits against plain Python, hot vehicles included."""

import random
from itertools import groupby

import pytest

from tests.conftest import rows
from transitloom.operators import visits


def _plain(positions, max_gap=None):
    found = []
    known = [p for p in positions if p[0] is not None and p[1] is not None]
    known.sort(key=lambda p: (p[0], p[1], p[2] is not None, p[2] or 0))
    for vehicle, own in groupby(known, key=lambda p: p[0]):
        runs = []
        for _, at, stop in own:
            last = runs[-1] if runs else None
            if last and last[0] == stop and (max_gap is None or at - last[2] <= max_gap):
                last[2], last[3] = at, last[3] + 1
            else:
                runs.append([stop, at, at, 1])
        stays = sorted((r for r in runs if r[0] is not None), key=lambda r: (r[1], r[2], r[0]))
        for k, (stop, arrival, departure, n) in enumerate(stays):
            later = [other for other in stays[k + 1 :] if other[0] == stop]
            found.append((
                vehicle, stop, arrival, departure, departure - arrival, n,
                stays[k + 1][0] if k + 1 < len(stays) else None, later[0][1] if later else None))
    return sorted(found, key=repr)


def _positions(seed):
    random_ = random.Random(seed)
    out = [(1, t, random_.choice([1, 1, 1, 2, None])) for t in range(0, 400)]  # a third of all rows and more
    for vehicle in range(2, 12):
        at = 0
        for _ in range(random_.randrange(1, 60)):
            at += random_.choice([0, 1, 1, 30])
            out.append((vehicle, at, random_.choice([1, 1, 2, 3, None])))
    return out + [(3, 5, 1), (3, 5, 1), (None, 1, 1), (4, None, 2), (99, 7, None)]


@pytest.mark.parametrize("max_gap", [None, 10])
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 50, "slice_rows": 7}, {"hot_rows": 2, "slice_rows": 3}])
def test_visits(spark, hot, max_gap):
    given = _positions(1)
    frame = spark.createDataFrame(given, "vehicle_id int, timestamp_seconds bigint, stop int")
    assert rows(visits.stop_visits(frame, max_gap=max_gap, **hot)) == _plain(given, max_gap)


def test_a_visit_over_many_slices_is_one(spark, monkeypatch):
    stays = [(1, t, 5) for t in range(100)] + [(1, 100, 6)]
    frame = spark.createDataFrame(stays, "vehicle_id int, timestamp_seconds bigint, stop int")
    slices = []
    original = visits._joined_at_seams
    monkeypatch.setattr(visits, "_joined_at_seams", lambda islands, gap: slices.append(
        islands.select("slice").distinct().count()) or original(islands, gap))
    found = rows(visits.stop_visits(frame, hot_rows=10, slice_rows=8))
    assert found == [(1, 5, 0, 99, 99, 100, 6, None), (1, 6, 100, 100, 0, 1, None, None)]
    assert slices == [13]  # one vehicle is several tasks' work


def test_no_positions(spark):
    frame = spark.createDataFrame([], "vehicle_id int, timestamp_seconds bigint, stop string")
    assert visits.stop_visits(frame).isEmpty()
