"""The nearest stop of a position, on a plane grid.

Positions are many, the cells they lie in few. So stops are looked for per cell: a cell keeps
every stop that may be the nearest one of some point in it. Cells of stops are opened level by
level, from one that holds them all down to single stops; a cell of stops is dropped when
another one is nearer to all of the positions' cell. Nothing nearer is ever dropped, however
far it lies. A cell that keeps many stops is split, and with it what it keeps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitloom.operators.skew import BROADCAST_ROWS, HOT_ROWS, HOT_SHARE, hot_keys, skew_join
from transitloom.storage import materialize

CELL_METRES = 250.0
KEPT_STOPS = 32
_METRES_A_DEGREE = 111_320.0
_MOST_SPLITS = 24
_STEP = 8


def _on_plane(latitude: Column, longitude: Column, around: float) -> tuple[Column, Column]:
    """Metres east and north on a plane that is true at the latitude ``around``."""
    east = _METRES_A_DEGREE * math.cos(math.radians(around))
    return longitude * F.lit(east), latitude * F.lit(_METRES_A_DEGREE)


def _bounds(x: Column, y: Column, size: float, low_x: Column, low_y: Column, width: float):
    """Squares of the least and the largest distance between two square cells, given their low
    corners and sizes."""
    gaps = [
        F.greatest(low - (own + F.lit(size)), own - (low + F.lit(width)), F.lit(0.0))
        for own, low in ((x, low_x), (y, low_y))
    ]
    spans = [
        F.greatest((low + F.lit(width)) - own, (own + F.lit(size)) - low)
        for own, low in ((x, low_x), (y, low_y))
    ]
    return gaps[0] * gaps[0] + gaps[1] * gaps[1], spans[0] * spans[0] + spans[1] * spans[1]


def _near_enough(least: Column, bar: Column) -> Column:
    """Not beyond the bar; rounding must not drop a stop that is as near as another."""
    return least <= bar * F.lit(1 + 1e-9) + F.lit(1e-6)


def _kept(cells: DataFrame, size: float) -> DataFrame:
    """Of the stops each cell ``cx, cy`` keeps, those that may be nearest to a point in it."""
    x, y = F.col("cx") * F.lit(size), F.col("cy") * F.lit(size)

    def bounded(stop):
        least, largest = _bounds(x, y, size, stop["u"], stop["v"], 0.0)
        return F.struct(least.alias("least"), largest.alias("largest"), stop.alias("stop"))

    def near(bounds):
        bar = F.array_min(F.transform(bounds, lambda one: one["largest"]))
        return _with(bar, lambda bar: F.filter(bounds, lambda one: _near_enough(one["least"], bar)))

    kept = _with(F.transform("stops", bounded), near)
    return cells.withColumn("stops", F.transform(kept, lambda one: one["stop"]))


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once. As a column of its own it would be put into the
    function that uses it, and computed anew for each element of an array."""
    return F.transform(F.array(value), use)[0]


def _first_kept(
    cells: DataFrame, stops: DataFrame, size: float, kept_stops: int, broadcast_rows: int
) -> DataFrame:
    """``cx, cy, stops``: cells with what they keep, by opening cells of stops from the top.

    ``stops`` have corner coordinates ``u, v`` from 0 up; one cell holds them all. Every round
    opens cells into those of an eighth of their width.
    """
    seen = stops.agg(F.count("*").alias("n"), F.max(F.greatest("u", "v")).alias("far")).first()
    if seen["n"] <= kept_stops:
        few = [F.struct(*[F.lit(row[name]).alias(name) for name in stops.columns]) for row in stops.collect()]
        return _kept(cells.withColumn("stops", F.array(*few)), size)
    rounds = 0
    while size * _STEP**rounds <= seen["far"]:
        rounds += 1
    frontier = cells.select("cx", "cy", *[F.lit(0).cast("bigint").alias(name) for name in ("sx", "sy")])
    for level in range(rounds - 1, -1, -1):
        width = size * _STEP**level
        below = [F.floor(F.col(axis) / F.lit(width)).alias(name) for axis, name in (("u", "kx"), ("v", "ky"))]
        children = stops.select(*below).distinct()
        children = children.groupBy(
            F.floor(F.col("kx") / _STEP).alias("sx"), F.floor(F.col("ky") / _STEP).alias("sy")
        ).agg(F.collect_list(F.struct("kx", "ky")).alias("inside"))  # 64 at most
        children = materialize(children, "children")
        opened = _opened(frontier, children, ["sx", "sy"], broadcast_rows)
        opened = opened.select("cx", "cy", F.explode("inside").alias("at")).select("cx", "cy", "at.*")
        x, y = F.col("cx") * F.lit(size), F.col("cy") * F.lit(size)
        least, largest = _bounds(
            x, y, size, F.col("kx") * F.lit(width), F.col("ky") * F.lit(width), width
        )
        judged = opened.withColumns({"least": least, "largest": largest})
        kept = judged.groupBy("cx", "cy").agg(
            F.min("largest").alias("bar"), F.collect_list(F.struct("least", "kx", "ky")).alias("all")
        )
        near = F.filter("all", lambda one: _near_enough(one["least"], F.col("bar")))
        frontier = materialize(
            kept.select("cx", "cy", F.explode(near).alias("at")).select(
                "cx", "cy", F.col("at.kx").alias("sx"), F.col("at.ky").alias("sy")), "frontier")
    inside = stops.groupBy(
        F.floor(F.col("u") / F.lit(size)).alias("sx"), F.floor(F.col("v") / F.lit(size)).alias("sy")
    ).agg(F.collect_list(F.struct(*stops.columns)).alias("stops"))
    met = _opened(frontier, materialize(inside, "stops"), ["sx", "sy"], broadcast_rows)
    whole = met.groupBy("cx", "cy").agg(F.flatten(F.collect_list("stops")).alias("stops"))
    return _kept(whole, size)


def _opened(frontier: DataFrame, table: DataFrame, keys: list[str], broadcast_rows: int) -> DataFrame:
    if table.count() <= broadcast_rows:
        return frontier.join(F.broadcast(table), keys)
    return skew_join(frontier, table, keys, "inner", unique_right=True)


def nearest_stop(
    positions: DataFrame,
    stops: DataFrame,
    around: float,
    latitude: str = "latitude",
    longitude: str = "longitude",
    cell: float = CELL_METRES,
    kept_stops: int = KEPT_STOPS,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``positions`` with ``nearest_stop`` and ``distance`` in metres, the smallest stop of several.

    ``stops`` holds ``stop, latitude, longitude``; a stop may have several places. Distances are
    those on a plane that is true at the latitude ``around``. Positions without a place, and all
    of them if there are no stops, get NULL. There is no largest distance.

    ``cell`` and ``kept_stops`` change how the work is divided, not the result: cells that keep
    more stops are split in four, again and again. A cell with very many positions is salted.
    """
    sx, sy = _on_plane(F.col("latitude"), F.col("longitude"), around)
    placed = stops.dropna(subset=["stop", "latitude", "longitude"])
    # Of stops at one place only the smallest can be the answer.
    placed = placed.select("stop", sx.alias("x"), sy.alias("y")).groupBy("x", "y").agg(F.min("stop").alias("stop"))
    placed = materialize(placed, "places")
    corner = placed.agg(F.min("x").alias("x"), F.min("y").alias("y")).first()
    px, py = _on_plane(F.col(latitude).cast("double"), F.col(longitude).cast("double"), around)
    names = positions.columns
    rows = positions.withColumns({"_x": px, "_y": py})
    blank = [
        F.lit(None).cast(placed.schema["stop"].dataType).alias("nearest_stop"),
        F.lit(None).cast("double").alias("distance"),
    ]
    if corner["x"] is None:
        return positions.select("*", *blank)
    # Cells count from the corner of all stops; distances are taken between true coordinates.
    offsets = {"u": F.col("x") - F.lit(corner["x"]), "v": F.col("y") - F.lit(corner["y"])}
    placed = placed.withColumns(offsets)
    rows = materialize(rows, "positions")  # read once for its cells, and once for each size of cell
    where = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    nowhere = rows.where(~where).select(*names, *blank)
    parts, left, size = [], rows.where(where), cell
    open_cells = None
    for depth in range(_MOST_SPLITS + 1):
        code = {
            name: F.floor((F.col(f"_{axis}") - F.lit(corner[axis])) / F.lit(size))
            for axis, name in (("x", "cx"), ("y", "cy"))
        }
        coded = left.withColumns(code)
        cells = coded.select("cx", "cy").distinct()
        if open_cells is None:
            kept = _first_kept(cells, placed, size, kept_stops, broadcast_rows)
        else:
            above = open_cells.select(F.col("cx").alias("ux"), F.col("cy").alias("uy"), "stops")
            split = cells.withColumns({"ux": F.floor(F.col("cx") / 2), "uy": F.floor(F.col("cy") / 2)})
            kept = _kept(split.join(above, ["ux", "uy"]).select("cx", "cy", "stops"), size)
        kept = materialize(kept, "kept")
        many = (F.size("stops") > kept_stops) if depth < _MOST_SPLITS else F.lit(False)
        parts.append(_answered(coded, kept.where(~many), names, hot_rows, hot_share, broadcast_rows))
        open_cells = kept.where(many)
        if open_cells.isEmpty():
            break
        crowded = open_cells.select("cx", "cy")
        left = skew_join(
            coded, crowded, ["cx", "cy"], "left_semi", hot_rows, hot_share, unique_right=True
        ).select(*names, "_x", "_y")
        size /= 2
    found = nowhere
    for part in parts:
        found = found.unionByName(part)
    return found


def _answered(coded, cells, names, hot_rows, hot_share, broadcast_rows):
    """Positions of ``cells`` with the nearest of the stops their cell keeps."""
    number = cells.agg(F.sum(F.size("stops"))).first()[0] or 0
    if number <= broadcast_rows:
        met = coded.join(F.broadcast(cells), ["cx", "cy"])
    else:
        hot = hot_keys(coded, ["cx", "cy"], hot_rows, hot_share)
        met = skew_join(coded, cells, ["cx", "cy"], "inner", hot_rows, hot_share, unique_right=True, left_hot=hot)

    def distance(stop):
        east, north = stop["x"] - F.col("_x"), stop["y"] - F.col("_y")
        return F.struct((east * east + north * north).alias("square"), stop["stop"].alias("stop"))

    best = F.array_min(F.transform("stops", distance))
    return met.select(
        *[F.col(f"`{name}`") for name in names], best.alias("_best")
    ).select(
        *[F.col(f"`{name}`") for name in names],
        F.col("_best.stop").alias("nearest_stop"), F.sqrt("_best.square").alias("distance"),
    )
