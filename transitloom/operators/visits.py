"""Visits of vehicles to stops, out of their positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitloom.operators.ordering import next_in_group, with_rank
from transitloom.operators.skew import HOT_ROWS, HOT_SHARE, hot_keys
from transitloom.storage import materialize

# Positions of a hot vehicle that one task looks at together.
SLICE_ROWS = 500_000
_WHO = ["vehicle", "slice"]


def _islands(positions: DataFrame, max_gap: int | None) -> DataFrame:
    """Runs of positions at one stop inside each slice of a vehicle's time."""
    order = Window.partitionBy(*_WHO).orderBy("at", "stop")
    before = F.lag("at").over(order)
    starts = before.isNull() | ~F.lag("stop").over(order).eqNullSafe(F.col("stop"))
    if max_gap is not None:
        starts = starts | (F.col("at") - before > max_gap)
    marked = positions.withColumn("_starts", F.when(starts, 1).otherwise(0))
    numbered = marked.withColumn("island", F.sum("_starts").over(order))
    return numbered.groupBy(*_WHO, "island", "stop").agg(
        F.min("at").alias("arrival"), F.max("at").alias("departure"), F.count("*").alias("positions")
    )


def _joined_at_seams(islands: DataFrame, max_gap: int | None) -> DataFrame:
    """Islands of sliced vehicles, those that go on in the next slice put together.

    Only the first and the last island of a slice can go on, so each slice tells two rows at
    most: few, however many positions the vehicle has.
    """
    ends = islands.groupBy(*_WHO).agg(F.max("island").alias("last"))
    at_end = (F.col("island") == 1) | (F.col("island") == F.col("last"))
    marked = materialize(islands.join(ends, _WHO).withColumn("_edge", at_end), "islands")
    inner = marked.where("NOT _edge").select("vehicle", "stop", "arrival", "departure", "positions")
    order = Window.partitionBy("vehicle").orderBy("slice", "island")
    goes_on = (
        F.lag("stop").over(order).eqNullSafe(F.col("stop"))
        & (F.lag("slice").over(order) != F.col("slice"))
    )
    if max_gap is not None:
        goes_on = goes_on & (F.col("arrival") - F.lag("departure").over(order) <= max_gap)
    edges = marked.where("_edge").withColumn("_starts", F.when(goes_on, 0).otherwise(1))
    whole = edges.withColumn("visit", F.sum("_starts").over(order)).groupBy("vehicle", "visit", "stop").agg(
        F.min("arrival").alias("arrival"), F.max("departure").alias("departure"),
        F.sum("positions").cast("bigint").alias("positions"),
    )
    return inner.unionByName(whole.drop("visit"))


def stop_visits(
    positions: DataFrame,
    vehicle: str = "vehicle_id",
    at: str = "timestamp_seconds",
    stop: str = "stop",
    max_gap: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``vehicle, stop, arrival, departure, dwell, positions, next_stop, returns_at``, one row a visit.

    A visit is a run of a vehicle's positions, in order of time, at one stop; a position
    elsewhere or at no stop (NULL) ends it, and so does, if ``max_gap`` is given, a longer time
    without position. Positions of one time are taken in the order of their stops (none first);
    repeated ones count each. ``next_stop`` is where the vehicle's next visit is, ``returns_at``
    when it is back at this stop; NULL where it never is. Positions without vehicle or time are
    left out.

    Ordinary vehicles are one window each. The positions of a vehicle with very many are ranked
    over the whole table and cut into slices of ``slice_rows``, worked on apart and joined at
    their seams.
    """
    rows = positions.select(
        F.col(vehicle).alias("vehicle"), F.col(at).alias("at"), F.col(stop).alias("stop")
    ).dropna(subset=["vehicle", "at"])
    hot = hot_keys(rows, ["vehicle"], hot_rows, hot_share)
    columns = ["vehicle", "stop", "arrival", "departure", "positions"]
    if not hot:
        found = _islands(rows.withColumn("slice", F.lit(0).cast("bigint")), max_gap).select(*columns)
    else:
        listed = hot.joinable(hot.table.select("vehicle"))
        ordinary = rows.join(listed, "vehicle", "left_anti").withColumn("slice", F.lit(0).cast("bigint"))
        ranked = with_rank(rows.join(listed, "vehicle", "left_semi"), ["vehicle", "at", "stop"])
        sliced = ranked.withColumn("slice", F.floor(F.col("rank") / slice_rows)).drop("rank")
        found = _islands(ordinary, max_gap).select(*columns).unionByName(
            _joined_at_seams(_islands(sliced, max_gap), max_gap)
        )
    visits = materialize(found.where("stop IS NOT NULL"), "visits")
    # Two visits of a vehicle never share their arrival and stop, so these order them.
    order = ["arrival", "departure", "stop"]
    busy = hot_keys(visits, ["vehicle"], hot_rows, hot_share) if hot else hot
    followed = next_in_group(visits, "vehicle", order, "stop", "next_stop", busy)
    placed = followed.withColumn("_stay", F.concat_ws("\x00", F.col("vehicle").cast("string"), F.col("stop").cast("string")))
    if busy:
        placed = materialize(placed, "placed")
    often = hot_keys(placed, ["_stay"], hot_rows, hot_share) if busy else busy
    back = next_in_group(placed, "_stay", ["arrival", "departure"], "arrival", "returns_at", often)
    return back.select(
        "vehicle", "stop", "arrival", "departure", (F.col("departure") - F.col("arrival")).alias("dwell"),
        "positions", "next_stop", "returns_at",
    )
