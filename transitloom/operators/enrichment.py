"""Positions with weather, planned against observed times, and windowed delays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transitloom.operators.skew import HOT_ROWS, HOT_SHARE, HotKeys, hot_keys, skew_join, tasks_for
from transitloom.storage import materialize

_DAY = 24 * 60
# Seconds before and after a planned arrival: on time within, given up beyond.
ALERT_THRESHOLD, ALERT_PATIENCE = 300, 1200


def weather_enrich(
    positions: DataFrame,
    weather: DataFrame,
    by: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Each position with the latest weather of its minute or before.

    Both frames carry ``minute``, minutes since the epoch (weather is reported to the
    minute). Of several reports for one minute the last by ``tie_break`` counts.
    Positions before the first report keep NULL weather.

    The minutes that occur form a short calendar: at most one row per minute, however
    many positions there are. Within a day the last report is carried forward, and
    what is open at the start of a day comes from the last report of earlier days.
    Positions then match the calendar by equality.
    """
    keys = [*by, "minute"]
    fields = [name for name in weather.columns if name not in keys]
    recency = F.struct(*[F.col(name) for name in (tie_break or fields)])
    reports = weather.groupBy(*keys).agg(
        F.max_by(F.struct(*fields), recency).alias("report")
    )
    asked = positions.select(*keys).dropna().distinct()
    blank = F.lit(None).cast(reports.schema["report"].dataType).alias("report")
    calendar = (
        reports.select(*keys, "report")
        .unionByName(asked.select(*keys, blank))
        .groupBy(*keys)
        .agg(F.first("report", ignorenulls=True).alias("report"))
        .withColumn("_day", F.floor(F.col("minute") / _DAY))
    )
    calendar = materialize(calendar, "calendar")  # read twice, and a row per minute at most
    so_far = Window.partitionBy(*by, "_day").orderBy("minute")
    within = F.last("report", ignorenulls=True).over(
        so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per day that occurs; a day's window spans those few rows.
    by_day = calendar.groupBy(*by, "_day").agg(
        F.max_by("report", F.when(F.col("report").isNotNull(), F.col("minute"))).alias("_last")
    )
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_day")
    opening = by_day.withColumn(
        "_open",
        F.last("_last", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
    ).drop("_last")
    carried = (
        calendar.withColumn("_within", within)
        .join(opening, [*by, "_day"])
        .select(*keys, F.coalesce("_within", "_open").alias("report"))
        .where("report IS NOT NULL")
    )
    joined = skew_join(positions, carried, keys, "left", hot_rows, hot_share, unique_right=True)
    return joined.select(*positions.columns, "report.*")


def planned_stops(trips: DataFrame) -> DataFrame:
    """One row per planned stop of a trip, with the arrival planned just before it."""
    stops = F.col("stop_time_updates")
    # Paired before they are taken apart: no row carries the whole trip along.
    paired = F.transform(
        stops,
        lambda stop, at: F.struct(
            stop.alias("stop"), F.get(stops, at - 1)["arrival_time"].alias("previous_arrival")
        ),
    )
    return trips.select("trip_id", F.posexplode(paired).alias("stop_sequence", "planned")).select(
        "trip_id",
        "stop_sequence",
        F.col("planned.stop.stop_id").alias("stop"),
        F.col("planned.stop.arrival_time").alias("arrival_time"),
        F.col("planned.stop.departure_time").alias("departure_time"),
        "planned.previous_arrival",
    )


def trip_sync_issues(
    trips: DataFrame,
    vehicles: DataFrame,
    threshold: int = 300,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Planned stops that are out of order or far from the observed time.

    ``vehicles`` holds ``trip_id``, ``stop`` and ``timestamp_seconds``; the first
    observation at a stop counts. ``offset_seconds`` is observed minus planned, or for
    ``out_of_order`` the step back from the arrival before.
    """
    planned = planned_stops(trips)
    observed = vehicles.groupBy("trip_id", "stop").agg(
        F.min("timestamp_seconds").alias("observed_time")
    )
    # A stop of a trip can only be frequent if the trip is, which a narrow scan tells.
    keys = ["trip_id", "stop"]
    busy = hot_keys(trips, ["trip_id"], hot_rows, hot_share)
    hot = hot_keys(planned, keys, hot_rows, hot_share) if busy else busy
    seen = skew_join(
        planned, observed, keys, "left", hot_rows, hot_share, unique_right=True, left_hot=hot
    )
    offset = F.col("observed_time") - F.col("arrival_time")
    step = F.col("arrival_time") - F.col("previous_arrival")
    issues = F.array(
        F.when(step < 0, F.struct(F.lit("out_of_order").alias("issue"), step.alias("offset_seconds"))),
        F.when(
            F.abs(offset) > threshold,
            F.struct(F.lit("out_of_sync").alias("issue"), offset.alias("offset_seconds")),
        ),
    )
    return seen.select(
        "trip_id", "stop_sequence", "stop", F.explode(F.array_compact(issues)).alias("found")
    ).select("trip_id", "stop_sequence", "stop", "found.*")


_KNOWN = ["trip_id", "stop", "arrival_time"]
_PLAN = ["trip_id", "stop_sequence", "stop", "arrival_time", "previous_arrival"]


def _first_sightings(planned: DataFrame, sighted: DataFrame, patience: int, tasks: int) -> DataFrame:
    """Different planned stops with ``offset``, that of the first sighting within ``patience``.

    Both sides are dealt to ``tasks`` by trip and stop once; what follows happens where they lie.
    """
    plans = planned.repartition(tasks, "trip_id", "stop").distinct()
    seen = sighted.repartition(tasks, "trip_id", "stop").distinct()
    seen = seen.select(F.col("trip_id").alias("_trip"), F.col("stop").alias("_stop"), "timestamp_seconds")
    offset = F.col("timestamp_seconds") - F.col("arrival_time")
    same = (F.col("trip_id") == F.col("_trip")) & (F.col("stop") == F.col("_stop"))
    met = plans.join(seen, same & (F.abs(offset) <= patience), "left")
    return met.groupBy(*_PLAN).agg(F.min(offset).alias("offset"))


def _first_sightings_salted(
    planned: DataFrame, sighted: DataFrame, patience: int, hot_rows: int, hot_share: float
) -> DataFrame:
    """The same for stops of a trip with so many rows that one task should not get them."""
    planned = materialize(planned.distinct(), "planned")  # read for its keys, for the join and for the result
    near = planned.select(*_KNOWN).distinct()
    met = skew_join(near, sighted.distinct(), ["trip_id", "stop"], "inner", hot_rows, hot_share)
    offset = F.col("timestamp_seconds") - F.col("arrival_time")
    first = met.where(F.abs(offset) <= patience).groupBy(*_KNOWN).agg(F.min(offset).alias("offset"))
    return skew_join(planned, first, _KNOWN, "left", hot_rows, hot_share, unique_right=True).select(*_PLAN, "offset")


def trip_alerts(
    trips: DataFrame,
    vehicles: DataFrame,
    threshold: int = ALERT_THRESHOLD,
    patience: int = ALERT_PATIENCE,
    hot_rows: int = HOT_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Planned stops that lie out of order, or where the trip is early, late or missing.

    ``vehicles`` holds ``trip_id``, ``stop`` and ``timestamp_seconds``; the first sighting
    within ``patience`` seconds of the planned arrival counts. ``early``: it is more than
    ``threshold`` seconds before (``offset_seconds``, negative); ``late``: there is none up to
    ``threshold`` seconds after; ``missing``: there is none at all. A late stop may be missing
    too: the one is known first. Each different planned stop is looked at once, one without
    trip, stop or arrival not at all.
    """
    planned = planned_stops(trips).select(*_PLAN).dropna(subset=_KNOWN)
    sighted = vehicles.select("trip_id", "stop", "timestamp_seconds").dropna()
    keys = ["trip_id", "stop"]
    crowded = [hot_keys(frame, keys, hot_rows, hot_share) for frame in (planned, sighted)]
    tasks = tasks_for(sum(found.rows for found in crowded))
    if any(crowded):
        tables = [found.table.select(*keys) for found in crowded if found]
        listed = materialize(reduce(DataFrame.unionByName, tables).distinct(), "hot-stops")
        apart = HotKeys(listed, sum(found.size for found in crowded)).joinable(listed)
        plain = [frame.join(apart, keys, "left_anti") for frame in (planned, sighted)]
        seen = _first_sightings(*plain, patience, tasks)
        hot = [frame.join(apart, keys, "left_semi") for frame in (planned, sighted)]
        seen = seen.unionByName(_first_sightings_salted(*hot, patience, hot_rows, hot_share))
    else:
        seen = _first_sightings(planned, sighted, patience, tasks)
    step = F.col("arrival_time") - F.col("previous_arrival")
    none = F.lit(None).cast("bigint")

    def issue(condition, name, value):
        return F.when(condition, F.struct(F.lit(name).alias("issue"), value.alias("offset_seconds")))

    issues = F.array(
        issue(step < 0, "out_of_order", step),
        issue(F.col("offset") < -threshold, "early", F.col("offset")),
        issue(F.col("offset").isNull() | (F.col("offset") > threshold), "late", none),
        issue(F.col("offset").isNull(), "missing", none),
    )
    return seen.select(
        "trip_id", "stop_sequence", "stop", F.col("arrival_time").alias("planned_time"),
        F.explode(F.array_compact(issues)).alias("found"),
    ).select("trip_id", "stop_sequence", "stop", "planned_time", "found.*")


def windowed_delay(
    vehicles: DataFrame,
    moment: str = "timestamp",
    window: str = "1 hour",
    watermark: str | None = None,
) -> DataFrame:
    """Number of positions and mean delay per route and time window, on batch or stream."""
    if watermark:
        vehicles = vehicles.withWatermark(moment, watermark)
    groups = vehicles.groupBy(F.window(moment, window), "route")
    return groups.agg(
        F.count("*").alias("positions"), F.avg("delay").alias("mean_delay")
    ).select("window.start", "window.end", "route", "positions", "mean_delay")
