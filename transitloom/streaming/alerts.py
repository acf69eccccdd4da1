"""Live alerts on trips: stops out of order, reached early, late, or not at all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from transitloom.operators.enrichment import ALERT_PATIENCE, ALERT_THRESHOLD, planned_stops

# Trips are watched in this many groups by their hash: a call into Python and a row of state for
# many trips, not for each. A checkpoint keeps the groups it began with, so this is no argument.
_GROUPS = 256
_ALERT = {
    "trip_id": "string", "stop_sequence": "int", "stop": "string", "planned_time": "bigint",
    "issue": "string", "offset_seconds": "bigint",
}
# Alerts leave Python as rows of at most this many, each field a list.
_LIST_ROWS = 10_000
_STATE = "plans binary, seen binary"
_PLAN = ["trip_id", "stop_sequence", "stop", "moment", "previous", "follows"]
_SEEN = ["trip_id", "stop", "moment"]
# What pandas can tell as a time, in seconds.
_FIRST, _LAST = -9_200_000_000, 9_200_000_000


class _TripWatch:
    """Per group of trips the planned stops until they are settled, and where trips were seen.

    A group is called when it has rows, and when the watermark has passed the earliest moment at
    which anything is due. What is due at a moment is settled when the watermark has passed it,
    so by all that happened up to it, in whatever order it came in.
    """

    def __init__(self, threshold: int, patience: int):
        self.threshold, self.patience = threshold, patience

    def __call__(self, key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        plans, seen = (_unpack(packed) for packed in (state.get if state.exists else (None, None)))
        told = []
        if not state.hasTimedOut:
            events = pd.concat(list(batches), ignore_index=True)
            is_seen = events["is_seen"].to_numpy()
            seen = _joined(seen, events.loc[is_seen, _SEEN])
            plans, told = self._plan(plans, events.loc[~is_seen, _PLAN])
        now = state.getCurrentWatermarkMs() // 1000
        if plans is not None:
            plans, settled = self._settle(plans, seen, now)
            told = told + settled
        if seen is not None:
            # A stop can still be planned this much later; after that nothing asks for the sighting.
            seen = seen[seen["moment"] + 2 * self.patience > now]
        self._store(state, plans, seen)
        for alerts in told:
            for start in range(0, len(alerts), _LIST_ROWS):
                part = alerts.iloc[start:start + _LIST_ROWS]
                yield pd.DataFrame({name: [part[name].to_numpy()] for name in _ALERT})

    def _plan(self, plans, new):
        """The open plans and the new ones, and alerts on new ones that step back in time."""
        known = 0 if plans is None else len(plans)
        new = new.assign(due=new["moment"] + self.threshold)
        # The feed repeats its trips: the plan that is open already stays.
        plans = _joined(plans, new, _PLAN)
        added = plans.iloc[known:]
        back = added[added["follows"] & (added["moment"] < added["previous"])]
        return plans, _alerts(back, "out_of_order", back["moment"] - back["previous"])

    def _settle(self, plans, seen, now):
        """The plans that stay open, and the alerts on those that are due."""
        due = plans["due"] <= now
        if not due.any():
            return plans, []
        asked = plans[due].reset_index(drop=True)
        first = _first_seen(asked, seen, self.patience)
        unseen, arrival = first.isna().to_numpy(), asked["moment"].to_numpy()
        first = first.fillna(0).to_numpy(dtype="int64")
        begins = asked["due"].to_numpy() == arrival + self.threshold
        late = begins & (unseen | (first > arrival + self.threshold))
        early = begins & ~late & (first < arrival - self.threshold)
        # Once it is known to be late or not, a stop is watched until it is missing or not.
        ends = arrival + self.patience <= now
        told = [
            *_alerts(asked[late], "late"),
            *_alerts(asked[early], "early", (first - arrival)[early]),
            *_alerts(asked[ends & unseen], "missing"),
        ]
        asked["due"] = arrival + self.patience
        return pd.concat([plans[~due], asked[~ends]], ignore_index=True), told

    def _store(self, state, plans, seen):
        moments = []
        if plans is not None and len(plans):
            moments.append(int(plans["due"].min()))
        if seen is not None and len(seen):
            moments.append(int(seen["moment"].min()) + 2 * self.patience)
        if not moments:
            if state.exists:
                state.remove()
            return
        state.update((_pack(plans), _pack(seen)))
        # A group is called when the watermark is beyond this, and the moment itself counts.
        state.setTimeoutTimestamp(min(moments) * 1000 - 1)


def _joined(known: pd.DataFrame | None, new: pd.DataFrame, columns: list[str] | None = None) -> pd.DataFrame:
    """Both, each different row (by ``columns``) once, the known ones first."""
    both = new if known is None else pd.concat([known, new], ignore_index=True)
    return both.drop_duplicates(columns, ignore_index=True)


def _first_seen(plans: pd.DataFrame, seen: pd.DataFrame | None, patience: int) -> pd.Series:
    """For each plan the first sighting of its trip at its stop within ``patience``, or null."""
    if seen is None or seen.empty:
        return pd.Series(np.nan, index=plans.index)
    trips, stops = (
        pd.factorize(np.concatenate([plans[name].to_numpy(), seen[name].to_numpy()]))[0]
        for name in ("trip_id", "stop")
    )
    place = trips.astype("int64") * (stops.max() + 1) + stops
    asked = pd.DataFrame({"place": place[: len(plans)], "since": plans["moment"].to_numpy() - patience})
    found = pd.DataFrame({"place": place[len(plans):], "since": seen["moment"].to_numpy()})
    found["first"] = found["since"].astype("Int64")
    met = pd.merge_asof(
        asked.sort_values("since", kind="stable").reset_index(), found.sort_values("since", kind="stable"),
        on="since", by="place", direction="forward", tolerance=2 * patience,
    )
    return met.set_index("index")["first"].reindex(plans.index)


def _alerts(plans: pd.DataFrame, issue: str, offsets=None) -> list[pd.DataFrame]:
    """The alerts as a frame, or none."""
    if plans.empty:
        return []
    offsets = np.full(len(plans), None) if offsets is None else offsets
    found = plans[["trip_id", "stop_sequence", "stop"]]
    return [found.assign(planned_time=plans["moment"], issue=issue, offset_seconds=offsets)]


def _pack(rows: pd.DataFrame | None) -> bytes | None:
    if rows is None or rows.empty:
        return None
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes | None) -> pd.DataFrame | None:
    return None if packed is None else pa.ipc.open_stream(packed).read_all().to_pandas()


def trip_alert_stream(
    trips: DataFrame,
    vehicles: DataFrame,
    watermark: str,
    threshold: int = ALERT_THRESHOLD,
    patience: int = ALERT_PATIENCE,
) -> DataFrame:
    """The alerts of ``enrichment.trip_alerts`` on two streams, in the order they become certain.

    ``trips`` is the feed, ``vehicles`` holds ``trip_id``, ``stop`` and ``timestamp_seconds``. A
    stop is late when ``threshold`` seconds after its planned arrival the trip has not been seen
    there, and missing ``patience`` seconds after it; no join can tell either, since both are
    about rows that do not come. Time is what the sightings tell, since plans speak of times to
    come; ``watermark`` is how much later than others a sighting may come in. One older than
    that is left out, and so is a stop that is first planned after its arrival has passed by so
    much. Sightings without a trip only move the time on. The state holds, for groups of trips,
    their open stops and their sightings for twice ``patience``.
    """
    def event(moment, is_seen, **others):
        # The time is for the watermark alone, and so that pandas can hold it.
        at = F.timestamp_seconds(F.least(F.greatest(moment, F.lit(_FIRST)), F.lit(_LAST)))
        blank = {"stop_sequence": F.lit(0), "previous": F.lit(0).cast("bigint"), "follows": F.lit(False)}
        return [
            "trip_id", at.alias("at"), "stop", F.lit(is_seen).alias("is_seen"), moment.alias("moment"),
            *[column.alias(name) for name, column in (blank | others).items()],
        ]

    sighted = vehicles.select(*event(F.col("timestamp_seconds"), True))
    sighted = sighted.where("moment IS NOT NULL").withWatermark("at", watermark)
    # A condition without the time would move in front of the watermark, and the clock with it.
    about_trips = (F.col("trip_id").isNotNull() & F.col("stop").isNotNull()) | (F.year("at") < 0)
    planned = planned_stops(trips).where(
        "trip_id IS NOT NULL AND stop IS NOT NULL AND arrival_time IS NOT NULL"
    ).select(*event(
        F.col("arrival_time"), False, stop_sequence=F.col("stop_sequence"),
        previous=F.coalesce("previous_arrival", F.lit(0)), follows=F.col("previous_arrival").isNotNull(),
    ))
    # The first of both gives the merged column its watermark.
    events = sighted.where(about_trips).unionByName(planned)
    group = F.pmod(F.xxhash64("trip_id"), F.lit(_GROUPS)).cast("int")
    lists = ", ".join(f"{name} array<{kind}>" for name, kind in _ALERT.items())
    told = events.withColumn("group", group).groupBy("group").applyInPandasWithState(
        _TripWatch(threshold, patience), lists, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return told.select(F.inline(F.arrays_zip(*_ALERT)))
