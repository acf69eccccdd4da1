"""Live positions with the weather of their minute."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from transitloom.operators.skew import spread


def _fields(struct) -> tuple:
    """The fields of a struct, which rows hold as a dictionary and states as a row."""
    return tuple(struct.values()) if isinstance(struct, dict) else tuple(struct)


class _LatestReport(StatefulProcessor):
    """Per place (and salt) the reports that may still count, and positions not yet certain.

    A position is certain when the watermark has passed its minute: no earlier report can come.
    Of the reports up to the watermark only the last is kept.
    """

    def __init__(self, position: StructType, report: StructType, recency: Sequence[str]):
        self.position, self.report, self.recency = position, report, recency

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        reports = f"reports array<struct<minute:bigint,report:{self.report.simpleString()}>>, timer bigint"
        self.reports = handle.getValueState("reports", reports)
        self.held = handle.getListState("held", f"minute bigint, position {self.position.simpleString()}")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        reports, timer = self._load()
        added = []
        for row in rows:
            if row["position"] is None:
                minute, report = row["minute"], _fields(row["report"])
                if minute not in reports or self._order(reports[minute]) < self._order(report):
                    reports[minute] = report
            elif row["minute"] is None:
                yield self._joined(_fields(row["position"]), None)
            else:
                added.append((row["minute"], _fields(row["position"])))
        if added:
            self.held.appendList(added)
            timer = self._next(min(minute for minute, _ in added), timer)
        self._store(reports, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        reports, _ = self._load()
        now = timerValues.getCurrentWatermarkInMs() // 60_000
        minutes = sorted(reports)
        waiting = []
        for minute, held in self.held.get():
            position = _fields(held)
            if minute > now:
                waiting.append((minute, position))
                continue
            last = bisect_right(minutes, minute)
            yield self._joined(position, reports[minutes[last - 1]] if last else None)
        passed = bisect_right(minutes, now)
        for minute in minutes[: max(0, passed - 1)]:
            del reports[minute]
        if waiting:
            self.held.put(waiting)
            timer = self._next(min(minute for minute, _ in waiting), None)
        else:
            self.held.clear()
            timer = None
        self._store(reports, timer)

    def _order(self, report):
        """Places NULL first, as sorting does."""
        values = [report[self.report.names.index(name)] for name in self.recency]
        return [(value is not None, value if value is not None else 0) for value in values]

    def _joined(self, position, report) -> Row:
        report = report if report is not None else (None,) * len(self.report)
        return Row(*self.position.names, *self.report.names)(*position, *report)

    def _next(self, minute, timer):
        if timer is not None and timer <= minute:
            return timer
        if timer is not None:
            self.handle.deleteTimer(timer * 60_000)
        self.handle.registerTimer(minute * 60_000)
        return minute

    def _load(self):
        found = self.reports.get()
        if found is None:
            return {}, None
        return {minute: _fields(report) for minute, report in found[0]}, found[1]

    def _store(self, reports, timer):
        self.reports.update((list(reports.items()), timer))


def weather_enrich_stream(
    positions: DataFrame,
    reports: DataFrame,
    watermark: str,
    by: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    salts: int | None = None,
) -> DataFrame:
    """``enrichment.weather_enrich`` on two streams: each position with the latest report of its
    minute or before, also where the report comes in later than the position.

    Both have ``minute``, minutes since the epoch, and ``by``. ``watermark`` is how much later
    than others a row may come in: positions are held that long, rows older than that are left
    out. Where there are many positions for one place, or only one place, they are spread over
    ``salts`` states (by default a quarter of the state partitions), each of which keeps the few
    reports. A position without minute has no weather; reports without one are left out.
    """
    if salts is None:
        salts = max(1, int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    fields = [name for name in reports.columns if name not in (*by, "minute")]
    position, report = F.struct(*positions.columns), F.struct(*fields)
    kinds = [frame.select(column.alias("row")).schema["row"].dataType
             for frame, column in ((positions, position), (reports, report))]
    at = F.timestamp_seconds(F.col("minute") * 60)
    minute = F.col("minute").cast("bigint").alias("minute")
    events = positions.select(
        *by, spread(positions.columns, F.lit(salts)).alias("salt"), minute, at.alias("at"),
        position.alias("position"), F.lit(None).cast(kinds[1]).alias("report"),
    ).unionByName(
        reports.where("minute IS NOT NULL").select(
            *by, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), minute, at.alias("at"),
            F.lit(None).cast(kinds[0]).alias("position"), report.alias("report"),
        )
    )
    joined = StructType([*positions.schema.fields, *[reports.schema[name] for name in fields]])
    processor = _LatestReport(*kinds, tuple(tie_break or fields))
    return (
        events.withWatermark("at", watermark)
        .groupBy(*by, "salt")
        .transformWithState(processor, joined, "append", "eventTime")
    )
