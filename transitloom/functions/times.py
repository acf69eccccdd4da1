"""Dates, clock times and epochs as column expressions, free of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

# Service days run past midnight, so hours above 23 are kept.
_CLOCK = r"^\d{1,2}:[0-5]\d(:[0-5]\d)?$"


def reformat_date(column, source: str, target: str) -> Column:
    """Rewrite a date string; an empty or impossible date becomes NULL."""
    text = F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(""))
    return F.date_format(F.try_to_timestamp(text, F.lit(source)), target)


def _hours_and_minutes(text: Column) -> tuple[Column, Column]:
    hours = F.substring_index(text, ":", 1)
    return hours, F.substring_index(F.substring_index(text, ":", 2), ":", -1)


def clock_to_minutes(column) -> Column:
    """``HH:mm:ss`` (or ``HH:mm``) to ``HH:mm``; anything else, and empty, to NULL."""
    text = F.col(column) if isinstance(column, str) else column
    hours, minutes = _hours_and_minutes(text)
    return F.when(text.rlike(_CLOCK), F.concat(F.lpad(hours, 2, "0"), F.lit(":"), minutes))


def clock_with_seconds(column) -> Column:
    """``HH:mm`` to ``HH:mm:00``, seconds dropped if there are any."""
    return F.concat(clock_to_minutes(column), F.lit(":00"))


def clock_to_seconds(column) -> Column:
    """Seconds since the service day's midnight, so it does not depend on the reading day."""
    text = F.col(column) if isinstance(column, str) else column
    hours, minutes = _hours_and_minutes(text)
    # A clock time longer than HH:mm has seconds.
    seconds = F.when(F.length(text) > 5, F.substring_index(text, ":", -1)).otherwise(F.lit("0"))
    total = (
        hours.try_cast("bigint") * 3600 + minutes.try_cast("bigint") * 60 + seconds.try_cast("bigint")
    )
    return F.when(text.rlike(_CLOCK), total)


def _epoch_origin() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_to_text(seconds) -> Column:
    """Epoch seconds to ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    moment = F.timestamp_add("SECOND", seconds, _epoch_origin())
    return moment.cast("string")


def epoch_date(seconds) -> Column:
    """UTC date ``yyyy-MM-dd`` of epoch seconds."""
    return F.substring(epoch_to_text(seconds), 1, 10)


def epoch_clock(seconds) -> Column:
    """UTC clock time ``HH:mm`` of epoch seconds."""
    return F.substring(epoch_to_text(seconds), 12, 5)


def date_to_epoch(column) -> Column:
    """Date string ``yyyy-MM-dd`` to epoch seconds of its UTC midnight."""
    return F.unix_date(F.col(column).try_cast("date")).cast("bigint") * 86400


def moment_to_epoch(df: DataFrame, column: str) -> Column:
    """Epoch seconds of a timestamp, a zone-less timestamp (as UTC) or an ISO string."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampNTZType):
        return F.timestamp_diff("SECOND", _epoch_origin(), F.col(column))
    if isinstance(kind, TimestampType):
        return F.unix_seconds(F.col(column))
    if isinstance(kind, StringType):
        return F.unix_seconds(F.try_to_timestamp(F.col(column)))
    return F.col(column).cast("bigint")
