"""Time parsing, clock features and relative ages. The session clock must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# input formats, fixed values
DUMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
HISTORY_FORMAT = "yyyy-MM-dd HH:mm:ss.S"

CREATED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def dump_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(DUMP_FORMAT))


def history_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(HISTORY_FORMAT))


def iso_time(text: Column) -> Column:
    """ISO 8601 text with or without zone; anything else is NULL."""
    return text.try_cast("timestamp")


def epoch_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def event_time(iso: Column, seconds: Column) -> Column:
    """Event time of a live edit: its ISO stamp, or its epoch seconds where that is absent."""
    return F.coalesce(iso_time(iso), epoch_time(seconds))


def hour_of_day(time: Column) -> Column:
    return F.coalesce(F.hour(time), F.lit(0))


def day_of_week(time: Column, iso: bool = False) -> Column:
    """1 = Sunday .. 7 = Saturday; with ``iso`` 1 = Monday .. 7 = Sunday. Unknown times give 1."""
    day = F.weekday(time) + 1 if iso else F.dayofweek(time)
    return F.coalesce(day, F.lit(1))


def age_text(time: Column, now: Column) -> Column:
    """'12s ago', '5m ago', '3h ago', '2d ago'; future is '0s ago', unknown is ''."""
    seconds = F.greatest(F.lit(0), F.floor((F.unix_micros(now) - F.unix_micros(time)) / 1_000_000))

    def span(unit: int, suffix: str) -> Column:
        return F.concat(F.floor(seconds / unit).cast("string"), F.lit(f"{suffix} ago"))

    return (
        F.when(time.isNull(), "")
        .when(seconds < 60, span(1, "s"))
        .when(seconds < 3600, span(60, "m"))
        .when(seconds < 86400, span(3600, "h"))
        .otherwise(span(86400, "d"))
    )


def created_text(time: Column) -> Column:
    """Sortable text form used for ``created_at``."""
    return F.date_format(time, CREATED_FORMAT)
