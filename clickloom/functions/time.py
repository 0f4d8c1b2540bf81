"""Event-time columns, window arithmetic and timestamp text."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS = "ts"
TS_MS = "ts_ms"


def millis(duration: timedelta) -> int:
    """Whole milliseconds of a duration."""
    return duration // timedelta(milliseconds=1)


def interval_text(duration: timedelta) -> str:
    """The duration as Spark's window and watermark functions spell it."""
    return f"{millis(duration)} milliseconds"


def epoch_ms(df: DataFrame, source: str) -> Column:
    """Epoch milliseconds of a column, whatever its time type.

    A zone-less timestamp is read as UTC, so the result never depends on the session zone.
    """
    kind = df.schema[source].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', `{source}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(source)
    if isinstance(kind, T.DateType):
        return F.unix_date(source).cast("bigint") * 86_400_000
    return F.col(source).cast("bigint")


def with_event_time(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """Add ``ts_ms`` and ``ts`` from an epoch-millisecond, timestamp or date column."""
    return df.withColumn(TS_MS, epoch_ms(df, source)).withColumn(TS, F.timestamp_millis(TS_MS))


def display_shift(ts: Column | str, hours: int = 8) -> Column:
    """Wall-clock shift for display only; event time itself is never moved."""
    return (F.col(ts) if isinstance(ts, str) else ts) + F.make_interval(hours=F.lit(hours))


def slot_start(ms: Column, width: int) -> Column:
    """Start of the epoch-aligned slot of ``width`` milliseconds that holds ``ms``."""
    return ms - F.pmod(ms, F.lit(width).cast("bigint"))


def utc_ntz(ms: Column) -> Column:
    """The UTC wall clock of an epoch-millisecond column as TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", ms, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def wall_clock(ms: Column, zone: str = "UTC") -> Column:
    """Zone-less wall-clock timestamp of an instant, whatever zone the session uses."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz(ms))


def format_ms(ms: Column, pattern: str = "yyyy-MM-dd HH:mm:ss", zone: str = "UTC") -> Column:
    """Formatted wall-clock text of an epoch-millisecond column."""
    return F.date_format(wall_clock(ms, zone), pattern)


def java_timestamp_text(ms: Column, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd HH:mm:ss.f`` with trailing zeros of the fraction removed but one digit kept."""
    return F.regexp_replace(format_ms(ms, "yyyy-MM-dd HH:mm:ss.SSS", zone), r"0{1,2}$", "")


def calendar_day(ms: Column, zone: str = "UTC") -> Column:
    """Calendar day of an instant in a zone, as a count of days since the epoch."""
    return F.unix_date(wall_clock(ms, zone).cast("date"))


def next_midnight_ms(ms: Column, offset: timedelta = timedelta(0)) -> Column:
    """Epoch milliseconds of the next midnight in a zone that is ``offset`` ahead of UTC."""
    day, shift = 86_400_000, millis(offset)
    return slot_start(ms + shift, day) + day - shift
