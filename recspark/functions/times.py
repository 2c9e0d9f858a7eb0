"""Times without the session's time zone: a text without offset and a time without zone are UTC, whatever the session says."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OFFSET = r"(?i)\d[:\d.]*\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
MICROS_PER_DAY = 86_400_000_000


def _has_offset(text: Column) -> Column:
    """A trailing Z or offset behind a time of day (a date alone ends in digits and hyphens as well)."""
    return text.contains(":") & text.rlike(_OFFSET)


def micros_of_ntz(time: Column) -> Column:
    """Microseconds since 1970 of a time without zone, read as UTC; gaps and repeated hours of zones do not matter."""
    days = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = F.extract(F.lit("SECOND"), time) * 1_000_000
    return days * MICROS_PER_DAY + (F.hour(time) * 3600 + F.minute(time) * 60).cast("long") * 1_000_000 + seconds.cast("long")


def micros(time: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a column of ``kind`` (timestamp with or without zone)."""
    return F.unix_micros(time) if isinstance(kind, T.TimestampType) else micros_of_ntz(time)


def ntz_of_micros(value: Column) -> Column:
    """The UTC time without zone at so many microseconds since 1970."""
    rest = F.pmod(value, F.lit(MICROS_PER_DAY))  # never negative
    days = ((value - rest) / MICROS_PER_DAY).cast("int")
    seconds = (rest.cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def of_micros(value: Column, kind: T.DataType) -> Column:
    return F.timestamp_micros(value) if isinstance(kind, T.TimestampType) else ntz_of_micros(value)


def micros_of_text(text: Column) -> Column:
    """Microseconds since 1970 of an ISO text; without an offset it is UTC. NULL if unparsable."""
    return F.when(_has_offset(text), F.unix_micros(F.try_to_timestamp(text))).otherwise(micros_of_ntz(text.try_cast("timestamp_ntz")))


def iso_text(time: Column) -> Column:
    """A time without zone as ISO text in UTC, with as many fraction digits as needed."""
    return F.concat(F.replace(time.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
