"""Magnitudes of ordered values."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark import model
from recspark.functions.times import micros_of_text

MAGNITUDE_TYPE = "decimal(38,9)"
_DURATION = r"^(-?)P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
_TIME = r"^(\d{2}):(\d{2}):(\d{2}(?:\.\d+)?)(?:Z|[+-]\d{2}:?\d{2})?$"


def date_time_magnitude(value: Column) -> Column:
    """Whole seconds since 0001-01-01T00:00Z; text without offset counts as UTC."""
    seconds = F.floor(micros_of_text(value) / 1_000_000).cast("long")
    return (seconds + F.lit(model.EPOCH_OFFSET_SECONDS)).cast(MAGNITUDE_TYPE)


def date_magnitude(value: Column) -> Column:
    """Days since 0001-01-01."""
    return F.datediff(value.try_cast("date"), F.lit("0001-01-01").cast("date")).cast(MAGNITUDE_TYPE)


def _part(value: Column, pattern: str, group: int) -> Column:
    text = F.regexp_extract(value, pattern, group)
    return F.when(text == "", F.lit(0)).otherwise(text.try_cast("decimal(18,9)")).cast("decimal(18,9)")


def time_magnitude(value: Column) -> Column:
    """Seconds since midnight."""
    seconds = _part(value, _TIME, 1) * 3600 + _part(value, _TIME, 2) * 60 + _part(value, _TIME, 3)
    return F.when(value.rlike(_TIME), seconds.cast(MAGNITUDE_TYPE))


def duration_magnitude(value: Column) -> Column:
    """Seconds, with fixed lengths of a year and of a month."""
    def part(i: int) -> Column:
        return _part(value, _DURATION, i)

    def times(c: Column, factor: str) -> Column:
        return (c * F.lit(factor).cast("decimal(12,2)")).cast(MAGNITUDE_TYPE)

    seconds = (
        times(part(2), str(_seconds(model.DURATION_YEAR_DAYS))) + times(part(3), str(_seconds(model.DURATION_MONTH_DAYS)))
        + times(part(4), "604800") + times(part(5), "86400") + times(part(6), "3600") + times(part(7), "60")
        + part(8).cast(MAGNITUDE_TYPE)
    )
    sign = F.when(F.regexp_extract(value, _DURATION, 1) == "-", -1).otherwise(1)
    return F.when(value.rlike(_DURATION), (seconds * sign).cast(MAGNITUDE_TYPE))


def _seconds(days: str) -> Decimal:
    return Decimal(days) * 86400


def proportion_magnitude(numerator: Column, denominator: Column) -> Column:
    d = denominator.cast("decimal(18,6)")
    return F.when(d != 0, (numerator.cast("decimal(18,6)") / d).cast(MAGNITUDE_TYPE))


def ordered_magnitude(type_col: Column, number: Column, text: Column) -> Column:
    """Magnitude by value type: ``number`` for numeric types, ``text`` parsed for temporal ones, else NULL."""
    return (
        F.when(type_col.isin(*model.NUMERIC_ORDERED), number.cast(MAGNITUDE_TYPE))
        .when(type_col == "DV_DATE_TIME", date_time_magnitude(text))
        .when(type_col == "DV_DATE", date_magnitude(text))
        .when(type_col == "DV_TIME", time_magnitude(text))
        .when(type_col == "DV_DURATION", duration_magnitude(text))
    )


def add_magnitude(df: DataFrame, type_col: str, value_col: str, number_col: str | None = None, out: str = "magnitude") -> DataFrame:
    """Add the magnitude of temporal values (from text) and, with ``number_col``, of numeric ones."""
    model.require(df, type_col, value_col)
    number = F.col(number_col) if number_col else F.lit(None).cast("double")
    return df.withColumn(out, ordered_magnitude(F.col(type_col), number, F.col(value_col)))
