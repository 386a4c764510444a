"""Calendar days and instants in UTC."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = datetime.date | str | None


def _day_of_instant(instant: Column) -> Column:
    # From the epoch seconds, so the session's zone plays no part.
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def parse_instant(text: Column) -> Column:
    """ISO text to an instant; text without a zone means UTC."""
    zoned = text.rlike(r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?)$") & text.contains(":")
    midnight = F.when(text.contains(":"), text).otherwise(F.concat(text, F.lit("T00:00:00")))
    return F.to_timestamp(F.when(zoned, text).otherwise(F.concat(midnight, F.lit("Z"))))


def utc_day(df: DataFrame, column: str) -> Column:
    """UTC calendar day of a date, timestamp, zoneless timestamp or ISO text column."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return _day_of_instant(F.col(column))
    if isinstance(kind, T.StringType):
        return _day_of_instant(parse_instant(F.col(column)))
    return F.col(column).cast("date")


def day_or_today(as_of: AsOf) -> Column:
    """``as_of`` as a date, or the current UTC day where it is None."""
    if as_of is None:
        return _day_of_instant(F.current_timestamp())
    return F.lit(str(as_of)).cast("date")


def day_start(day: Column) -> Column:
    """Midnight of a UTC day as a time without zone, the same in any session."""
    return day.cast("timestamp_ntz")


def day_end(day: Column) -> Column:
    """Last whole second of the day."""
    return day_start(day) + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(59), F.lit(59))
