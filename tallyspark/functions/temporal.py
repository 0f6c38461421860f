"""Time column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.numeric import _col


def hour_of_millis(c) -> Column:
    """Start of the hour of an epoch in milliseconds, in the session time zone."""
    return F.date_trunc("hour", F.timestamp_millis(_col(c)))


def month_of_seconds(c) -> Column:
    return F.month(F.timestamp_seconds(_col(c)))


def hour_number_of_seconds(c) -> Column:
    return F.hour(F.timestamp_seconds(_col(c)))


def whole_minutes(seconds) -> Column:
    """Seconds rounded up to whole minutes."""
    return F.ceil(_col(seconds) / F.lit(60)).cast("int")


def parsed_year(c, pattern: str = "yyyy-MM-dd") -> Column:
    """Year of a date given as text; NULL if the text is no date."""
    return F.year(F.try_to_timestamp(_col(c), F.lit(pattern)))


def within_years(moment, first: int, last: int) -> Column:
    """Whether a date or timestamp lies in a closed range of years.

    The column itself is compared, so the range reaches the scan.
    """
    return (_col(moment) >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (
        _col(moment) < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")
    )
