"""Keys as every problem wants them: identifiers without blanks, times in epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the blanks that are dropped from identifiers.
BLANKS = " \t\r\n\f "


def icao(col: Column | str) -> Column:
    """Lower case without blanks; null where nothing is left."""
    return F.nullif(F.lower(F.translate(F.col(col) if isinstance(col, str) else col, BLANKS, "")), F.lit(""))


def place(col: Column | str) -> Column:
    """Station and airport codes: upper case without blanks; null where nothing is left."""
    return F.nullif(F.upper(F.translate(F.col(col) if isinstance(col, str) else col, BLANKS, "")), F.lit(""))


def seconds(col: Column | str) -> Column:
    """Epoch seconds from a bigint that may be in seconds, milli-, micro- or nanoseconds.

    The unit is told by the magnitude: seconds stay under 10**11 until the year 5138, and the other
    units of any time since 1973 are over that.
    """
    c = F.col(col) if isinstance(col, str) else col
    size = F.abs(c)
    return (
        F.when(size < 10**11, c)
        .when(size < 10**14, F.floor(c / F.lit(10**3)))
        .when(size < 10**17, F.floor(c / F.lit(10**6)))
        .otherwise(F.floor(c / F.lit(10**9)))
        .cast("long")
    )


def epoch(col: Column | str) -> Column:
    """Epoch seconds of a timestamp (with or without zone; the session's zone is UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_seconds(c.cast("timestamp"))


def number(col: Column | str) -> Column:
    """A double whose NaN counts as missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(c), c)
