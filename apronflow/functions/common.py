"""Column helpers whose results are the same in any engine with IEEE doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(col: Column, digits: int) -> Column:
    """Rounded half up by plain double arithmetic: floor(x * 10^n + 0.5) / 10^n."""
    scale = float(10**digits)
    return F.floor(col.cast("double") * scale + 0.5).cast("double") / scale


def total(col: Column | str) -> Column:
    """An exact sum of measurements with up to four decimals, whatever order the tasks add in."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,4)")).cast("double")


def mean(col: Column | str) -> Column:
    """total over count of the known values; null where none is known."""
    c = F.col(col) if isinstance(col, str) else col
    return total(c) / F.nullif(F.count(c), F.lit(0))


def share(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 or null."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def event_id(icao24: Column, kind: Column, start_s: Column) -> Column:
    """The deterministic identity of a detected event: the first 16 hex digits of the SHA-1 of its parts."""
    return F.substring(F.sha1(F.concat_ws("|", icao24, kind, start_s.cast("string")).cast("binary")), 1, 16)


def bucket(ts: Column, width_s: int) -> Column:
    """Start of the period of width_s seconds that ts lies in, without zone."""
    s = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(F.floor(s / width_s) * width_s).cast("timestamp_ntz")


def ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def age_s(as_of: Column, ts: Column) -> Column:
    """Whole seconds between two times, rounded."""
    return F.round((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 1e6).cast("int")
