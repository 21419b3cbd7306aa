"""Joins in time: last value as of an instant, matches within a tolerance, intervals over periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a shard of one key's time line; no window is longer.
SHARD_S = 86_400


def spread(*columns: str, over: int = 4096) -> Column:
    """A number that spreads rows, equal ones too, over groups."""
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(over)).cast("long")


def backward(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, columns: Sequence[str], strict: bool = False, shard_s: int = SHARD_S) -> DataFrame:
    """left with right's columns as of left_ts: from the last right row of the key with right_ts <= left_ts (strict: <).

    Rows without an earlier right row keep nulls; so do rows with a null key or time, which are spread
    over as many windows as they like, as they look for nothing. Right rows must be
    unique per (key, right_ts), else the greatest of them counts. Extra columns stay with left;
    columns that both sides have must be renamed before.

    No join and no range condition: both sides are laid on one time line per key and day, and the last
    known right value is carried on. What a day inherits comes from one row per key and day, so a hot
    key is spread over its days.
    """
    shard = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / shard_s)
    value = F.struct(F.col(right_ts), *[F.col(c) for c in columns if c != right_ts])
    known = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(F.col(key), shard(right_ts).alias("__shard"), F.col(right_ts).alias("__ts"), value.alias("__value"))
    days = known.groupBy(key, "__shard").agg(F.max("__value").alias("__value"))
    asked = left.where(F.col(key).isNotNull() & F.col(left_ts).isNotNull()).select(F.col(key), shard(left_ts).alias("__shard")).distinct()
    line = days.withColumn("__asked", F.lit(False)).unionByName(asked.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
    earlier = Window.partitionBy(key).orderBy("__shard").rangeBetween(Window.unboundedPreceding, -1)
    inherited = line.withColumn("__value", F.last("__value", ignorenulls=True).over(earlier)).where(F.col("__asked") & F.col("__value").isNotNull())
    inherited = inherited.select(key, "__shard", F.col(f"__value.{right_ts}").alias("__ts"), "__value")
    lost = F.col(key).isNull() | F.col(left_ts).isNull()
    own = F.when(lost, spread(*left.columns)).otherwise(shard(left_ts))
    probe = left.select(F.col(key), own.alias("__shard"), F.col(left_ts).alias("__ts"), F.struct(*[F.col(c) for c in left.columns]).alias("__row"))
    # at one instant the right row comes first if it counts, else last
    sides = known.unionByName(inherited).withColumn("__side", F.lit(1 if strict else -1)).unionByName(probe.withColumn("__side", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy(key, "__shard").orderBy(F.col("__ts").asc_nulls_first(), "__side", F.col("__value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    carried = sides.withColumn("__last", F.last("__value", ignorenulls=True).over(order)).where(F.col("__side") == 0)
    usable = F.col(key).isNotNull() & F.col("__ts").isNotNull()
    return carried.select("__row.*", *[F.when(usable, F.col(f"__last.{c}")).alias(c) for c in columns])


def within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, tolerance_s: int) -> DataFrame:
    """The left rows for which some right row of the same keys lies within tolerance_s, inclusive.

    A semi-join on the keys and a time bucket as wide as the tolerance: each right row stands in its
    bucket and the two beside, so the join is an equi-join and no key has all of its pairs compared.
    """
    slot = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / tolerance_s)
    own = left.withColumn("__slot", slot(left_ts))
    near = right.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(right_ts).alias("__ts"), F.explode(F.array(*[slot(right_ts) + d for d in (-1, 0, 1)])).alias("__near"))
    on = F.col("__slot") == F.col("__near")
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    gap = F.abs(F.unix_micros(F.col(left_ts).cast("timestamp")) - F.unix_micros(F.col("__ts").cast("timestamp")))
    return own.join(near, on & (gap <= tolerance_s * 1_000_000), "left_semi").drop("__slot")


def periods_covered(intervals: DataFrame, start: str, end: str, first: str, last: str, period_s: int) -> DataFrame:
    """One row per interval and period that it overlaps: intervals' columns and period_ts.

    [start, end) with a null end open; clipped to the periods from first up to (not including) last,
    which are columns of intervals. Turns an interval join into an equi-join on period_ts.
    """
    s = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    begin = F.greatest(F.floor(s(start) / period_s), F.floor(s(first) / period_s))
    stop = F.least(F.coalesce(F.ceil(s(end) / period_s), F.floor(s(last) / period_s)), F.floor(s(last) / period_s)) - 1
    empty = F.col(end).isNotNull() & (F.col(end) <= F.col(start))
    listed = F.when((begin <= stop) & ~empty, F.sequence(begin, stop))
    return intervals.select("*", F.explode(listed).alias("__p")).withColumn("period_ts", F.timestamp_seconds(F.col("__p") * period_s).cast("timestamp_ntz")).drop("__p")
