"""Late and out-of-order records: aggregates by event time, corrected by retractions.

Each period of a key is given out once at its closing time. A record that arrives later, but before
the cut-off, changes that result: the change is a pair of deltas, the old aggregate with sign -1 and
the new one with sign +1, under the next version of the key. A record after the cut-off is dropped.
Consumers sum the signed deltas, so nothing is recomputed downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def changes(records: DataFrame, identifier: Sequence[str], keys: Sequence[str], period: int = 3600, grace: int = 300, cutoff: int = 21_600) -> DataFrame:
    """The changelog of counts per key and period: keys, period_s, version, at_s, sign, n, late.

    records has one or more rows per record (copies count as one, at their first arrival) with event_s
    and arrival_s. Version 0 is the first output at the period's end plus grace, with sign +1; each
    later distinct arrival up to cutoff seconds after the end gives version v: the old count with
    sign -1 and the new one with +1. Arrivals beyond give one row per period with sign 0, n the
    number of dropped records and no version, since they change nothing. A period whose first record is late starts
    with the retraction of a count of 0.

    The state of a key and period is bounded: records are first reduced per record, then to one row
    per distinct arrival second, of which the lateness limit allows cutoff at most. Both reductions
    begin in each task before the shuffle, so many copies of one record cost one row each task.
    Nulls in keys group together; an empty table gives an empty changelog.
    """
    hour = F.floor(F.col("event_s") / period) * period
    by = [*keys, "period_s"]
    once = (
        records.withColumn("period_s", hour.cast("long"))
        .groupBy(*by, *[c for c in identifier if c not in by])
        .agg(F.min("arrival_s").alias("arrival_s"))
    )
    end = F.col("period_s") + period
    kind = F.when(F.col("arrival_s") <= end + grace, 0).when(F.col("arrival_s") <= end + cutoff, 1).otherwise(2)
    # punctual records all arrive at the closing time as far as the output is concerned; dropped ones share a row
    steps = (
        once.withColumn("late", kind)
        .withColumn("at_s", F.when(F.col("late") == 1, F.col("arrival_s")).otherwise(F.when(F.col("late") == 0, end + grace).otherwise(end + cutoff)))
        .groupBy(*by, "late", "at_s")
        .agg(F.count(F.lit(1)).alias("added"))
    )
    order = Window.partitionBy(*by).orderBy("late", "at_s")
    running = steps.withColumn("new_n", F.sum(F.when(F.col("late") < 2, F.col("added")).otherwise(0)).over(order))
    running = running.withColumn("old_n", F.col("new_n") - F.when(F.col("late") < 2, F.col("added")).otherwise(0))
    running = running.withColumn("version", F.when(F.col("late") < 2, F.sum(F.when(F.col("late") == 1, 1).otherwise(0)).over(order)).cast("long"))
    plus = F.struct(F.lit(1).alias("sign"), F.col("new_n").alias("n"))
    minus = F.struct(F.lit(-1).alias("sign"), F.col("old_n").alias("n"))
    gone = F.struct(F.lit(0).alias("sign"), F.col("added").alias("n"))
    deltas = F.when(F.col("late") == 0, F.array(plus)).when(F.col("late") == 1, F.array(minus, plus)).otherwise(F.array(gone))
    return running.select(*by, "version", "at_s", "late", F.explode(deltas).alias("d")).select(*by, "version", "at_s", F.col("d.sign").alias("sign"), F.col("d.n").alias("n"), "late")


def outcomes(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key and period: `corrected` where a retraction was given out, `dropped` where a record came after the cut-off."""
    told = changelog.where(F.col("sign") < 1).select(*keys, "period_s", F.when(F.col("sign") == 0, "dropped").otherwise("corrected").alias("outcome"))
    return told.distinct()


def current(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The aggregate a consumer holds after all deltas: the sum of sign times n."""
    return changelog.where(F.col("sign") != 0).groupBy(*keys, "period_s").agg(F.sum(F.col("sign") * F.col("n")).alias("n"), F.max("version").alias("version"))
