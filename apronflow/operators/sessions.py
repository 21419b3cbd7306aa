"""Sessions: rows of one key whose times follow each other within a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apronflow.operators.asof import spread

SHARD_S = 86_400


def sessionize(df: DataFrame, key: str, ts: str, gap_s: int, shard_s: int = SHARD_S) -> DataFrame:
    """df with session_s, the time at which the row's session began.

    ts is a long. A row more than gap_s after the one before begins a session; rows at one time share
    one. Rows with a null key or time have a null session and are spread over windows. Sessions are found in shards of one key and
    day, so a hot key is spread; a session that reaches over shards is joined from one row per shard.
    """
    shard = F.when(F.col(key).isNull() | F.col(ts).isNull(), spread(key, ts)).otherwise(F.floor(F.col(ts) / shard_s))
    line = Window.partitionBy(key, "__shard").orderBy(ts)
    rows = df.withColumn("__shard", shard)
    begins = F.lag(ts).over(line).isNull() | (F.col(ts) - F.lag(ts).over(line) > gap_s)
    rows = rows.withColumn("__new", F.when(begins, F.col(ts))).withColumn("__local", F.max("__new").over(line))
    edges = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, "__shard").agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.max("__local").alias("__tail"))
    along = Window.partitionBy(key).orderBy("__shard")
    edges = edges.withColumn("__joins", F.coalesce(F.col("__first") - F.lag("__last").over(along) <= gap_s, F.lit(False)))
    # a shard that is one session going on has no beginning of its own to hand on
    own = F.when(~(F.col("__joins") & (F.col("__tail") == F.col("__first"))), F.col("__tail"))
    edges = edges.withColumn("__own", own).withColumn("__from", F.last("__own", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)))
    carried = edges.where("__joins").select(key, "__shard", "__first", "__from")
    out = rows.join(carried, [key, "__shard"], "left")
    session = F.when(F.col("__local") == F.col("__first"), F.col("__from")).otherwise(F.col("__local"))
    return out.select(*df.columns, F.when(F.col(key).isNotNull() & F.col(ts).isNotNull(), session).alias("session_s"))
