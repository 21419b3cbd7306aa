"""The tables of a data folder, read by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.operators import keys
from apronflow.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of the folder; columns and filters are pruned at the scan by Catalyst.

    Times without zone mean UTC, so the session is set to UTC where it is not.
    """
    ship(spark)
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def readings(messages: DataFrame, *columns: str) -> DataFrame:
    """State messages under their normalised identifier: icao24, ts and the columns asked for.

    Copies are still there; rows without icao24 or api_ts have no identifier and are left out.
    Doubles lose their NaN.
    """
    kinds = dict(messages.dtypes)
    out = messages.select(
        keys.icao("icao24").alias("icao24"),
        keys.seconds("api_ts").alias("ts"),
        *[(keys.number(c) if kinds[c] in ("double", "float") else F.col(c)).alias(c) for c in columns],
    )
    return out.where(F.col("icao24").isNotNull() & F.col("ts").isNotNull())


def distinct_readings(messages: DataFrame, *columns: str) -> DataFrame:
    """readings with one row per (icao24, ts): copies, which agree, are reduced in each task before the shuffle.

    Should copies differ after all, each column takes its greatest known value. Columns must be of
    numbers or booleans, so that the aggregation is by hash.
    """
    return readings(messages, *columns).groupBy("icao24", "ts").agg(*[F.max(c).alias(c) for c in columns])
