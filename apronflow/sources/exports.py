"""Files and topics that leave the lake, and the readers that take them up again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Columns of the gold export by type; all others stay text.
WHOLE = ("arrivals_scheduled", "cancelled", "cancelled_weather", "arrivals_delayed_15", "obs_count")
REAL = ("avg_arr_delay_min", "p90_arr_delay_min", "weather_delay_min_total", "nas_delay_min_total", "pct_obs_ifr_or_worse", "min_visibility_sm", "min_ceiling_ft")


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. Only for marts whose size the grain bounds (day and airport), as one task writes it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """The gold export typed again: empty is null, whole numbers may be written as 12 or 12.0, anything unreadable is null."""
    text = spark.read.option("header", True).option("nullValue", "").csv(path)
    kind = {**{c: "whole" for c in WHOLE}, **{c: "real" for c in REAL}, "flight_date": "date"}

    def typed(c: str) -> Column:
        k = kind.get(c)
        if k == "date":
            return F.col(c).try_cast("date").alias(c)
        if k == "real":
            return F.col(c).try_cast("double").alias(c)
        return F.col(c).try_cast("double").cast("long").alias(c) if k == "whole" else F.col(c)

    return text.select(*[typed(c) for c in text.columns])


def read_arrivals(spark: SparkSession, path: str) -> DataFrame:
    """A day's reported arrivals from JSON records (icao24, callsign, airport, firstSeen, lastSeen in epoch seconds).

    Rows without icao24 or lastSeen are left out; a missing firstSeen takes lastSeen's value, which is also the estimated arrival.
    """
    raw = spark.read.schema("icao24 string, callsign string, airport string, firstSeen long, lastSeen long").json(path)
    rows = raw.where(F.col("icao24").isNotNull() & F.col("lastSeen").isNotNull())
    at = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return rows.select(
        F.lower(F.trim("icao24")).alias("icao24"), "airport", at(F.col("lastSeen")).alias("est_arrival_ts"), F.nullif(F.trim("callsign"), F.lit("")).alias("callsign"),
        at(F.coalesce("firstSeen", "lastSeen")).alias("first_seen"), at(F.col("lastSeen")).alias("last_seen"),
    )


def publish_json(parts: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One folder of JSON documents per part. A part that fails is told by its error and leaves the others alone."""
    told = {}
    for name, df in parts.items():
        try:
            df.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
            told[name] = "written"
        except Exception as error:  # noqa: BLE001 - the publisher goes on with the next part
            told[name] = f"failed: {str(error)[:200]}"
    return told


def to_kafka(df: DataFrame, servers: str, topic: str, key: str) -> None:
    """Rows as JSON under their key, acknowledged by all replicas (the connector must be on the class path)."""
    rows = df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option("topic", topic).save()


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """df, and what passes through it when it is written: rows, and the rows for which each condition holds. No second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]), seen
