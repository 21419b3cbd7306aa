"""Consumers of weather messages and the keyed tables that they and the daily loads write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from apronflow.operators.upsert import greatest_per_key, overwrite, write_partitions
from apronflow.streaming.tables import KeyedTable

OBS_DDL = "station string, obs_ts timestamp_ntz, temp_c double, wind_speed_kmh double, wind_gust_kmh double, wind_dir_deg double, visibility_m double, ceiling_ft double, precip_last_hr_mm double, text_desc string, flight_category string, raw string"
ALERT_DDL = "alert_id string, airport string, event string, severity string, effective_ts timestamp_ntz, ends_ts timestamp_ntz, raw string"
ARRIVAL_DDL = "icao24 string, airport string, est_arrival_ts timestamp_ntz, callsign string, first_seen timestamp_ntz, last_seen timestamp_ntz"
OBS_KEYS, ALERT_KEYS, ARRIVAL_KEYS = ["station", "obs_ts"], ["alert_id", "airport"], ["icao24", "airport", "est_arrival_ts"]


def _table(spark: SparkSession, path: str, ddl: str, keys: list[str]) -> KeyedTable:
    return KeyedTable(spark, path, ddl, keys, lambda held, batch: overwrite(held, batch, keys))


def obs_table(spark: SparkSession, path: str) -> KeyedTable:
    """Observations by station and time; a later message overwrites all measures."""
    return _table(spark, path, OBS_DDL, OBS_KEYS)


def alert_table(spark: SparkSession, path: str) -> KeyedTable:
    return _table(spark, path, ALERT_DDL, ALERT_KEYS)


def arrival_table(spark: SparkSession, path: str) -> KeyedTable:
    return _table(spark, path, ARRIVAL_DDL, ARRIVAL_KEYS)


def gold_serving(spark: SparkSession, path: str, schema: str) -> KeyedTable:
    """The gold mart for serving, by day and airport."""
    return _table(spark, path, schema, ["flight_date", "airport"])


def outcome(value: Column, message: Column, keys: list[str]) -> Column:
    """What becomes of a message: undecodable (no JSON), non_object, unwritable (without its key), or written."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & message[k].isNotNull()
    json = F.get_json_object(value, "$")
    return F.when(json.isNull(), "undecodable").when(~F.ltrim(value).startswith("{"), "non_object").when(~F.coalesce(whole, F.lit(False)), "unwritable").otherwise("written")


def consume(messages: DataFrame, table: KeyedTable, counts: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Messages (value, JSON text) into a keyed table; what cannot be written is counted and left out, and never stops the stream.

    Offsets are committed after a batch is written, and both the upsert and the counts (outcome and n
    per batch, under counts) are the same when a batch comes again. Of several messages with one key
    in a batch the greatest by its columns counts.
    """
    schema = T._parse_datatype_string(table.schema)
    rest = [f.name for f in schema if f.name not in table.keys]

    def sink(batch: DataFrame, batch_id: int) -> None:
        value = F.col("value").cast("string")
        told = batch.select(value.alias("value"), F.from_json(value, schema).alias("m")).persist()
        try:
            rows = told.select(outcome(F.col("value"), F.col("m"), table.keys).alias("outcome"), "m")
            rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{counts}/batch={batch_id}")
            good = rows.where(F.col("outcome") == "written").select("m.*")
            table.upsert(greatest_per_key(good, table.keys, rest).select(*schema.names))
        finally:
            told.unpersist()

    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def drops(spark: SparkSession, counts: str) -> DataFrame:
    """Messages by outcome over all batches."""
    return spark.read.parquet(f"{counts}/batch=*").groupBy("outcome").agg(F.sum("n").alias("n"))


def load_days(arrivals: DataFrame, path: str) -> None:
    """Reported arrivals by day: replaces the days that arrivals has rows for, one row per key.

    The upstream list of a day fills up for days, so a daily load pulls the last three again; that
    heals late data without touching older days.
    """
    one = greatest_per_key(arrivals, ARRIVAL_KEYS, ["callsign", "first_seen", "last_seen"])
    write_partitions(one.withColumn("day", F.to_date("est_arrival_ts")), path, "day")
