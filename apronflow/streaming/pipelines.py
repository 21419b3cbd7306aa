"""The three streams over position reports: archive, latest positions, detected events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apronflow.operators.upsert import latest_per_key, newest_wins, overwrite
from apronflow.streaming.events import EVENTS_DDL, detect_stream
from apronflow.streaming.tables import KeyedTable

LIVE_DDL = "icao24 string, callsign string, lat double, lon double, baro_alt_m double, on_ground boolean, velocity_ms double, track_deg double, vrate_ms double, category int, updated_at timestamp"
UPDATED = ["duration_s", "details"]
#: State in RocksDB, outside the heap and bounded, published as compressed changes; no space is set aside ahead of its use.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _trigger(writer, every: str | None):
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def deduplicated(states: DataFrame, lateness: str = "2 minutes") -> DataFrame:
    """Reports with a position, each identifier once; the state of seen identifiers ends with the watermark."""
    for key, value in STATE.items():
        states.sparkSession.conf.set(key, value)
    placed = states.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return placed.withWatermark("api_time", lateness).dropDuplicatesWithinWatermark(["icao24", "api_ts"])


def archive(states: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append-only Parquet by day and hour of the event.

    The rows of an hour are brought together before they are written, so a batch adds one file to each of its
    hours, not one for each task that holds state. api_time is api_ts as a timestamp and not carried along.
    """
    rows = deduplicated(states).drop("api_time").repartition(F.floor(F.col("api_ts") / 3600)).withColumn("api_time", F.timestamp_seconds("api_ts"))
    rows = rows.withColumn("dt", F.date_format("api_time", "yyyy-MM-dd")).withColumn("hr", F.date_format("api_time", "HH"))
    writer = rows.writeStream.queryName("archive").format("parquet").option("compression", "zstd").option("path", path).option("checkpointLocation", checkpoint).partitionBy("dt", "hr").outputMode("append")
    return _trigger(writer, every).start()


def latest_positions(states: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Latest position per aircraft; only a strictly newer report replaces one."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        placed = batch.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        last = latest_per_key(placed, ["icao24"], [F.col("api_ts"), F.col("poll_ts")]).withColumn("updated_at", F.col("api_time"))
        table.upsert(last, batch_id)

    return _trigger(states.writeStream.queryName("live").foreachBatch(sink).option("checkpointLocation", checkpoint), every).start()


def detected_events(states: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Events by event_id; an event told again only renews its duration and details.

    Without a trigger interval this is a replay that ends by itself, on the events' own clock.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        once = latest_per_key(batch, ["event_id"], [F.col("event_ts"), F.col("duration_s"), F.col("details")])
        table.upsert(once, batch_id)

    found = detect_stream(states, "event" if every is None else "processing")
    return _trigger(found.writeStream.queryName("events").foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("update"), every).start()


def live_table(spark, path: str) -> KeyedTable:
    return KeyedTable(spark, path, LIVE_DDL, ["icao24"], lambda held, batch: newest_wins(held, batch, ["icao24"], "updated_at"))


def events_table(spark, path: str) -> KeyedTable:
    return KeyedTable(spark, path, EVENTS_DDL, ["event_id"], lambda held, batch: overwrite(held, batch, ["event_id"], UPDATED))


def start_all(states: DataFrame, root: str, every: tuple[str | None, str | None, str | None] = ("60 seconds", "10 seconds", "30 seconds")) -> list[StreamingQuery]:
    """The three streams side by side, each with its own checkpoint under root."""
    spark, root = states.sparkSession, root.rstrip("/")
    return [
        archive(states, f"{root}/archive", f"{root}/checkpoints/archive", every[0]),
        latest_positions(states, live_table(spark, f"{root}/live"), f"{root}/checkpoints/live", every[1]),
        detected_events(states, events_table(spark, f"{root}/events"), f"{root}/checkpoints/events", every[2]),
    ]


def run(states: DataFrame, root: str, every: tuple[str | None, str | None, str | None] = ("60 seconds", "10 seconds", "30 seconds")) -> None:
    """The three streams until one of them ends; the others are stopped, and its error, if any, is raised."""
    queries = start_all(states, root, every)
    try:
        while all(q.isActive for q in queries):
            states.sparkSession.streams.awaitAnyTermination(5)
        for q in queries:
            if not q.isActive and (error := q.exception()) is not None:
                raise error
    finally:
        for q in queries:
            q.stop()
        states.sparkSession.streams.resetTerminated()
