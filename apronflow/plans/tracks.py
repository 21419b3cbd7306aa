"""Queries on position reports, functions and checks: one per operator that the marts do not show on their own."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apronflow.functions import geo
from apronflow.functions.common import event_id, half_up
from apronflow.operators import keys, quality
from apronflow.operators.sessions import sessionize
from apronflow.operators.upsert import latest_per_key, newest_wins, overwrite
from apronflow.session import scratch
from apronflow.sources import envelope, views
from apronflow.plans.readings import changelog_sql
from apronflow.sources.tables import distinct_readings, readings, table
from apronflow.streaming import events, pipelines, retractions

MEASURES = ("lat", "lon", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category")


def flight_category(spark: SparkSession, folder: str) -> DataFrame:
    return views.weather_obs(spark, folder).select("station", "obs_ts", "ceiling_ft", "visibility_m", "flight_category")


def haversine_nearest(spark: SparkSession, folder: str) -> DataFrame:
    near = views.live_states(spark, folder).select("icao24", geo.nearest_airport(F.col("lat"), F.col("lon")).alias("n"))
    return near.select("icao24", "n.airport", half_up(F.col("n.dist_km"), 5).alias("dist_km"))


def track_delta(spark: SparkSession, folder: str) -> DataFrame:
    rows = readings(table(spark, folder, "state_messages"), "track_deg").distinct().where(F.col("track_deg").isNotNull())
    return rows.select("icao24", "ts", half_up(geo.track_delta(F.lit(224.0), F.col("track_deg")), 4).alias("off_runway_deg"))


def event_ids(spark: SparkSession, folder: str) -> DataFrame:
    ev = views.flight_events(spark, folder)
    return ev.select("event_id", event_id(F.col("icao24"), F.col("event_type"), keys.epoch("event_ts")).alias("derived_id"))


def dead_reckon(spark: SparkSession, folder: str) -> DataFrame:
    s = views.live_states(spark, folder)
    lat, lon = geo.dead_reckon(F.col("lat"), F.col("lon"), F.col("track_deg"), F.col("velocity_ms"), F.col("category") * 10)
    return s.select("icao24", half_up(lat, 8).alias("lat"), half_up(lon, 8).alias("lon"))


def latest_position(spark: SparkSession, folder: str) -> DataFrame:
    return views.live_states(spark, folder).select("icao24", "ts", "callsign", "lat", "lon", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category")


def bronze_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """The archive as a batch: one row per identifier with a position, by day and hour."""
    rows = readings(table(spark, folder, "state_messages"), "lat", "lon").where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    at = F.timestamp_seconds("ts")
    return rows.dropDuplicates(["icao24", "ts"]).select("icao24", "ts", "lat", "lon", F.date_format(at, "yyyy-MM-dd").alias("dt"), F.date_format(at, "HH").alias("hr"))


def gap_sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = sessionize(readings(table(spark, folder, "state_messages")).distinct(), "icao24", "ts", 90)
    return rows.groupBy("icao24", "session_s").agg(F.max("ts").alias("end_s"), F.count(F.lit(1)).alias("readings"))


def flight_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Of each ping, within its flight (pings at most 90 s apart): degrees turned in the last 480 s and length of the climb that goes on.

    A turn counts at the later of its two pings. Flights are short, so no window is long.
    """
    rows = distinct_readings(table(spark, folder, "state_messages"), "track_deg", "vrate_ms", "on_ground").where(F.col("track_deg").isNotNull())
    rows = sessionize(rows, "icao24", "ts", 90)
    line = Window.partitionBy("icao24", "session_s").orderBy("ts")
    rows = rows.withColumn("turn", F.coalesce(F.abs(geo.track_delta(F.lag("track_deg").over(line), F.col("track_deg"))), F.lit(0.0)).cast("decimal(12,4)"))
    climbs = F.coalesce((F.col("vrate_ms") > 3) & ~F.col("on_ground"), F.lit(False))
    rows = rows.withColumn("climbs", climbs).withColumn("island", F.count_if(~climbs).over(line))
    run = F.when(F.col("climbs"), F.count_if(F.col("climbs")).over(Window.partitionBy("icao24", "session_s", "island").orderBy("ts"))).otherwise(0)
    return rows.select("icao24", "ts", F.sum("turn").over(line.rangeBetween(-480, 0)).cast("double").alias("turned_deg"), run.cast("long").alias("climb_run"))


def track_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Kind of each track with eight positions or more, by its last position and whether it was ever in the air."""
    rows = readings(table(spark, folder, "state_messages"), *MEASURES).where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).dropDuplicates(["icao24", "ts"])
    t = rows.groupBy("icao24").agg(
        F.count(F.lit(1)).alias("n"), *[F.max_by(c, "ts").alias(f"last_{c}") for c in ("lat", "lon", "on_ground", "baro_alt_m")], F.bool_or(~F.col("on_ground")).alias("flew"),
        F.bool_and("on_ground").alias("only_ground"), F.min(F.when(~F.col("on_ground"), F.coalesce("baro_alt_m", F.lit(9e9)))).alias("low"), (F.max("ts") - F.min("ts")).alias("span_s"),
    ).where(F.col("n") >= 8)
    near = geo.nearest_airport(F.col("last_lat"), F.col("last_lon"))
    t = t.withColumn("near", near).withColumn("alt", F.coalesce("last_baro_alt_m", F.lit(9e9)))
    kind = (
        F.when(F.col("last_on_ground") & F.col("flew") & (F.col("near.dist_km") < 4), "arrival")
        .when(~F.col("last_on_ground") & (F.col("alt") < 450) & (F.col("near.dist_km") < 5), "coverage_loss")
        .when(F.col("only_ground"), "taxi_only")
        .when(F.col("flew") & (F.col("low") > 2500), "overflight")
    )
    return t.select("icao24", "n", kind.alias("kind"), F.col("near.airport").alias("airport"), half_up(F.col("near.dist_km"), 3).alias("last_km"), "span_s").where(F.col("kind").isNotNull())


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Positions by identifier, as they came before and after the middle of all poll times."""
    rows = readings(table(spark, folder, "state_messages"), "poll_ts", "lat", "lon", "on_ground").where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    middle = rows.agg((F.min("poll_ts") + F.floor((F.max("poll_ts") - F.min("poll_ts")) / 2)).alias("m")).scalar()
    one = lambda df: latest_per_key(df, ["icao24"], [F.col("ts"), F.col("poll_ts"), F.col("lat"), F.col("lon"), F.col("on_ground")])
    return one(rows.where(F.col("poll_ts") <= middle)), one(rows.where(F.col("poll_ts") > middle))


def upsert_guarded(spark: SparkSession, folder: str) -> DataFrame:
    held, batch = _halves(spark, folder)
    return newest_wins(held, batch, ["icao24"], "ts").select("icao24", "ts", "lat", "lon", "on_ground")


def upsert_partial(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as it was first told, with the duration and details it was last told with."""
    raw = table(spark, folder, "flight_events").select("event_id", F.nullif(F.trim("callsign"), F.lit("")).alias("callsign"), F.col("duration_s").cast("int").alias("duration_s"), "details", "detected_at")
    order = F.struct("detected_at", "callsign", "duration_s", "details")
    pick = F.struct("callsign", "duration_s", "details", "detected_at")
    first = raw.groupBy("event_id").agg(F.min_by(pick, order).alias("x")).select("event_id", "x.*")
    last = raw.groupBy("event_id").agg(F.max_by(pick, order).alias("x")).select("event_id", "x.*")
    return overwrite(first, last, ["event_id"], ["duration_s", "details"]).drop("detected_at")


def anti_loaded_months(spark: SparkSession, folder: str) -> DataFrame:
    """Landed months that are not loaded: those of bronze without those that silver's first year holds."""
    bronze = views.ontime_bronze(spark, folder)
    loaded = bronze.where(F.col("FlightDate") < "1996-01-01").select("_ingest_ym").where(F.substring("_ingest_ym", 2, 2).cast("int") % 2 == 0).distinct()
    return bronze.select("_ingest_ym").distinct().join(loaded, "_ingest_ym", "left_anti")


def alert_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts as published: a repetition with the same content is left out."""
    al = table(spark, folder, "weather_alerts").select("alert_id", keys.place("airport").alias("airport"), "event", "severity", "effective_ts", "ends_ts")
    al = al.where(F.col("alert_id").isNotNull() & F.col("airport").isNotNull())
    return envelope.changes_only(al, ["alert_id", "airport"], ["event", "severity", "effective_ts", "ends_ts"], ["effective_ts", "ends_ts", "event", "severity"])


def envelope_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through JSON and back."""
    raw = table(spark, folder, "state_messages")
    text = raw.select(F.to_json(F.struct(*[keys.number(c).alias(c) if c in ("lon", "lat", "baro_alt_m", "velocity_ms", "track_deg", "vrate_ms") else F.col(c) for c in envelope.ENVELOPE.names])).alias("value"))
    return envelope.decode(text).drop("api_time").distinct()


def state_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through positional arrays, as a poll gives them, and back."""
    raw = table(spark, folder, "state_messages")
    slots = [F.lit(None).cast("string")] * 18
    for name, at in envelope.SLOTS.items():
        slots[at] = F.col(name).cast("string")
    polls = raw.select(F.col("poll_ts").alias("p"), F.col("api_ts").alias("time"), F.array(F.array(*slots)).alias("states"))
    return envelope.state_vectors(polls, F.col("p")).select("icao24", "api_ts", "poll_ts", "callsign", "on_ground", "category").distinct()


def unit_conversion(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities in their reported units to fixed ones, by way of the observation parser."""
    obs = views.weather_obs(spark, folder)
    q = lambda c, unit: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("value"), F.lit(unit).alias("unitCode")))
    layer = lambda base, amount: F.struct(F.struct(base.alias("value"), F.lit("wmoUnit:m").alias("unitCode")).alias("base"), F.lit(amount).alias("amount"))
    record = F.to_json(F.struct(
        F.date_format("obs_ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"), q("wind_speed_kmh", "wmoUnit:m_s-1").alias("windSpeed"), q("wind_gust_kmh", "wmoUnit:km_h-1").alias("windGust"),
        q("precip_last_hr_mm", "unit:m").alias("precipitationLastHour"), q("temp_c", "wmoUnit:K").alias("temperature"),
        F.array(layer(F.lit(100.0), "FEW"), layer(F.col("ceiling_ft"), "ovc"), layer(F.lit(6000.0), "BKN")).alias("cloudLayers"),
    ))
    out = envelope.observation(obs.select("station", record.alias("properties")), F.col("station"))
    return out.select("station", "obs_ts", half_up(F.col("wind_speed_kmh"), 3).alias("wind_speed_kmh"), "wind_gust_kmh", half_up(F.col("precip_last_hr_mm"), 2).alias("precip_last_hr_mm"), "temp_c", half_up(F.col("ceiling_ft"), 2).alias("ceiling_ft"))


def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.repeated_keys(table(spark, folder, "flight_events"), ["event_id"])


def dq_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return quality.outside(table(spark, folder, "flight_events"), "event_type", ["arrival", "holding"])


def dq_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Expectations on events, with the number of rows that fail each."""
    held = F.col("event_type") == "holding"
    return quality.failing(table(spark, folder, "flight_events"), {
        "icao24_not_empty": F.trim("icao24") != "", "holding_has_duration": ~held | F.col("duration_s").isNotNull(), "callsign_not_null": F.col("callsign").isNotNull(), "detected_after_event": F.col("detected_at") >= F.col("event_ts"),
    })


def detect_events(spark: SparkSession, folder: str) -> DataFrame:
    return events.detect(readings(table(spark, folder, "state_messages"), "callsign", *MEASURES))


def track_files(spark: SparkSession, folder: str) -> DataFrame:
    """Captured messages through newline-delimited files and back: each with its place in its aircraft's order."""
    where = _place(spark)
    raw = table(spark, folder, "state_messages")
    text = raw.select(F.to_json(F.struct(*[keys.number(c).alias(c) if c in ("lon", "lat", "baro_alt_m", "velocity_ms", "track_deg", "vrate_ms") else F.col(c) for c in envelope.ENVELOPE.names])).alias("value"))
    text.write.text(where)
    return envelope.tracks(spark, where).select("icao24", "api_ts", "poll_ts", "place")


def _kind(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: detect_events(spark, folder).where(F.col("event_type") == kind)


def _stream(spark: SparkSession, folder: str) -> DataFrame:
    """The test messages as a stream of files, with normalised identifiers."""
    schema = table(spark, folder, "state_messages").schema
    raw = spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/state_messages.parquet*")
    clean = {c: keys.number(c) for c in ("lon", "lat", "baro_alt_m", "velocity_ms", "track_deg", "vrate_ms")}
    rows = raw.withColumns({"icao24": keys.icao("icao24"), "api_ts": keys.seconds("api_ts"), **clean})
    return rows.where(F.col("icao24").isNotNull() & F.col("api_ts").isNotNull()).select(*envelope.ENVELOPE.names, F.timestamp_seconds("api_ts").alias("api_time"))


def _place(spark: SparkSession) -> str:
    return scratch(spark, f"stream-{uuid.uuid4().hex}")


def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    where = _place(spark)
    pipelines.archive(_stream(spark, folder), f"{where}/archive", f"{where}/offsets").awaitTermination()
    return spark.read.parquet(f"{where}/archive").select("icao24", F.col("api_ts").alias("ts"), "lat", "lon", F.date_format("api_time", "yyyy-MM-dd").alias("dt"), F.date_format("api_time", "HH").alias("hr"))


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    where = _place(spark)
    held = pipelines.live_table(spark, f"{where}/live")
    pipelines.latest_positions(_stream(spark, folder), held, f"{where}/offsets").awaitTermination()
    return held.read().select("icao24", F.unix_seconds("updated_at").alias("ts"), "lat", "lon", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    where = _place(spark)
    held = pipelines.events_table(spark, f"{where}/events")
    pipelines.detected_events(_stream(spark, folder), held, f"{where}/offsets").awaitTermination()
    return held.read()


def sample_tracks() -> list[tuple]:
    """Messages of seven flights at KJFK that show what each rule tells, and what it does not.

    t1 lands; t2 is lost on short final; t3 holds, then leaves; t4 goes around; t5 passes high over the
    field; t6 taxies; t7 flies the racetrack of t3 as a light aircraft.
    """
    lat, lon = geo.AIRPORTS["KJFK"]
    out = []

    def ping(who: str, ts: int, dlat: float, dlon: float, alt: float | None, speed: float = 80.0, track: float = 220.0, climb: float | None = -4.0, ground: bool = False, category: int = 4) -> None:
        out.append((ts + 1003, ts + 1000, who, "T1", lon + dlon, lat + dlat, alt, ground, speed, track, climb, category))

    for i in range(10):
        for who in ("t1", "t2"):
            ping(who, 30 * i, 0.01 * (10 - i), 0.0, 900.0 - 80 * i)
        ping("t5", 30 * i, 0.03 * i, 0.0, 9000.0, 220.0, climb=0.0)
        ping("t6", 30 * i, 0.0, 0.0, None, 8.0, climb=None, ground=True)
    for i in range(3):
        ping("t1", 300 + 30 * i, 0.0, 0.0, None, 10.0, climb=None, ground=True)
    for i in range(17):
        angle = 2 * math.pi * i * 30 / 200
        for who, category in (("t3", 4), ("t7", 8)):
            ping(who, 30 * i, 0.03 * math.sin(angle), 0.03 * math.cos(angle), 2400.0, 120.0, math.degrees(-angle) % 360, 0.0, category=category)
    for i in range(6):
        for who, category in (("t3", 4), ("t7", 8)):
            ping(who, 510 + 30 * i, 0.0, 0.05 * i, 2400.0, 120.0, 90.0, 0.0, category=category)
    for i in range(8):
        ping("t4", 30 * i, 0.01 * (8 - i), 0.0, 750.0 - 80 * i)
    for i in range(6):
        ping("t4", 240 + 30 * i, -0.01 * i, 0.0, 190.0 + 110 * i, climb=6.0)
    return out


TOLD = ("event_id", "icao24", "callsign", "event_type", "airport", "event_ts", "duration_s")


def detect_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the sample tracks, as a batch."""
    rows = spark.createDataFrame(sample_tracks(), envelope.ENVELOPE)
    return events.detect(rows.withColumn("ts", F.col("api_ts"))).select(*TOLD)


def stream_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The same events by the stream, over files of a hundred seconds each."""
    where = _place(spark)
    rows = spark.createDataFrame([*sample_tracks(), (9_003, 9_000, "end", None, 0.0, 0.0, None, False, None, None, None, None)], envelope.ENVELOPE)
    for i, part in enumerate(sorted({r[1] // 100 for r in sample_tracks()} | {90})):
        rows.where(F.floor(F.col("api_ts") / 100) == part).coalesce(1).write.parquet(f"{where}/in/{i:03d}")
    held = pipelines.events_table(spark, f"{where}/events")
    pipelines.detected_events(envelope.files(spark, f"{where}/in/*"), held, f"{where}/offsets").awaitTermination()
    return held.read().select(*TOLD)


def stream_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changelog of message counts as the stream gives it; dropped records are added up."""
    where = _place(spark)
    rows = _stream(spark, folder).select("icao24", F.col("api_ts").cast("string").alias("record"), F.col("api_ts").alias("event_s"), keys.seconds("poll_ts").alias("arrival_s")).where(F.col("arrival_s").isNotNull())
    out = retractions.deltas(rows, lateness="0 seconds").writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{where}/deltas/batch={i}"))
    out.option("checkpointLocation", f"{where}/offsets").trigger(availableNow=True).start().awaitTermination()
    told = spark.read.schema(retractions.DELTAS_DDL).parquet(f"{where}/deltas/batch=*")
    lost = told.where(F.col("sign") == 0).groupBy("icao24", "period_s", "version", "at_s", "sign").agg(F.sum("n").alias("n"))
    return told.where(F.col("sign") != 0).unionByName(lost)


def stream_retractions(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per aircraft and hour that the deltas of the stream add up to."""
    told = stream_changes(spark, folder)
    return told.where(F.col("sign") != 0).groupBy("icao24", "period_s").agg(F.sum(F.col("sign") * F.col("n")).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        flight_category, haversine_nearest, track_delta, event_ids, dead_reckon, latest_position, bronze_dedupe, gap_sessions, flight_sequences, track_files, track_scan, upsert_guarded, upsert_partial, anti_loaded_months,
        alert_changes, envelope_decode, state_vectors, unit_conversion, dq_unique, dq_accepted, dq_checks, detect_events, detect_sample, stream_sample, stream_dedupe, stream_latest, stream_events, stream_changes, stream_retractions,
    )
} | {"detect_arrival": _kind("arrival"), "detect_holding": _kind("holding"), "detect_goaround": _kind("go_around")}

_W = views.with_views
_R = lambda e, d: f"floor(({e}) * {float(10**d)}::DOUBLE + 0.5::DOUBLE) / {float(10**d)}::DOUBLE"
_ID = "lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, CASE WHEN api_ts < 100000000000 THEN api_ts ELSE api_ts // 1000 END AS ts"
_PLACED = "icao24 IS NOT NULL AND api_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)"
_HAV = lambda a, b: f"2 * 6371.0 * asin(sqrt(power(sin(radians({a} - lat) / 2), 2) + cos(radians(lat)) * cos(radians({a})) * power(sin(radians({b} - lon) / 2), 2)))"
_NEAR = ", ".join(f"{_HAV(a, b)} AS d{i}" for i, (a, b) in enumerate(geo.AIRPORTS.values()))
_CODE = "CASE least(d0, d1, d2) WHEN d0 THEN 'KJFK' WHEN d1 THEN 'KLGA' ELSE 'KEWR' END"
_NN = lambda c: f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}"
_DEDUPE = f"SELECT DISTINCT icao24, ts, lat, lon, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%Y-%m-%d') AS dt, strftime(to_timestamp(ts) AT TIME ZONE 'UTC', '%H') AS hr FROM (SELECT {_ID}, lat, lon FROM state_messages WHERE {_PLACED})"

#: What the rules must tell of the sample tracks: kind, begin of the approach or event (its identity), time, duration.
_SAMPLE = """SELECT substr(sha1(icao24 || '|' || event_type || '|' || start), 1, 16) AS event_id, icao24, 'T1' AS callsign, event_type, 'KJFK' AS airport, event_ts::BIGINT AS event_ts, duration_s::INTEGER AS duration_s FROM (VALUES
  ('t1', 'arrival', 1120, 1300, NULL), ('t2', 'arrival', 1120, 1270, NULL), ('t3', 'holding', 1000, 1000, 600), ('t4', 'go_around', 1240, 1240, NULL)) v(icao24, event_type, start, event_ts, duration_s)"""

SQL = {
    "flight_category": f"{_W('ob')} SELECT station, obs_ts, ceiling_ft, visibility_m, flight_category FROM ob",
    "haversine_nearest": f"{_W('ls')} SELECT icao24, {_CODE} AS airport, {_R('least(d0, d1, d2)', 5)} AS dist_km FROM (SELECT icao24, {_NEAR} FROM ls)",
    "track_delta": f"SELECT icao24, ts, {_R('CASE WHEN d = -180 THEN 180 ELSE d END', 4)} AS off_runway_deg FROM (SELECT icao24, ts, (((track_deg - 224.0::DOUBLE + 180) % 360 + 360) % 360) - 180 AS d FROM (SELECT DISTINCT {_ID}, track_deg FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL AND track_deg IS NOT NULL AND NOT isnan(track_deg)))",
    "event_ids": f"{_W('ev')} SELECT event_id, substr(sha1(icao24 || '|' || event_type || '|' || epoch(event_ts)::BIGINT::VARCHAR), 1, 16) AS derived_id FROM ev",
    "dead_reckon": f"""{_W('ls')}, m AS (SELECT *, track_deg IS NOT NULL AND velocity_ms IS NOT NULL AND velocity_ms > 0 AND category > 0 AS go, velocity_ms * least((category * 10)::DOUBLE, 45.0::DOUBLE) / 6371000 AS r FROM ls)
SELECT icao24, {_R('CASE WHEN go THEN lat + degrees(r * cos(radians(track_deg))) ELSE lat END', 8)} AS lat, {_R('CASE WHEN go THEN lon + degrees(r * sin(radians(track_deg)) / cos(radians(lat))) ELSE lon END', 8)} AS lon FROM m""",
    "latest_position": f"{_W('ls')} SELECT icao24, ts, callsign, lat, lon, baro_alt_m, on_ground, velocity_ms, track_deg, vrate_ms, category FROM ls",
    "bronze_dedupe": _DEDUPE,
    "gap_sessions": f"""WITH r AS (SELECT DISTINCT {_ID} FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL), g AS (SELECT *, CASE WHEN coalesce(ts - lag(ts) OVER w > 90, true) THEN ts END AS b FROM r WINDOW w AS (PARTITION BY icao24 ORDER BY ts)),
s AS (SELECT *, max(b) OVER (PARTITION BY icao24 ORDER BY ts) AS session_s FROM g) SELECT icao24, session_s, max(ts) AS end_s, count(*) AS readings FROM s GROUP BY 1, 2""",
    "track_files": "SELECT icao24, api_ts, poll_ts, row_number() OVER (PARTITION BY icao24 ORDER BY api_ts, poll_ts) AS place FROM state_messages WHERE icao24 IS NOT NULL",
    "flight_sequences": f"""WITH r AS (SELECT icao24, ts, max(track_deg) AS track_deg, max(vrate_ms) AS vrate_ms, bool_or(on_ground) AS on_ground FROM (SELECT {_ID}, {_NN('track_deg')}, {_NN('vrate_ms')}, on_ground FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL) GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN coalesce(ts - lag(ts) OVER w > 90, true) THEN ts END AS b FROM r WHERE track_deg IS NOT NULL WINDOW w AS (PARTITION BY icao24 ORDER BY ts)), s AS (SELECT *, max(b) OVER (PARTITION BY icao24 ORDER BY ts) AS session_s FROM g),
d AS (SELECT *, ((track_deg - lag(track_deg) OVER w + 180) % 360 + 360) % 360 - 180 AS t, coalesce(vrate_ms > 3 AND NOT on_ground, false) AS climbs FROM s WINDOW w AS (PARTITION BY icao24, session_s ORDER BY ts)),
i AS (SELECT *, coalesce(abs(t), 0)::DECIMAL(12,4) AS turn, count(*) FILTER (NOT climbs) OVER (PARTITION BY icao24, session_s ORDER BY ts) AS island FROM d)
SELECT icao24, ts, (sum(turn) OVER (PARTITION BY icao24, session_s ORDER BY ts RANGE BETWEEN 480 PRECEDING AND CURRENT ROW))::DOUBLE AS turned_deg, CASE WHEN climbs THEN count(*) FILTER (climbs) OVER (PARTITION BY icao24, session_s, island ORDER BY ts) ELSE 0 END AS climb_run FROM i""",
    "track_scan": f"""WITH r AS (SELECT DISTINCT {_ID}, lat, lon, on_ground, {_NN('baro_alt_m')} FROM state_messages WHERE {_PLACED}),
t AS (SELECT icao24, count(*) AS n, arg_max(lat, ts) AS lat, arg_max(lon, ts) AS lon, arg_max(on_ground, ts) AS g, arg_max(coalesce(baro_alt_m, 9e9), ts) AS alt, bool_or(NOT on_ground) AS flew, bool_and(on_ground) AS only_ground,
  min(CASE WHEN NOT on_ground THEN coalesce(baro_alt_m, 9e9) END) AS low, max(ts) - min(ts) AS span_s FROM r GROUP BY 1 HAVING count(*) >= 8),
k AS (SELECT *, {_NEAR} FROM t), j AS (SELECT *, least(d0, d1, d2) AS d, CASE WHEN g AND flew AND least(d0, d1, d2) < 4 THEN 'arrival' WHEN NOT g AND alt < 450 AND least(d0, d1, d2) < 5 THEN 'coverage_loss' WHEN only_ground THEN 'taxi_only' WHEN flew AND low > 2500 THEN 'overflight' END AS kind FROM k)
SELECT icao24, n, kind, {_CODE} AS airport, {_R('d', 3)} AS last_km, span_s FROM j WHERE kind IS NOT NULL""",
    "upsert_guarded": f"""WITH r AS (SELECT {_ID}, poll_ts, lat, lon, on_ground FROM state_messages WHERE {_PLACED}), m AS (SELECT min(poll_ts) + (max(poll_ts) - min(poll_ts)) // 2 AS m FROM r),
h AS (SELECT *, CASE WHEN poll_ts <= m THEN 1 ELSE 0 END AS held FROM r, m), o AS (SELECT *, row_number() OVER (PARTITION BY icao24, held ORDER BY ts DESC, poll_ts DESC, lat DESC, lon DESC, on_ground DESC) AS k FROM h)
SELECT icao24, ts, lat, lon, on_ground FROM o WHERE k = 1 QUALIFY row_number() OVER (PARTITION BY icao24 ORDER BY ts DESC, held DESC) = 1""",
    "upsert_partial": """WITH r AS (SELECT event_id, nullif(trim(callsign), '') AS callsign, duration_s, details, detected_at FROM flight_events),
a AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY detected_at NULLS FIRST, callsign NULLS FIRST, duration_s NULLS FIRST, details NULLS FIRST) = 1),
z AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY detected_at DESC NULLS LAST, callsign DESC NULLS LAST, duration_s DESC NULLS LAST, details DESC NULLS LAST) = 1)
SELECT a.event_id, a.callsign, z.duration_s, z.details FROM a JOIN z USING (event_id)""",
    "anti_loaded_months": f"{_W('bz')} SELECT DISTINCT _ingest_ym FROM bz WHERE _ingest_ym NOT IN (SELECT _ingest_ym FROM bz WHERE FlightDate < '1996-01-01' AND substr(_ingest_ym, 2, 2)::INTEGER % 2 = 0)",
    "alert_changes": """WITH a AS (SELECT alert_id, upper(regexp_replace(airport, '\\s', '', 'g')) AS airport, event, severity, effective_ts, ends_ts FROM weather_alerts WHERE alert_id IS NOT NULL AND airport IS NOT NULL) SELECT DISTINCT * FROM a""",
    "envelope_decode": f"SELECT DISTINCT poll_ts, api_ts, icao24, callsign, {', '.join(_NN(c) for c in ('lon', 'lat', 'baro_alt_m', 'velocity_ms', 'track_deg', 'vrate_ms'))}, on_ground, category FROM state_messages",
    "state_vectors": "SELECT DISTINCT icao24, api_ts, poll_ts, nullif(trim(callsign), '') AS callsign, on_ground, category FROM state_messages WHERE icao24 IS NOT NULL",
    "unit_conversion": f"{_W('ob')} SELECT station, obs_ts, {_R('wind_speed_kmh * 3.6::DOUBLE', 3)} AS wind_speed_kmh, wind_gust_kmh, {_R('precip_last_hr_mm * 1000.0::DOUBLE', 2)} AS precip_last_hr_mm, NULL::DOUBLE AS temp_c, {_R('least(ceiling_ft, 6000.0::DOUBLE) * 3.28084::DOUBLE', 2)} AS ceiling_ft FROM ob",
    "dq_unique": "SELECT event_id, count(*) AS n FROM flight_events GROUP BY 1 HAVING count(*) > 1",
    "dq_accepted": "SELECT event_type AS value, count(*) AS n FROM flight_events WHERE event_type NOT IN ('arrival', 'holding') GROUP BY 1",
    "dq_checks": """SELECT 'icao24_not_empty' AS "check", count(*) FILTER (NOT coalesce(trim(icao24) <> '', false)) AS n FROM flight_events UNION ALL SELECT 'holding_has_duration', count(*) FILTER (NOT coalesce(event_type <> 'holding' OR duration_s IS NOT NULL, false)) FROM flight_events
UNION ALL SELECT 'callsign_not_null', count(*) FILTER (callsign IS NULL) FROM flight_events UNION ALL SELECT 'detected_after_event', count(*) FILTER (NOT coalesce(detected_at >= event_ts, false)) FROM flight_events""",
    "stream_latest": f"{_W('ls')} SELECT icao24, ts, lat, lon, baro_alt_m, on_ground, velocity_ms, track_deg, vrate_ms, category FROM ls",
    "stream_dedupe": _DEDUPE,
    "detect_sample": _SAMPLE,
    "stream_sample": _SAMPLE,
    "stream_changes": changelog_sql("icao24, period_s, version, at_s, sign, n", "src = 'state_messages'"),
    "stream_retractions": f"""WITH r AS (SELECT icao24, ts, min(poll_ts) AS a FROM (SELECT {_ID}, poll_ts FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL AND poll_ts IS NOT NULL) GROUP BY 1, 2)
SELECT icao24, ts // 3600 * 3600 AS period_s, count(*) AS n FROM r WHERE a <= ts // 3600 * 3600 + 3600 + 21600 GROUP BY 1, 2""",
}
