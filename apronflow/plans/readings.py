"""The general pN_ queries on the test tables, and their SQL where SQL can tell the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.operators import dedupe, grid, intervals, keys, late, spikes, trips
from apronflow.sources.tables import distinct_readings, readings, table

SPIKE_RULES = spikes.Rules(
    (
        spikes.Limits("baro_alt_m", -500.0, 20_000.0, 500.0),
        spikes.Limits("velocity_ms", 0.0, 400.0, 30.0, level=True),
        spikes.Limits("vrate_ms", -100.0, 100.0, 15.0, level=True),
    )
)


def weather_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly visibility and ceiling of each station; a row without a ceiling says that there is none."""
    fields = [
        grid.Field("visibility_m", usable=F.col("visibility_m").between(0, 100_000) & ~F.isnan("visibility_m"), log=True),
        grid.Field("ceiling_ft", usable=F.col("ceiling_ft").between(0, 60_000) & ~F.isnan("ceiling_ft"), present=F.lit(True), open_level=25_000.0, log=True),
    ]
    obs = table(spark, folder, "weather_obs").select("station", "obs_ts", "visibility_m", "ceiling_ft")
    return grid.regular(obs, keys.place("station"), keys.epoch("obs_ts"), fields)


def p1_grid(spark: SparkSession, folder: str) -> DataFrame:
    return weather_grid(spark, folder).withColumnRenamed("source", "station")


def p1_known(spark: SparkSession, folder: str) -> DataFrame:
    """The slots that are not filled, with their values: what the imputation must leave as it is."""
    marked = weather_grid(spark, folder)
    field = lambda c: F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.col(f"{c}_filled").alias("filled"))
    rows = marked.select(F.col("source").alias("station"), "slot_ts", F.explode(F.array(field("visibility_m"), field("ceiling_ft"))).alias("x"))
    return rows.where(~F.col("x.filled")).select("station", "slot_ts", "x.field", F.floor(F.col("x.value") * 100 + 0.5).alias("hundredths"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    marked = weather_grid(spark, folder)
    names = F.array_compact(F.array(F.when(F.col("visibility_m_filled"), F.lit("visibility_m")), F.when(F.col("ceiling_ft_filled"), F.lit("ceiling_ft"))))
    return marked.select(F.col("source").alias("station"), "slot_ts", F.explode(names).alias("field"))


def alert_intervals(spark: SparkSession, folder: str) -> DataFrame:
    alerts = table(spark, folder, "weather_alerts").select("airport", "effective_ts", "ends_ts", "raw")
    expires = F.try_to_timestamp(F.get_json_object("raw", "$.expires"))
    end = F.coalesce(F.col("ends_ts").cast("timestamp"), expires)
    return alerts.select(keys.place("airport").alias("airport"), keys.epoch("effective_ts").alias("start_s"), F.unix_seconds(end).alias("end_s"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    out = intervals.periods_and_gaps(alert_intervals(spark, folder), "airport", "start_s", "end_s", max_gap=12 * 3600)
    return out.select(F.col("entity").alias("airport"), "kind", F.col("start_s").alias("start_ts"), F.col("end_s").alias("end_ts"))


def p4_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All of it: with durations, distances and places."""
    out = trips.stops_and_trips(distinct_readings(table(spark, folder, "state_messages"), "lat", "lon", "on_ground"))
    return out.withColumn("duration_s", F.col("end_ts") - F.col("start_ts"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return trips.stops_and_trips(distinct_readings(table(spark, folder, "state_messages"), "lat", "lon", "on_ground")).select("icao24", "kind", "start_ts", "end_ts")


def p5_flags(spark: SparkSession, folder: str) -> DataFrame:
    return spikes.implausible(distinct_readings(table(spark, folder, "state_messages"), "on_ground", "baro_alt_m", "velocity_ms", "vrate_ms"), SPIKE_RULES)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_flags(spark, folder).select("icao24", F.col("ts").alias("api_ts"), "field")


def message_changes(spark: SparkSession, folder: str) -> DataFrame:
    messages = readings(table(spark, folder, "state_messages"), "poll_ts")
    records = messages.select("icao24", F.col("ts").alias("event_s"), keys.seconds("poll_ts").alias("arrival_s")).where(F.col("arrival_s").isNotNull())
    return late.changes(records, ["event_s"], ["icao24"])


def event_changes(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "flight_events").select("event_id", keys.icao("icao24").alias("icao24"), keys.epoch("event_ts").alias("event_s"), keys.epoch("detected_at").alias("arrival_s"))
    whole = F.col("event_id").isNotNull() & F.col("icao24").isNotNull() & F.col("event_s").isNotNull() & F.col("arrival_s").isNotNull()
    return late.changes(events.where(whole), ["event_id"], ["icao24"])


def p6_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The changelog itself, both sources."""
    return message_changes(spark, folder).withColumn("src", F.lit("state_messages")).unionByName(event_changes(spark, folder).withColumn("src", F.lit("flight_events")))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = [late.outcomes(c, ["icao24"]).withColumn("src", F.lit(name)) for name, c in (("state_messages", message_changes(spark, folder)), ("flight_events", event_changes(spark, folder)))]
    return parts[0].unionByName(parts[1]).select("src", "icao24", F.col("period_s").alias("hour_ts"), "outcome")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.dropped_copies(readings(table(spark, folder, "state_messages"), "delivery_id"), ["icao24", "ts"], "delivery_id")


def p7_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The messages themselves, one copy each."""
    columns = ("delivery_id", "batch_id", "poll_ts", "callsign", "lon", "lat", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category")
    return dedupe.keep_one(readings(table(spark, folder, "state_messages"), *columns), ["icao24", "ts"], "delivery_id", unique=True, nulls=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_grid, p1_known, p2_found, p4_found, p4_trips, p5_found, p5_flags, p6_found, p6_changes, p7_found, p7_kept)
}

_MESSAGES = """
m AS (SELECT lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, delivery_id, poll_ts,
  CASE WHEN abs(api_ts) < 100000000000 THEN api_ts WHEN abs(api_ts) < 100000000000000 THEN api_ts // 1000
       WHEN abs(api_ts) < 100000000000000000 THEN api_ts // 1000000 ELSE api_ts // 1000000000 END AS ts
  FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL)"""

#: First arrivals of the records of both tables.
_RECORDS = f"""{_MESSAGES},
r AS (SELECT 'state_messages' AS src, icao24, ts AS event_s, min(poll_ts) AS arrival FROM m WHERE poll_ts IS NOT NULL GROUP BY icao24, ts
  UNION ALL SELECT 'flight_events', icao24, event_s, arrival FROM (
    SELECT event_id, lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, epoch(event_ts)::BIGINT AS event_s, min(epoch(detected_at)::BIGINT) AS arrival
    FROM flight_events WHERE event_id IS NOT NULL AND icao24 IS NOT NULL AND event_ts IS NOT NULL AND detected_at IS NOT NULL GROUP BY ALL))"""


def changelog_sql(columns: str, where: str = "true") -> str:
    """The changelog of counts per aircraft and hour, told from the counts before and after each arrival second."""
    return f"""
WITH {_RECORDS},
h AS (SELECT src, icao24, event_s // 3600 * 3600 AS period_s, arrival, arrival - (event_s // 3600 * 3600 + 3600) AS late FROM r WHERE {where}),
s AS (SELECT src, icao24, period_s, CASE WHEN late <= 300 THEN 0 WHEN late <= 21600 THEN 1 ELSE 2 END AS late, CASE WHEN late <= 300 THEN period_s + 3900 WHEN late <= 21600 THEN arrival ELSE period_s + 25200 END AS at_s FROM h),
g AS (SELECT src, icao24, period_s, late, at_s, count(*) AS added FROM s GROUP BY ALL),
c AS (SELECT a.src, a.icao24, a.period_s, a.late, a.at_s, a.added, coalesce(sum(b.added), 0) AS before, count(b.at_s) FILTER (b.late = 1) AS versions
  FROM g a LEFT JOIN g b ON b.src = a.src AND b.icao24 = a.icao24 AND b.period_s = a.period_s AND b.late < 2 AND b.at_s < a.at_s GROUP BY ALL),
d AS (SELECT *, CASE late WHEN 0 THEN 0 WHEN 1 THEN versions + 1 END::BIGINT AS version, unnest(CASE late WHEN 0 THEN [1] WHEN 1 THEN [-1, 1] ELSE [0] END) AS sign FROM c),
q AS (SELECT src, icao24, period_s, version, at_s, sign::INTEGER AS sign, CASE sign WHEN 1 THEN before + added WHEN -1 THEN before ELSE added END::BIGINT AS n, late::INTEGER AS late FROM d)
SELECT {columns} FROM q"""


SQL: dict[str, str] = {
    "p6_changes": changelog_sql("*"),
    "p1_known": """
WITH o AS (SELECT upper(regexp_replace(station, '\\s', '', 'g')) AS station, epoch(obs_ts)::BIGINT // 3600 * 3600 AS slot_ts, CASE WHEN visibility_m BETWEEN 0 AND 100000 AND NOT isnan(visibility_m) THEN visibility_m END AS v,
  CASE WHEN ceiling_ft BETWEEN 0 AND 60000 AND NOT isnan(ceiling_ft) THEN ceiling_ft END AS c FROM weather_obs WHERE station IS NOT NULL AND obs_ts IS NOT NULL),
g AS (SELECT station, slot_ts, round(avg(v), 3) AS v, round(avg(c), 3) AS c FROM o GROUP BY 1, 2)
SELECT station, slot_ts, 'visibility_m' AS field, floor(v * 100 + 0.5)::BIGINT AS hundredths FROM g WHERE v IS NOT NULL UNION ALL SELECT station, slot_ts, 'ceiling_ft', floor(c * 100 + 0.5)::BIGINT FROM g""",
    "p1_found": """
WITH o AS (SELECT upper(regexp_replace(station, '\\s', '', 'g')) AS station, epoch(obs_ts)::BIGINT // 3600 * 3600 AS h, visibility_m FROM weather_obs WHERE station IS NOT NULL AND obs_ts IS NOT NULL),
span AS (SELECT station, min(h) AS lo, max(h) AS hi FROM o GROUP BY station),
slots AS (SELECT station, unnest(generate_series(lo, hi, 3600)) AS slot_ts FROM span),
seen AS (SELECT station, h, coalesce(bool_or(visibility_m BETWEEN 0 AND 100000 AND NOT isnan(visibility_m)), false) AS vis FROM o GROUP BY station, h)
SELECT s.station, s.slot_ts, f.field FROM slots s LEFT JOIN seen ON seen.station = s.station AND seen.h = s.slot_ts,
  (VALUES ('visibility_m'), ('ceiling_ft')) f(field)
WHERE CASE f.field WHEN 'ceiling_ft' THEN seen.h IS NULL ELSE NOT coalesce(seen.vis, false) END""",
    "p2_found": """
WITH a AS (SELECT upper(regexp_replace(airport, '\\s', '', 'g')) AS airport, epoch(effective_ts)::BIGINT AS s,
  epoch(coalesce(ends_ts::TIMESTAMPTZ, try_cast(json_extract_string(raw, '$.expires') AS TIMESTAMPTZ)))::BIGINT AS e FROM weather_alerts),
v AS (SELECT * FROM a WHERE airport IS NOT NULL AND e > s),
r AS (SELECT *, max(e) OVER (PARTITION BY airport ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY airport ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM r),
p AS (SELECT airport, min(s) AS s, max(e) AS e FROM g GROUP BY airport, run),
q AS (SELECT *, lead(s) OVER (PARTITION BY airport ORDER BY s) AS nxt FROM p)
SELECT airport, 'period' AS kind, s AS start_ts, e AS end_ts FROM p
UNION ALL SELECT airport, 'gap', e, nxt FROM q WHERE nxt - e <= 43200""",
    "p6_found": f"""
WITH {_RECORDS},
h AS (SELECT src, icao24, event_s // 3600 * 3600 AS hour_ts, arrival - (event_s // 3600 * 3600 + 3600) AS late FROM r)
SELECT DISTINCT src, icao24, hour_ts, CASE WHEN late <= 21600 THEN 'corrected' ELSE 'dropped' END AS outcome FROM h WHERE late > 300""",
    "p7_found": f"""
WITH {_MESSAGES}
SELECT delivery_id FROM (SELECT delivery_id, min(delivery_id) OVER (PARTITION BY icao24, ts) AS kept FROM m) WHERE delivery_id <> kept""",
    "p7_kept": """
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY icao24, ts ORDER BY delivery_id) AS k
  FROM (SELECT lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, CASE WHEN abs(api_ts) < 100000000000 THEN api_ts ELSE api_ts // 1000 END AS ts, delivery_id, batch_id, poll_ts, callsign, on_ground, category, """
    + ", ".join(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" for c in ("lon", "lat", "baro_alt_m", "velocity_ms", "track_deg", "vrate_ms"))
    + """ FROM state_messages WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL)) WHERE k = 1""",
}
