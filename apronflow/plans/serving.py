"""Live queries and boards: parametrised reads of the current relations.

Every relative time is relative to as_of, a column that defaults to the newest time in the relation;
the clock is never asked. Parameters are checked before a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.functions import geo, weather
from apronflow.functions.common import age_s, bucket, half_up
from apronflow.plans import marts
from apronflow.sources import views

EVENT_TYPES = ("arrival", "holding", "go_around")
TARGETS = {"precision": 0.85, "recall": 0.80}
FRESH_S, STALE_S = 120, 900
HOUR = 3600


def in_range(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be from {low} to {high}")
    return value


def airports(chosen: Sequence[str] | None) -> list[str]:
    out = list(chosen) if chosen else list(geo.AIRPORTS)
    if not set(out) <= set(geo.AIRPORTS):
        raise ValueError(f"airports must be among {tuple(geo.AIRPORTS)}")
    return out


#: The time frames that a reader may name, in hours.
FRAMES = {"3h": 3, "12h": 12, "24h": 24, "7d": 168}


def frame_hours(name: str | None) -> int:
    """Hours of a named time frame; without a name a day."""
    if name is None:
        return 24
    if name not in FRAMES:
        raise ValueError(f"time frame must be one of {tuple(FRAMES)}")
    return FRAMES[name]


def newest(df: DataFrame, ts: str) -> Column:
    """The relation's newest time as a scalar subquery."""
    return df.agg(F.max(ts)).scalar()


def back(as_of: Column, hours: int) -> Column:
    return as_of - F.expr(f"INTERVAL {int(hours)} HOUR")


def _states(spark: SparkSession, folder: str) -> DataFrame:
    s = views.live_states(spark, folder)
    return s.withColumn("updated_at", F.timestamp_seconds("ts").cast("timestamp_ntz"))


def positions(spark: SparkSession, folder: str, window_s: int = 300, airborne: bool = False, ago_s: int = 0) -> DataFrame:
    """Where each aircraft heard of within window_s is, and how old that is; ago_s seconds before the newest report."""
    s = views.live_states(spark, folder, ago_s)
    # the newest report of all is that of its aircraft too, so a scan of the times alone tells it
    now = newest(views.placed_states(spark, folder), "ts") if not ago_s else newest(s, "ts")
    rows = s.where(F.col("ts") > now - window_s)
    rows = rows.where(~F.col("on_ground")) if airborne else rows
    names = {"baro_alt_m": "alt_m", "velocity_ms": "vel_ms"}
    return rows.select("icao24", "callsign", "lat", "lon", *[F.col(c).alias(n) for c, n in names.items()], "on_ground", "track_deg", "vrate_ms", "category", (now - F.col("ts")).cast("int").alias("age_s"))


def conditions(spark: SparkSession, folder: str) -> DataFrame:
    """Latest observation of each station."""
    obs = views.weather_obs(spark, folder)
    rest = ["obs_ts", "temp_c", "wind_speed_kmh", "wind_gust_kmh", "wind_dir_deg", "visibility_m", "ceiling_ft", "flight_category", "text_desc"]
    last = obs.groupBy("station").agg(F.max_by(F.struct(*rest), "obs_ts").alias("x"))
    return last.select("station", "x.*").orderBy("station")


def alerts_active(spark: SparkSession, folder: str, hours_ago: int = 24) -> DataFrame:
    """Alerts in force hours_ago before the newest one begins: from their start up to, not including, their end."""
    al = views.weather_alerts(spark, folder)
    at = back(newest(al, "effective_ts"), hours_ago)
    return al.where((F.col("effective_ts") <= at) & (F.col("ends_ts").isNull() | (F.col("ends_ts") > at))).orderBy("airport", F.desc("effective_ts"), "alert_id")


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds from the newest state to the newest poll."""
    s = _states(spark, folder)
    return s.agg((F.max("poll_ts") - F.max("ts")).cast("int").alias("freshness_s"))


def pipeline_status(spark: SparkSession, folder: str) -> DataFrame:
    """fresh, stale or offline by the age of the newest state, and the number of aircraft heard of."""
    f = freshness(spark, folder)
    age = F.coalesce("freshness_s", F.lit(10**9))
    status = F.when(age < FRESH_S, "fresh").when(age < STALE_S, "stale").otherwise("offline")
    return f.select(status.alias("status"), age.alias("freshness_s"), (age > 300).alias("alert"))


def arrivals_15m(spark: SparkSession, folder: str, hours: int = 24, chosen: Sequence[str] | None = None) -> DataFrame:
    in_range("hours", hours, 1, 168)
    ev = views.flight_events(spark, folder)
    rows = ev.where((F.col("event_type") == "arrival") & F.col("airport").isin(*airports(chosen)) & (F.col("event_ts") > back(newest(ev, "event_ts"), hours)))
    return rows.groupBy("airport", bucket(F.col("event_ts"), 900).alias("bucket_ts")).agg(F.count(F.lit(1)).alias("arrivals")).orderBy("bucket_ts", "airport")


def arrivals_hourly_rollup(spark: SparkSession, folder: str, hours: int = 168) -> DataFrame:
    """The 15-minute counts by hour, one column per airport."""
    quarter = arrivals_15m(spark, folder, hours)
    return quarter.groupBy(bucket(F.col("bucket_ts"), HOUR).alias("hour_ts")).pivot("airport", list(geo.AIRPORTS)).agg(F.sum("arrivals")).orderBy("hour_ts")


def airborne_hourly(spark: SparkSession, folder: str, hours: int = 168, chosen: Sequence[str] | None = None) -> DataFrame:
    in_range("hours", hours, 1, 168)
    ev = views.flight_events(spark, folder)
    rows = ev.where(F.col("event_type").isin("holding", "go_around") & F.col("airport").isin(*airports(chosen)) & (F.col("event_ts") > back(newest(ev, "event_ts"), hours)))
    held = F.coalesce(F.sum(F.when(F.col("event_type") == "holding", F.col("duration_s"))), F.lit(0)) / 60.0
    return rows.groupBy("airport", bucket(F.col("event_ts"), HOUR).alias("bucket_ts")).agg(half_up(held, 1).alias("holding_min"), F.count_if(F.col("event_type") == "go_around").alias("go_arounds")).orderBy("bucket_ts", "airport")


def airborne_gapfill(spark: SparkSession, folder: str, hours: int = 168) -> DataFrame:
    """The same wide by airport, with go-arounds summed, and every hour from the first to the last there."""
    long = airborne_hourly(spark, folder, hours)
    wide = long.groupBy("bucket_ts").pivot("airport", list(geo.AIRPORTS)).agg(F.max("holding_min"))
    wide = wide.join(long.groupBy("bucket_ts").agg(F.sum("go_arounds").alias("go_arounds")), "bucket_ts")
    s = lambda c: F.unix_seconds(c.cast("timestamp"))
    span = long.agg(F.min("bucket_ts").alias("lo"), F.max("bucket_ts").alias("hi")).where(F.col("lo").isNotNull())
    hours_ = span.select(F.explode(F.sequence(s(F.col("lo")), s(F.col("hi")), F.lit(HOUR).cast("long"))).alias("h")).select(F.timestamp_seconds("h").cast("timestamp_ntz").alias("bucket_ts"))
    return hours_.join(wide, "bucket_ts", "left").fillna(0, ["go_arounds"]).orderBy("bucket_ts")


def events_feed(spark: SparkSession, folder: str, event_type: str | None = None, airport: str | None = None, limit: int = 50) -> DataFrame:
    in_range("limit", limit, 1, 200)
    if event_type is not None and event_type not in EVENT_TYPES:
        raise ValueError(f"event_type must be one of {EVENT_TYPES}")
    rows = views.flight_events(spark, folder).drop("detected_at")
    rows = rows.where(F.col("event_type") == event_type) if event_type is not None else rows
    rows = rows.where(F.col("airport").isin(*airports([airport]))) if airport is not None else rows
    return rows.orderBy(F.desc("event_ts"), "event_id").limit(limit)


def wind_series(spark: SparkSession, folder: str, hours: int = 24) -> DataFrame:
    """Wind and gust readings as one series per station and kind."""
    in_range("hours", hours, 1, 168)
    obs = views.weather_obs(spark, folder)
    rows = obs.where(F.col("obs_ts") > back(newest(obs, "obs_ts"), hours))
    series = F.array(F.struct(F.col("station").alias("metric"), F.col("wind_speed_kmh").alias("value")), F.struct(F.concat("station", F.lit(" gust")).alias("metric"), F.col("wind_gust_kmh").alias("value")))
    return rows.select("obs_ts", F.explode(series).alias("s")).where(F.col("s.value").isNotNull()).select("obs_ts", "s.metric", "s.value")


def wind_scatter(spark: SparkSession, folder: str, days: int = 7, category: str | None = None) -> DataFrame:
    in_range("days", days, 1, 90)
    if category is not None and category not in weather.CATEGORIES:
        raise ValueError(f"category must be one of {weather.CATEGORIES}")
    hours = marts.mart_table(spark, folder, "airport_hourly")
    wind = weather.effective_wind(F.col("wind_gust_kmh"), F.col("wind_speed_kmh"))
    as_of = newest(marts.hours_spine(spark, folder), "hour_ts")
    rows = hours.where((F.col("hour_ts") > back(as_of, 24 * days)) & wind.isNotNull())
    rows = rows.where(F.col("flight_category") == category) if category is not None else rows
    return rows.select("airport", "hour_ts", "arrivals_detected", wind.alias("effective_wind_kmh"), "flight_category")


def quality_series(spark: SparkSession, folder: str, days: int = 30) -> DataFrame:
    """Precision and recall by day as one series per airport and measure; unscored days keep their nulls."""
    in_range("days", days, 1, 90)
    q = marts.mart_table(spark, folder, "detection_quality")
    rows = q.where(F.col("quality_date") > F.date_sub(newest(q, "quality_date"), days))
    series = F.array(*[F.struct(F.concat("airport", F.lit(f" {m}")).alias("metric"), F.col(m).alias("value")) for m in ("precision", "recall")])
    return rows.select("quality_date", F.explode(series).alias("s")).select("quality_date", "s.metric", "s.value")


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """The latest scored day against the targets; a missing recall does not meet them."""
    q = marts.mart_table(spark, folder, "detection_quality")
    scored = q.where(F.col("precision").isNotNull())
    met = (F.col("precision") >= TARGETS["precision"]) & (F.coalesce("recall", F.lit(0.0)) >= TARGETS["recall"])
    rows = scored.where(F.col("quality_date") == newest(scored, "quality_date"))
    return rows.select("quality_date", "airport", "arrivals_detected", "arrivals_gt", "precision", "recall", met.alias("met"))


def impact_table(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("airport"), weather.rank_in(F.col("flight_category"), *weather.CATEGORIES), weather.rank_in(F.col("wind_bucket"), "calm", "breezy", "windy", "unknown")]
    return marts.mart_table(spark, folder, "weather_impact").orderBy(*order)


def alert_annotations(spark: SparkSession, folder: str, hours: int = 48) -> DataFrame:
    """Alerts that overlap the last hours, with their labels."""
    al = views.weather_alerts(spark, folder)
    now = newest(al, "effective_ts")
    rows = al.where((F.col("effective_ts") < now) & (F.coalesce(F.col("ends_ts"), now) > back(now, hours)))
    return rows.select(F.col("effective_ts").alias("time"), F.col("ends_ts").alias("timeend"), F.concat("airport", F.lit(": "), "event").alias("text"), F.col("airport").alias("tags")).distinct()


def alert_timeline(spark: SparkSession, folder: str, hours: int = 48) -> DataFrame:
    """Alert state by airport over the last hours: the state at the beginning, then every change."""
    al = views.weather_alerts(spark, folder)
    now = newest(al, "effective_ts")
    start = back(now, hours)
    in_force = al.where((F.col("effective_ts") <= start) & (F.col("ends_ts").isNull() | (F.col("ends_ts") > start)))
    held = in_force.groupBy("airport").agg(F.max_by("event", F.struct("effective_ts", "event")).alias("event"))
    fields = spark.createDataFrame([(a,) for a in geo.AIRPORTS], "airport string")
    baseline = fields.join(held, "airport", "left").select(start.alias("time"), "airport", F.coalesce("event", F.lit("clear")).alias("state"))
    began = al.select(F.col("effective_ts").alias("time"), "airport", F.col("event").alias("state"))
    ended = al.where(F.col("ends_ts").isNotNull()).select(F.col("ends_ts").alias("time"), "airport", F.lit("clear").alias("state"))
    changes = began.unionByName(ended).where((F.col("time") > start) & (F.col("time") <= now))
    return baseline.unionByName(changes).orderBy("time", "airport", "state")


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The live bundle as rows of (part, document): one JSON document per position, station and alert."""
    parts = {"positions": positions(spark, folder), "conditions": conditions(spark, folder), "alerts": alerts_active(spark, folder), "freshness": freshness(spark, folder)}
    rows = [df.select(F.lit(name).alias("part"), F.to_json(F.struct("*")).alias("document")) for name, df in parts.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def staleness(spark: SparkSession, folder: str) -> DataFrame:
    """Source freshness against its warning and error ages: events, ground truth, observations."""
    from apronflow.operators.quality import freshness as level

    ev, gt, ob = views.flight_events(spark, folder), views.arrivals(spark, folder), views.weather_obs(spark, folder)
    now = newest(ev, "event_ts")
    parts = [(ev, "event_ts", "flight_events", 3600, 3 * 3600), (gt, "est_arrival_ts", "arrivals", 2 * 86_400, 4 * 86_400), (ob, "obs_ts", "weather_obs", 2 * 3600, 6 * 3600)]
    rows = [level(df, ts, now, warn, error).withColumn("source", F.lit(name)) for df, ts, name, warn, error in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


QUERIES = {
    **{f.__name__: f for f in (positions, conditions, alerts_active, freshness, pipeline_status, arrivals_15m, arrivals_hourly_rollup, airborne_hourly, airborne_gapfill, events_feed, wind_series, wind_scatter, quality_series, quality_report, impact_table, alert_annotations, alert_timeline, snapshot)},
    "positions_airborne": lambda spark, folder: positions(spark, folder, 90, True, 16 * 3600),
    "events_feed_filtered": lambda spark, folder: events_feed(spark, folder, "holding", "KJFK", 200),
    "wind_scatter_ifr": lambda spark, folder: wind_scatter(spark, folder, 30, "IFR"),
    "dq_freshness": staleness,
}

_W = views.with_views
half = marts.half
_POS = lambda w, more, view="ls": f"""{_W(view)}, n AS (SELECT max(ts) AS now FROM {view}) SELECT icao24, callsign, lat, lon, baro_alt_m AS alt_m, velocity_ms AS vel_ms, on_ground, track_deg, vrate_ms, category, (now - ts)::INTEGER AS age_s FROM {view}, n WHERE ts > now - {w} {more}"""
_A15 = lambda h: f"""{_W('ev')}, n AS (SELECT max(event_ts) AS now FROM ev), a15 AS (SELECT airport, time_bucket(INTERVAL 15 MINUTE, event_ts) AS bucket_ts, count(*) AS arrivals FROM ev, n WHERE event_type = 'arrival' AND airport IN ('KJFK', 'KLGA', 'KEWR') AND event_ts > now - INTERVAL {h} HOUR GROUP BY 1, 2)"""
_AIR = f"""{_W('ev')}, n AS (SELECT max(event_ts) AS now FROM ev), ab AS (SELECT airport, date_trunc('hour', event_ts) AS bucket_ts, {half("coalesce(sum(duration_s) FILTER (event_type = 'holding'), 0) / 60.0::DOUBLE", 1)} AS holding_min,
  count(*) FILTER (event_type = 'go_around') AS go_arounds FROM ev, n WHERE event_type IN ('holding', 'go_around') AND airport IN ('KJFK', 'KLGA', 'KEWR') AND event_ts > now - INTERVAL 168 HOUR GROUP BY 1, 2)"""
_SC = lambda d, more: f"""{marts.HOURLY_SQL} SELECT airport, hour_ts, arrivals_detected, coalesce(wind_gust_kmh, wind_speed_kmh) AS effective_wind_kmh, flight_category FROM ah WHERE hour_ts > (SELECT max(hour_ts) FROM sp) - INTERVAL {d} DAY AND coalesce(wind_gust_kmh, wind_speed_kmh) IS NOT NULL {more}"""
_FRESH = f"{_W('ls')}, f AS (SELECT (max(poll_ts) - max(ts))::INTEGER AS freshness_s FROM ls)"
_FEED = "SELECT event_id, icao24, callsign, event_type, airport, event_ts, duration_s, details FROM ev"

SQL = {
    "positions": _POS(300, ""),
    "positions_airborne": _POS(90, "AND NOT on_ground", "lp"),
    "conditions": f"{_W('ob')} SELECT station, obs_ts, temp_c, wind_speed_kmh, wind_gust_kmh, wind_dir_deg, visibility_m, ceiling_ft, flight_category, text_desc FROM ob QUALIFY row_number() OVER (PARTITION BY station ORDER BY obs_ts DESC) = 1",
    "alerts_active": f"{_W('al')}, n AS (SELECT max(effective_ts) - INTERVAL 24 HOUR AS t FROM al) SELECT al.* FROM al, n WHERE effective_ts <= t AND (ends_ts IS NULL OR ends_ts > t)",
    "freshness": f"{_FRESH} SELECT * FROM f",
    "pipeline_status": f"{_FRESH} SELECT CASE WHEN coalesce(freshness_s, 1000000000) < 120 THEN 'fresh' WHEN coalesce(freshness_s, 1000000000) < 900 THEN 'stale' ELSE 'offline' END AS status, coalesce(freshness_s, 1000000000) AS freshness_s, coalesce(freshness_s, 1000000000) > 300 AS alert FROM f",
    "arrivals_15m": f"{_A15(24)} SELECT * FROM a15",
    "arrivals_hourly_rollup": f"{_A15(168)} SELECT date_trunc('hour', bucket_ts) AS hour_ts, " + ", ".join(f"(sum(arrivals) FILTER (airport = '{a}'))::BIGINT AS \"{a}\"" for a in geo.AIRPORTS) + " FROM a15 GROUP BY 1",
    "airborne_hourly": f"{_AIR} SELECT * FROM ab",
    "airborne_gapfill": f"{_AIR}, h AS (SELECT unnest(generate_series(min(bucket_ts), max(bucket_ts), INTERVAL 1 HOUR)) AS bucket_ts FROM ab) SELECT bucket_ts, "
    + ", ".join(f"max(holding_min) FILTER (airport = '{a}') AS \"{a}\"" for a in geo.AIRPORTS)
    + ", coalesce(sum(go_arounds), 0)::BIGINT AS go_arounds FROM h LEFT JOIN ab USING (bucket_ts) GROUP BY 1",
    "events_feed": f"{_W('ev')} {_FEED} ORDER BY event_ts DESC, event_id LIMIT 50",
    "events_feed_filtered": f"{_W('ev')} {_FEED} WHERE event_type = 'holding' AND airport = 'KJFK' ORDER BY event_ts DESC, event_id LIMIT 200",
    "wind_series": f"{_W('ob')}, r AS (SELECT * FROM ob WHERE obs_ts > (SELECT max(obs_ts) FROM ob) - INTERVAL 24 HOUR) SELECT obs_ts, station AS metric, wind_speed_kmh AS value FROM r WHERE wind_speed_kmh IS NOT NULL UNION ALL SELECT obs_ts, station || ' gust', wind_gust_kmh FROM r WHERE wind_gust_kmh IS NOT NULL",
    "wind_scatter": _SC(7, ""),
    "wind_scatter_ifr": _SC(30, "AND flight_category = 'IFR'"),
    "quality_series": f"""{marts.QUALITY_SQL}, r AS (SELECT * FROM q WHERE quality_date > (SELECT max(quality_date) FROM q) - 30) SELECT quality_date, airport || ' precision' AS metric, "precision" AS value FROM r UNION ALL SELECT quality_date, airport || ' recall', recall FROM r""",
    "quality_report": f"""{marts.QUALITY_SQL} SELECT quality_date, airport, arrivals_detected, arrivals_gt, "precision", recall, "precision" >= 0.85 AND coalesce(recall, 0) >= 0.8 AS met FROM q WHERE "precision" IS NOT NULL AND quality_date = (SELECT max(quality_date) FROM q WHERE "precision" IS NOT NULL)""",
    "impact_table": f"{marts.IMPACT_SQL} SELECT * FROM wi",
    "alert_annotations": f"{_W('al')}, n AS (SELECT max(effective_ts) AS now FROM al) SELECT DISTINCT effective_ts AS time, ends_ts AS timeend, airport || ': ' || event AS text, airport AS tags FROM al, n WHERE effective_ts < now AND coalesce(ends_ts, now) > now - INTERVAL 48 HOUR",
    "alert_timeline": f"""{_W('al')}, n AS (SELECT max(effective_ts) AS now, max(effective_ts) - INTERVAL 48 HOUR AS t FROM al)
SELECT t AS time, a.airport, coalesce((SELECT event FROM al WHERE al.airport = a.airport AND effective_ts <= t AND (ends_ts IS NULL OR ends_ts > t) ORDER BY effective_ts DESC, event DESC LIMIT 1), 'clear') AS state FROM (VALUES ('KJFK'), ('KLGA'), ('KEWR')) a(airport), n
UNION ALL SELECT * FROM (SELECT effective_ts AS time, airport, event AS state FROM al UNION ALL SELECT ends_ts, airport, 'clear' FROM al WHERE ends_ts IS NOT NULL) WHERE time > (SELECT t FROM n) AND time <= (SELECT now FROM n)""",
    "dq_freshness": f"""{_W('ev', 'gt', 'ob')}, n AS (SELECT max(event_ts) AS now FROM ev),
a AS (SELECT 'flight_events' AS source, max(event_ts) AS t, 3600 AS w, 10800 AS e FROM ev UNION ALL SELECT 'arrivals', max(est_arrival_ts), 172800, 345600 FROM gt UNION ALL SELECT 'weather_obs', max(obs_ts), 7200, 21600 FROM ob),
b AS (SELECT source, (epoch(now) - epoch(t))::BIGINT AS age_s, w, e FROM a, n)
SELECT source, age_s, CASE WHEN age_s IS NULL OR age_s > e THEN 'error' WHEN age_s > w THEN 'warn' ELSE 'pass' END AS level FROM b""",
}
