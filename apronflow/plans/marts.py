"""Hourly marts: spine, weather by hour, activity by hour, enriched events, detection quality, weather impact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.functions import geo, weather
from apronflow.functions.common import bucket, half_up, mean, share
from apronflow.operators import asof
from apronflow.sources import views
from apronflow.sources.store import stored

WEATHER = ["flight_category", "wind_speed_kmh", "wind_gust_kmh", "visibility_m", "ceiling_ft", "precip_last_hr_mm"]
HOUR = 3600


def hours_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Airport and hour, from the hour of the first event up to (not including) the hour of the last."""
    span = views.flight_events(spark, folder).agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
    lo, hi = (F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / HOUR) for c in ("lo", "hi"))
    hours = span.select(F.explode(F.when(lo < hi, F.sequence(lo, hi - 1))).alias("h"))
    hours = hours.select(F.timestamp_seconds(F.col("h") * HOUR).cast("timestamp_ntz").alias("hour_ts"))
    return hours.select(F.explode(F.array(*map(F.lit, geo.AIRPORTS))).alias("airport"), "hour_ts")


def weather_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Per airport and hour the last observation before the hour's end, and the names of the alerts active in it."""
    spine = hours_spine(spark, folder).withColumn("end_ts", F.col("hour_ts") + F.expr("INTERVAL 1 HOUR"))
    obs = views.weather_obs(spark, folder).withColumnRenamed("station", "airport").withColumnRenamed("obs_ts", "wx_obs_ts")
    by_hour = asof.backward(spine, obs, "airport", "end_ts", "wx_obs_ts", ["wx_obs_ts", *WEATHER], strict=True).drop("end_ts")
    span = views.flight_events(spark, folder).agg(F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi"))
    # one row of bounds beside every alert: the scalar subqueries keep it out of any join
    alerts = views.weather_alerts(spark, folder).withColumn("lo", span.select("lo").scalar()).withColumn("hi", span.select("hi").scalar())
    active = asof.periods_covered(alerts, "effective_ts", "ends_ts", "lo", "hi", HOUR).where(F.col("airport").isin(*geo.AIRPORTS))
    # an hour whose alerts are all nameless names none, as one without alerts does
    named = active.where(F.col("event").isNotNull())
    names = named.groupBy("airport", F.col("period_ts").alias("hour_ts")).agg(F.array_join(F.array_sort(F.collect_set("event")), ", ").alias("active_alert_types"))
    return by_hour.join(names, ["airport", "hour_ts"], "left")


def airport_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Activity, ground truth and weather per airport and hour; a quiet hour has zeros, a day without ground truth nulls."""
    kind = F.col("event_type")
    events = views.flight_events(spark, folder).groupBy("airport", bucket(F.col("event_ts"), HOUR).alias("hour_ts")).agg(
        F.count_if(kind == "arrival").alias("arrivals_detected"),
        F.count_if(kind == "holding").alias("holding_events"),
        half_up(F.coalesce(F.sum(F.when(kind == "holding", F.col("duration_s"))), F.lit(0)) / 60.0, 1).alias("holding_minutes"),
        F.count_if(kind == "go_around").alias("go_arounds"),
    )
    truth = views.arrivals(spark, folder)
    by_hour = truth.groupBy("airport", bucket(F.col("est_arrival_ts"), HOUR).alias("hour_ts")).agg(F.count(F.lit(1)).alias("gt_n"))
    days = truth.select(F.to_date("est_arrival_ts").alias("gt_date")).distinct()
    spine = hours_spine(spark, folder).withColumn("gt_day", F.to_date("hour_ts"))
    out = spine.join(events, ["airport", "hour_ts"], "left").join(by_hour, ["airport", "hour_ts"], "left")
    out = out.join(days, F.col("gt_day") == F.col("gt_date"), "left").join(weather_hourly(spark, folder), ["airport", "hour_ts"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select(
        "airport", "hour_ts", zero("arrivals_detected"), F.when(F.col("gt_date").isNotNull(), F.coalesce("gt_n", F.lit(0))).alias("arrivals_gt"), zero("holding_events"),
        F.coalesce("holding_minutes", F.lit(0.0)).alias("holding_minutes"), zero("go_arounds"), "wx_obs_ts", *WEATHER, "active_alert_types",
    )


def events_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Each event with the observation valid at its time, and that observation's age in minutes."""
    events = views.flight_events(spark, folder).select("event_id", "icao24", "callsign", "event_type", "airport", "event_ts", "duration_s")
    obs = views.weather_obs(spark, folder).withColumnRenamed("station", "airport").withColumnRenamed("obs_ts", "wx_obs_ts")
    out = asof.backward(events, obs, "airport", "event_ts", "wx_obs_ts", ["wx_obs_ts", *WEATHER, "text_desc"])
    age = F.unix_seconds(F.col("event_ts").cast("timestamp")) - F.unix_seconds(F.col("wx_obs_ts").cast("timestamp"))
    return out.withColumn("wx_age_min", half_up(age / 60.0, 0))


def detection_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Precision and recall of detected arrivals per airport and day; null where a day cannot be scored."""
    found = views.flight_events(spark, folder).where(F.col("event_type") == "arrival").select("event_id", "icao24", "airport", "event_ts")
    truth = views.arrivals(spark, folder)

    def daily(rows: DataFrame, ts: str, name: str) -> DataFrame:
        return rows.groupBy("airport", F.to_date(ts).alias("quality_date")).agg(F.count(F.lit(1)).alias(name))

    on = ["airport", "quality_date"]
    matched = asof.within(found, truth, ["icao24", "airport"], "event_ts", "est_arrival_ts", 600)
    hit = asof.within(truth, found, ["icao24", "airport"], "est_arrival_ts", "event_ts", 600)
    d = daily(found, "event_ts", "arrivals_detected").join(daily(matched, "event_ts", "detected_matched"), on, "left")
    g = daily(truth, "est_arrival_ts", "arrivals_gt").join(daily(hit, "est_arrival_ts", "gt_matched"), on, "left")
    watched = found.groupBy(F.to_date("event_ts").alias("quality_date")).agg(F.countDistinct(bucket(F.col("event_ts"), HOUR)).alias("observed_hours"))
    names = ["arrivals_detected", "arrivals_gt", "detected_matched", "gt_matched", "observed_hours"]
    out = d.join(g, on, "full").join(watched, "quality_date", "left").select("quality_date", "airport", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    landed = (F.col("arrivals_gt") >= 0.5 * F.col("arrivals_detected")) & (F.col("arrivals_gt") > 0)
    return out.withColumns({
        "precision": F.when(landed, half_up(share(F.col("detected_matched"), F.col("arrivals_detected")), 4)),
        "recall": F.when(landed & (F.col("observed_hours") >= 20), half_up(share(F.col("gt_matched"), F.col("arrivals_gt")), 4)),
    })


def weather_impact(spark: SparkSession, folder: str) -> DataFrame:
    """Rates per airport, category and wind bucket over the hours seen in each."""
    hours = mart_table(spark, folder, "airport_hourly").where(F.col("flight_category").isNotNull())
    hours = hours.withColumn("wind_bucket", weather.wind_bucket(weather.effective_wind(F.col("wind_gust_kmh"), F.col("wind_speed_kmh"))))
    return hours.groupBy("airport", "flight_category", "wind_bucket").agg(
        F.count(F.lit(1)).alias("airport_hours"),
        F.sum("arrivals_detected").alias("arrivals"),
        half_up(mean("arrivals_detected"), 2).alias("arrivals_per_hour"),
        F.sum("holding_events").alias("holding_events"),
        half_up(mean("holding_minutes"), 2).alias("holding_min_per_hour"),
        F.sum("go_arounds").alias("go_arounds"),
        half_up(share(F.sum("go_arounds"), F.sum("arrivals_detected")) * 100, 2).alias("go_around_rate_pct"),
    )


#: Tables that the marts are built from.
SOURCES = ["flight_events", "arrivals_reported", "weather_obs", "weather_alerts"]


def mart_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mart as a table: the boards read what is written, where staging and intermediate relations stay views."""
    build = {"airport_hourly": airport_hourly, "detection_quality": detection_quality, "weather_impact": weather_impact}[name]
    return stored(spark, folder, name, SOURCES, lambda: build(spark, folder))


QUERIES = {f.__name__: f for f in (hours_spine, weather_hourly, airport_hourly, events_enriched, detection_quality, weather_impact)}


def half(expr: str, digits: int) -> str:
    scale = f"{float(10**digits)}::DOUBLE"
    return f"floor(({expr})::DOUBLE * {scale} + 0.5::DOUBLE) / {scale}"


def avg(c: str) -> str:
    return f"(sum({c}::DECIMAL(18,4))::DOUBLE / nullif(count({c}), 0))"


_W = ", ".join(WEATHER)
_SPINE = """sp AS (SELECT airport, unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_ts FROM (SELECT date_trunc('hour', min(event_ts)) AS lo, date_trunc('hour', max(event_ts)) AS hi FROM ev), (VALUES ('KJFK'), ('KLGA'), ('KEWR')) a(airport))"""
_HOURLY = f"""wo AS (SELECT sp.airport, sp.hour_ts, ob.obs_ts AS wx_obs_ts, {_W} FROM sp ASOF LEFT JOIN ob ON ob.station = sp.airport AND ob.obs_ts < sp.hour_ts + INTERVAL 1 HOUR),
wh AS (SELECT wo.*, aa.active_alert_types FROM wo LEFT JOIN (SELECT sp.airport, sp.hour_ts, string_agg(DISTINCT al.event, ', ' ORDER BY al.event) AS active_alert_types FROM sp JOIN al
  ON al.airport = sp.airport AND al.effective_ts < sp.hour_ts + INTERVAL 1 HOUR AND coalesce(al.ends_ts, TIMESTAMP '9999-01-01') > sp.hour_ts AND (al.ends_ts IS NULL OR al.ends_ts > al.effective_ts) GROUP BY ALL) aa USING (airport, hour_ts))"""
_AIRPORT = f"""eh AS (SELECT airport, date_trunc('hour', event_ts) AS hour_ts, count(*) FILTER (event_type = 'arrival') AS arrivals_detected, count(*) FILTER (event_type = 'holding') AS holding_events,
  {half("coalesce(sum(duration_s) FILTER (event_type = 'holding'), 0) / 60.0::DOUBLE", 1)} AS holding_minutes, count(*) FILTER (event_type = 'go_around') AS go_arounds FROM ev GROUP BY 1, 2),
gh AS (SELECT airport, date_trunc('hour', est_arrival_ts) AS hour_ts, count(*) AS n FROM gt GROUP BY 1, 2),
gd AS (SELECT DISTINCT est_arrival_ts::DATE AS gt_date FROM gt),
ah AS (SELECT sp.airport, sp.hour_ts, coalesce(arrivals_detected, 0) AS arrivals_detected, CASE WHEN gt_date IS NOT NULL THEN coalesce(n, 0) END AS arrivals_gt, coalesce(holding_events, 0) AS holding_events,
  coalesce(holding_minutes, 0) AS holding_minutes, coalesce(go_arounds, 0) AS go_arounds, wx_obs_ts, {_W}, active_alert_types
  FROM sp LEFT JOIN eh USING (airport, hour_ts) LEFT JOIN gh USING (airport, hour_ts) LEFT JOIN gd ON sp.hour_ts::DATE = gd.gt_date LEFT JOIN wh USING (airport, hour_ts))"""
HOURLY_SQL = f"{views.with_views('ev', 'gt', 'ob', 'al')},\n{_SPINE},\n{_HOURLY},\n{_AIRPORT}"
_MATCH = "g.icao24 = d.icao24 AND g.airport = d.airport AND abs(epoch(g.est_arrival_ts) - epoch(d.event_ts)) <= 600"
QUALITY_SQL = f"""{views.with_views('ev', 'gt')},
d AS (SELECT * FROM ev WHERE event_type = 'arrival'),
dd AS (SELECT airport, event_ts::DATE AS quality_date, count(*) AS a, count(*) FILTER (EXISTS (SELECT 1 FROM gt g WHERE {_MATCH})) AS m FROM d GROUP BY 1, 2),
gg AS (SELECT airport, est_arrival_ts::DATE AS quality_date, count(*) AS a, count(*) FILTER (EXISTS (SELECT 1 FROM d WHERE {_MATCH})) AS m FROM gt g GROUP BY 1, 2),
cv AS (SELECT event_ts::DATE AS quality_date, count(DISTINCT date_trunc('hour', event_ts)) AS h FROM d GROUP BY 1),
dq AS (SELECT quality_date, airport, coalesce(dd.a, 0) AS arrivals_detected, coalesce(gg.a, 0) AS arrivals_gt, coalesce(dd.m, 0) AS detected_matched, coalesce(gg.m, 0) AS gt_matched, coalesce(h, 0) AS observed_hours
  FROM dd FULL JOIN gg USING (airport, quality_date) LEFT JOIN cv USING (quality_date)),
q AS (SELECT *, CASE WHEN arrivals_gt >= 0.5 * arrivals_detected AND arrivals_gt > 0 THEN {half('detected_matched::DOUBLE / nullif(arrivals_detected, 0)', 4)} END AS "precision",
  CASE WHEN arrivals_gt >= 0.5 * arrivals_detected AND arrivals_gt > 0 AND observed_hours >= 20 THEN {half('gt_matched::DOUBLE / nullif(arrivals_gt, 0)', 4)} END AS recall FROM dq)"""
IMPACT_SQL = f"""{HOURLY_SQL},
wi AS (SELECT airport, flight_category, CASE WHEN w IS NULL THEN 'unknown' WHEN w > 37 THEN 'windy' WHEN w >= 20 THEN 'breezy' ELSE 'calm' END AS wind_bucket, count(*) AS airport_hours, sum(arrivals_detected)::BIGINT AS arrivals,
  {half(avg('arrivals_detected'), 2)} AS arrivals_per_hour, sum(holding_events)::BIGINT AS holding_events, {half(avg('holding_minutes'), 2)} AS holding_min_per_hour, sum(go_arounds)::BIGINT AS go_arounds,
  {half('sum(go_arounds)::DOUBLE / nullif(sum(arrivals_detected), 0) * 100', 2)} AS go_around_rate_pct
  FROM (SELECT *, coalesce(wind_gust_kmh, wind_speed_kmh) AS w FROM ah WHERE flight_category IS NOT NULL) GROUP BY 1, 2, 3)"""

SQL = {
    "hours_spine": f"{views.with_views('ev')},\n{_SPINE} SELECT * FROM sp",
    "weather_hourly": f"{views.with_views('ev', 'ob', 'al')},\n{_SPINE},\n{_HOURLY} SELECT * FROM wh",
    "airport_hourly": f"{HOURLY_SQL} SELECT * FROM ah",
    "events_enriched": f"""{views.with_views('ev', 'ob')} SELECT event_id, icao24, callsign, event_type, airport, event_ts, duration_s, obs_ts AS wx_obs_ts, {_W}, text_desc,
  {half('(epoch(event_ts) - epoch(obs_ts)) / 60.0::DOUBLE', 0)} AS wx_age_min FROM ev ASOF LEFT JOIN ob ON ob.station = ev.airport AND ob.obs_ts <= ev.event_ts""",
    "detection_quality": f"{QUALITY_SQL} SELECT * FROM q",
    "weather_impact": f"{IMPACT_SQL} SELECT * FROM wi",
}
