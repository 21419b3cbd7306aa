"""Queries that write: consumers, daily loads, exports and landings, and what is read back from them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.functions import geo
from apronflow.operators import keys
from apronflow.operators.upsert import greatest_per_key
from apronflow.plans import lake, marts, serving
from apronflow.session import scratch
from apronflow.sources import envelope, exports, views
from apronflow.sources.tables import table
from apronflow.streaming import sinks

MEASURES = ("temp_c", "wind_speed_kmh", "wind_gust_kmh", "wind_dir_deg", "visibility_m", "ceiling_ft", "precip_last_hr_mm")


def _place(spark: SparkSession, name: str) -> str:
    return scratch(spark, f"{name}-{uuid.uuid4().hex}")


def _messages(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of JSON messages, keys in their normal form."""
    raw = spark.readStream.schema(table(spark, folder, name).schema).parquet(f"{folder.rstrip('/')}/{name}.parquet*")
    place = "station" if name == "weather_obs" else "airport"
    raw = raw.withColumn(place, keys.place(place))
    clean = {c: keys.number(c) for c in MEASURES if c in raw.columns}
    return raw.withColumns(clean) if clean else raw


def _consumed(spark: SparkSession, folder: str, name: str, make) -> tuple[DataFrame, str]:
    where = _place(spark, name)
    held = make(spark, f"{where}/table")
    rows = _messages(spark, folder, name)
    sinks.consume(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")), held, f"{where}/counts", f"{where}/offsets").awaitTermination()
    return held.read(), f"{where}/counts"


def sink_weather_obs(spark: SparkSession, folder: str) -> DataFrame:
    return _consumed(spark, folder, "weather_obs", sinks.obs_table)[0]


def sink_weather_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return _consumed(spark, folder, "weather_alerts", sinks.alert_table)[0]


def sink_drops(spark: SparkSession, folder: str) -> DataFrame:
    """Messages by outcome, where every observation without visibility comes as no JSON and every one without ceiling as an array."""
    where = _place(spark, "drops")
    rows = _messages(spark, folder, "weather_obs")
    value = F.when(F.col("visibility_m").isNull(), "{broken").when(F.col("ceiling_ft").isNull(), "[1, 2]").otherwise(F.to_json(F.struct(*rows.columns)))
    sinks.consume(rows.select(value.alias("value")), sinks.obs_table(spark, f"{where}/table"), f"{where}/counts", f"{where}/offsets").awaitTermination()
    return sinks.drops(spark, f"{where}/counts")


def _arrivals(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "arrivals_reported")
    rows = raw.select(keys.icao("icao24").alias("icao24"), keys.place("airport").alias("airport"), "est_arrival_ts", F.nullif(F.trim("callsign"), F.lit("")).alias("callsign"), "first_seen", "last_seen")
    return rows.where(F.col("icao24").isNotNull() & F.col("airport").isNotNull() & F.col("est_arrival_ts").isNotNull())


def sink_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Daily loads: first what was complete at once (rows with a callsign), then the last three days again with all of theirs."""
    where, rows = _place(spark, "arrivals"), _arrivals(spark, folder)
    sinks.load_days(rows.where(F.col("callsign").isNotNull()), where)
    last = rows.agg(F.max(F.to_date("est_arrival_ts"))).scalar()
    sinks.load_days(rows.where(F.to_date("est_arrival_ts") > F.date_sub(last, 3)), where)
    return spark.read.parquet(where).drop("day")


def ground_truth_pull(spark: SparkSession, folder: str) -> DataFrame:
    """Reported arrivals by way of the day's JSON records (times in epoch seconds) into the keyed table."""
    where = _place(spark, "pull")
    rows = _arrivals(spark, folder)
    rows.select("icao24", "callsign", "airport", keys.epoch("first_seen").alias("firstSeen"), keys.epoch("est_arrival_ts").alias("lastSeen")).write.json(f"{where}/days")
    held = sinks.arrival_table(spark, f"{where}/table")
    held.upsert(greatest_per_key(exports.read_arrivals(spark, f"{where}/days"), sinks.ARRIVAL_KEYS, ["callsign", "first_seen", "last_seen"]))
    return held.read()


def sink_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Gold through its CSV export into the serving table, twice, as two days' loads would."""
    where, gold = _place(spark, "gold"), lake.gold_table(spark, folder)
    exports.export_csv(gold, f"{where}/csv")
    read = exports.read_gold_csv(spark, f"{where}/csv")
    held = sinks.gold_serving(spark, f"{where}/table", ", ".join(f"`{c}` {t}" for c, t in read.dtypes))
    held.upsert(read)
    held.upsert(read)
    return held.read()


def metar_files(spark: SparkSession, folder: str) -> DataFrame:
    """METAR silver by way of report files, station=*/*.csv."""
    where = _place(spark, "reports")
    views.metar_raw(spark, folder).withColumn("s", F.col("station")).write.partitionBy("s").option("header", True).option("emptyValue", "").csv(where)
    return lake.silver_metar(envelope.report_csv(spark, f"{where}/s=*/*.csv"))


def obs_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Polled observations of which only those with a new time are published."""
    obs = table(spark, folder, "weather_obs").select(keys.place("station").alias("station"), "obs_ts").where(F.col("station").isNotNull() & F.col("obs_ts").isNotNull())
    return envelope.changes_only(obs, ["station"], ["obs_ts"], ["obs_ts"])


def airports(spark: SparkSession, folder: str) -> DataFrame:
    """The airports' reference points, as a map panel wants them."""
    return spark.createDataFrame([(a[1:], lat, lon) for a, (lat, lon) in geo.AIRPORTS.items()], "airport string, a_lat double, a_lon double")


#: The nine slices of the daily bundle.
HISTORY = {
    "staircase": lambda s, f: lake.staircase(lake.gold_table(s, f)),
    "causes": lambda s, f: lake.causes_by_year(lake.gold_table(s, f)),
    "seasonality": lambda s, f: lake.seasonality(lake.gold_table(s, f)),
    "worst": lambda s, f: lake.worst_days(lake.gold_table(s, f), 10),
    "monthly": lambda s, f: lake.monthly(lake.gold_table(s, f), None, None, 1992),
    "quality": lambda s, f: serving.quality_series(s, f),
    "arrivals": lambda s, f: serving.arrivals_15m(s, f),
    "airborne": lambda s, f: serving.airborne_hourly(s, f, 24),
    "wind": lambda s, f: serving.wind_series(s, f),
}


def publish_history(spark: SparkSession, folder: str, path: str, slices=None) -> dict[str, str]:
    """The daily bundle as JSON documents; a slice that fails is null (its error is told) and leaves the others alone."""
    parts = {}
    told = {}
    for name, make in (slices or HISTORY).items():
        try:
            parts[name] = make(spark, folder)
        except Exception as error:  # noqa: BLE001 - one failing slice costs itself, not the bundle
            told[name] = f"failed: {str(error)[:200]}"
    return told | exports.publish_json(parts, path)


def history_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of each slice of the bundle, as read back from where it was published; null where a slice failed."""
    where = _place(spark, "history")
    told = publish_history(spark, folder, where)
    rows = [(name, spark.read.text(f"{where}/{name}").count() if told[name] == "written" else None) for name in HISTORY]
    return spark.createDataFrame(rows, "slice string, documents long")


def snapshot_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of each part of the live bundle, and how many tell their identity."""
    s = serving.snapshot(spark, folder)
    known = F.coalesce(F.get_json_object("document", "$.icao24"), F.get_json_object("document", "$.station"), F.get_json_object("document", "$.alert_id"), F.get_json_object("document", "$.freshness_s"))
    told = s.groupBy("part").agg(F.count(F.lit(1)).alias("documents"), F.countDistinct(known).alias("identities"))
    parts = spark.createDataFrame([(p,) for p in ("positions", "conditions", "alerts", "freshness")], "part string")
    return parts.join(told, "part", "left").fillna(0)


def _scatter(category: str):
    return lambda spark, folder: serving.wind_scatter(spark, folder, 30, category)


QUERIES = {
    **{f.__name__: f for f in (sink_weather_obs, sink_weather_alerts, sink_drops, sink_arrivals, ground_truth_pull, sink_gold, metar_files, obs_changes, airports, history_bundle, snapshot_parts)},
    **{f"wind_scatter_{c.lower()}": _scatter(c) for c in ("VFR", "MVFR", "LIFR")},
}

_PLACE = lambda c: f"upper(regexp_replace({c}, '\\s', '', 'g')) AS {c}"
_NUM = ", ".join(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" for c in MEASURES)
_FIRST = lambda ks, cs: f"QUALIFY row_number() OVER (PARTITION BY {ks} ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in cs)}) = 1"
_ARR = """a AS (SELECT lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, upper(regexp_replace(airport, '\\s', '', 'g')) AS airport, est_arrival_ts, nullif(trim(callsign), '') AS callsign, first_seen, last_seen
  FROM arrivals_reported WHERE icao24 IS NOT NULL AND airport IS NOT NULL AND est_arrival_ts IS NOT NULL)"""
_ARRIVAL = "icao24, airport, est_arrival_ts"
_DOCS = {"staircase": lake.SQL["staircase"], "causes": lake.SQL["causes_by_year"], "seasonality": lake.SQL["seasonality"], "worst": f"{lake.GOLD_SQL} SELECT * FROM gold LIMIT 10", "monthly": lake.SQL["monthly"], "quality": serving.SQL["quality_series"], "arrivals": serving.SQL["arrivals_15m"], "airborne": serving.SQL["airborne_hourly"].replace("INTERVAL 168 HOUR", "INTERVAL 24 HOUR"), "wind": serving.SQL["wind_series"]}
_PARTS = {"positions": ("positions", "icao24"), "conditions": ("conditions", "station"), "alerts": ("alerts_active", "alert_id"), "freshness": ("freshness", "freshness_s")}

SQL = {
    "sink_weather_obs": f"SELECT * FROM (SELECT {_PLACE('station')}, obs_ts, {_NUM}, text_desc, flight_category, raw FROM weather_obs WHERE station IS NOT NULL AND obs_ts IS NOT NULL) {_FIRST('station, obs_ts', [*MEASURES, 'text_desc', 'flight_category', 'raw'])}",
    "sink_weather_alerts": f"SELECT * FROM (SELECT alert_id, {_PLACE('airport')}, event, severity, effective_ts, ends_ts, raw FROM weather_alerts WHERE alert_id IS NOT NULL AND airport IS NOT NULL) {_FIRST('alert_id, airport', ['event', 'severity', 'effective_ts', 'ends_ts', 'raw'])}",
    "sink_drops": f"SELECT CASE WHEN visibility_m IS NULL THEN 'undecodable' WHEN ceiling_ft IS NULL THEN 'non_object' WHEN station IS NULL OR obs_ts IS NULL THEN 'unwritable' ELSE 'written' END AS outcome, count(*) AS n FROM (SELECT station, obs_ts, {_NUM} FROM weather_obs) GROUP BY 1",
    "sink_arrivals": f"WITH {_ARR} SELECT * FROM a WHERE callsign IS NOT NULL OR est_arrival_ts::DATE > (SELECT max(est_arrival_ts::DATE) FROM a) - 3 {_FIRST(_ARRIVAL, ['callsign', 'first_seen', 'last_seen'])}",
    "ground_truth_pull": f"WITH {_ARR}, b AS (SELECT icao24, airport, date_trunc('second', est_arrival_ts) AS est_arrival_ts, callsign, coalesce(date_trunc('second', first_seen), date_trunc('second', est_arrival_ts)) AS first_seen, date_trunc('second', est_arrival_ts) AS last_seen FROM a) SELECT * FROM b {_FIRST(_ARRIVAL, ['callsign', 'first_seen', 'last_seen'])}",
    "sink_gold": f"{lake.GOLD_SQL} SELECT * FROM gold",
    "metar_files": lake.SQL["metar_silver"],
    "obs_changes": f"SELECT DISTINCT {_PLACE('station')}, obs_ts FROM weather_obs WHERE station IS NOT NULL AND obs_ts IS NOT NULL",
    "airports": "SELECT * FROM (VALUES ('JFK', 40.6413::DOUBLE, -73.7781::DOUBLE), ('LGA', 40.7769, -73.8740), ('EWR', 40.6895, -74.1745)) t(airport, a_lat, a_lon)",
    "history_bundle": " UNION ALL ".join(f"SELECT '{n}' AS slice, count(*) AS documents FROM ({q})" for n, q in _DOCS.items()),
    "snapshot_parts": " UNION ALL ".join(f"SELECT '{n}' AS part, count(*) AS documents, count(DISTINCT {c}) AS identities FROM ({serving.SQL[q]})" for n, (q, c) in _PARTS.items()),
    **{f"wind_scatter_{c.lower()}": f"{marts.HOURLY_SQL} SELECT airport, hour_ts, arrivals_detected, coalesce(wind_gust_kmh, wind_speed_kmh) AS effective_wind_kmh, flight_category FROM ah WHERE hour_ts > (SELECT max(hour_ts) FROM sp) - INTERVAL 30 DAY AND coalesce(wind_gust_kmh, wind_speed_kmh) IS NOT NULL AND flight_category = '{c}'" for c in ("VFR", "MVFR", "LIFR")},
}
