"""Relations the plans read: current rows of the test tables, and lakehouse inputs projected from the star schema.

SQL holds the same relations as common table expressions, for checking the plans against another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.functions import weather
from apronflow.functions.common import ntz
from apronflow.operators import keys
from apronflow.operators.dedupe import one_per_key, packed
from apronflow.operators.upsert import greatest_per_key
from apronflow.sources.tables import readings, table


def flight_events(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event_id: the last version by detected_at."""
    raw = table(spark, folder, "flight_events")
    rows = raw.select(
        "event_id", keys.icao("icao24").alias("icao24"), F.nullif(F.trim("callsign"), F.lit("")).alias("callsign"), "event_type",
        keys.place("airport").alias("airport"), "event_ts", F.col("duration_s").cast("int").alias("duration_s"), "details", "detected_at",
    )
    return greatest_per_key(rows, ["event_id"], ["detected_at", "callsign", "duration_s", "details"])


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Reported arrivals, one row per aircraft, airport and time."""
    raw = table(spark, folder, "arrivals_reported")
    rows = raw.select(keys.icao("icao24").alias("icao24"), keys.place("airport").alias("airport"), "est_arrival_ts").distinct()
    return rows.where(F.col("icao24").isNotNull() & F.col("airport").isNotNull() & F.col("est_arrival_ts").isNotNull())


def weather_obs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per station and time: fill values are missing, the greatest of amended rows counts, the category is derived."""
    raw = table(spark, folder, "weather_obs")
    usable = lambda c, lo, hi: F.when(F.col(c).between(lo, hi) & ~F.isnan(c), F.col(c)).alias(c)
    rows = raw.select(
        keys.place("station").alias("station"), "obs_ts", usable("visibility_m", 0, 100_000), usable("ceiling_ft", 0, 60_000), usable("wind_speed_kmh", 0, 500),
        usable("wind_gust_kmh", 0, 500), usable("wind_dir_deg", 0, 360), usable("temp_c", -90, 70), usable("precip_last_hr_mm", 0, 1000), "text_desc",
    ).where(F.col("station").isNotNull() & F.col("obs_ts").isNotNull())
    rest = [c for c in rows.columns if c not in ("station", "obs_ts")]
    one = rows.groupBy("station", "obs_ts").agg(F.max(F.struct(*rest)).alias("x")).select("station", "obs_ts", "x.*")
    return one.withColumn("flight_category", weather.category_metric(F.col("ceiling_ft"), F.col("visibility_m")))


def weather_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct alerts with an end: ends_ts, or the time of expiry in the raw record."""
    raw = table(spark, folder, "weather_alerts")
    end = F.coalesce(F.col("ends_ts").cast("timestamp"), F.try_to_timestamp(F.get_json_object("raw", "$.expires")))
    rows = raw.select("alert_id", keys.place("airport").alias("airport"), "event", "severity", "effective_ts", ntz(end).alias("ends_ts"))
    return rows.where(F.col("alert_id").isNotNull() & F.col("airport").isNotNull() & F.col("effective_ts").isNotNull()).distinct()


def placed_states(spark: SparkSession, folder: str) -> DataFrame:
    """Reports with a position, copies included."""
    columns = ("callsign", "lat", "lon", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category", "poll_ts", "delivery_id")
    rows = readings(table(spark, folder, "state_messages"), *columns).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return rows.withColumn("callsign", F.nullif(F.trim("callsign"), F.lit("")))


def live_states(spark: SparkSession, folder: str, ago_s: int = 0) -> DataFrame:
    """Latest position of each aircraft, as the guarded upsert leaves it; ago_s seconds before the newest report."""
    rows = placed_states(spark, folder)
    rows = rows.where(F.col("ts") <= rows.agg(F.max("ts")).scalar() - ago_s) if ago_s else rows
    return one_per_key(rows, ["icao24"], packed((F.col("ts"), 12), (F.col("poll_ts"), 12), (-F.col("delivery_id"), 14)))


def ontime_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Flight legs as text, projected from lineitem; each row's load month tells its version."""
    x = table(spark, folder, "lineitem")
    text: dict[str, Column] = {
        "FlightDate": F.date_format("l_shipdate", "yyyy-MM-dd"),
        "Reporting_Airline": F.concat(F.lit("C"), (F.col("l_suppkey") % 7).cast("string")),
        "Flight_Number_Reporting_Airline": F.col("l_orderkey").cast("string"),
        "Origin": F.concat(F.lit("O"), (F.col("l_partkey") % 20).cast("string")),
        "Dest": F.element_at(F.array(*map(F.lit, ("JFK", "LGA", "EWR", "BOS"))), (F.col("l_suppkey") % 4 + 1).cast("int")),
        "CRSDepTime": F.col("l_linenumber").cast("string"),
        "ArrDelay": F.when(F.col("l_partkey") % 50 == 0, "").otherwise((F.col("l_quantity").cast("long") - 15).cast("string")),
        "ArrDel15": F.when(F.col("l_quantity") >= 30, "1.00").otherwise("0.00"),
        "Cancelled": F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.05), "1.00").otherwise("0.00"),
        "CancellationCode": F.when((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.05), F.when(F.col("l_linestatus") == "F", "B").otherwise("A")).otherwise(""),
        "WeatherDelay": F.when(F.col("l_shipdate") >= F.lit("1997-06-01").cast("timestamp_ntz"), F.round(F.col("l_tax") * 100).cast("long").cast("string")).otherwise(""),
        "NASDelay": F.when(F.col("l_shipdate") >= F.lit("1997-06-01").cast("timestamp_ntz"), (F.col("l_orderkey") % 13).cast("string")).otherwise(""),
        "_ingest_ym": F.concat(F.lit("v"), F.lpad((F.col("l_partkey") % 97).cast("string"), 2, "0")),
    }
    return x.select(*[c.alias(n) for n, c in text.items()])


def metar_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Station reports as text with missing markers, projected from orders."""
    x = table(spark, folder, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cover = lambda n: F.element_at(F.array(*map(F.lit, ("FEW", "SCT", "BKN", "OVC ", "VV", "M"))), (((k + n) % 6) + 1).cast("int"))
    base = lambda n: F.when((k + n) % 9 == 0, "M").when((k + n) % 11 == 0, "").otherwise(((k * 97 + c * n) % 60 * 100).cast("string"))
    return x.select(
        F.element_at(F.array(*map(F.lit, ("JFK", "LGA", "EWR"))), ((c % 3) + 1).cast("int")).alias("station"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":51")).alias("valid"),
        F.when(k % 17 == 0, "M").when(k % 19 == 0, "T").otherwise((k * 53 % 160 / F.lit(16.0)).cast("decimal(6,2)").cast("string")).alias("vsby"),
        *[cover(n).alias(f"skyc{n}") for n in range(1, 5)],
        *[base(n).alias(f"skyl{n}") for n in range(1, 5)],
    )


_CLEAN = lambda c, f: f"{f}(regexp_replace({c}, '\\s', '', 'g'))"
_CATEGORY = """CASE WHEN ceiling_ft < 500 OR visibility_m / 1609.344 < 1 THEN 'LIFR' WHEN ceiling_ft < 1000 OR visibility_m / 1609.344 < 3 THEN 'IFR'
  WHEN ceiling_ft <= 3000 OR visibility_m / 1609.344 <= 5 THEN 'MVFR' WHEN ceiling_ft IS NOT NULL OR visibility_m IS NOT NULL THEN 'VFR' END"""


def _range(c: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {c} BETWEEN {lo} AND {hi} AND NOT isnan({c}) THEN {c} END AS {c}"


_OBS = ("visibility_m", "ceiling_ft", "wind_speed_kmh", "wind_gust_kmh", "wind_dir_deg", "temp_c", "precip_last_hr_mm", "text_desc")

SQL = {
    "ev": f"""ev AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY detected_at DESC NULLS LAST, callsign DESC NULLS LAST, duration_s DESC NULLS LAST, details DESC NULLS LAST) AS k
  FROM (SELECT event_id, {_CLEAN('icao24', 'lower')} AS icao24, nullif(trim(callsign), '') AS callsign, event_type, {_CLEAN('airport', 'upper')} AS airport, event_ts, duration_s, details, detected_at FROM flight_events)) WHERE k = 1)""",
    "gt": f"""gt AS (SELECT DISTINCT {_CLEAN('icao24', 'lower')} AS icao24, {_CLEAN('airport', 'upper')} AS airport, est_arrival_ts FROM arrivals_reported WHERE icao24 IS NOT NULL AND airport IS NOT NULL AND est_arrival_ts IS NOT NULL)""",
    "ob": f"""ob AS (SELECT * EXCLUDE (k), {_CATEGORY} AS flight_category FROM (SELECT *, row_number() OVER (PARTITION BY station, obs_ts ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in _OBS)}) AS k
  FROM (SELECT {_CLEAN('station', 'upper')} AS station, obs_ts, {_range('visibility_m', 0, 100000)}, {_range('ceiling_ft', 0, 60000)}, {_range('wind_speed_kmh', 0, 500)}, {_range('wind_gust_kmh', 0, 500)},
    {_range('wind_dir_deg', 0, 360)}, {_range('temp_c', -90, 70)}, {_range('precip_last_hr_mm', 0, 1000)}, text_desc FROM weather_obs WHERE station IS NOT NULL AND obs_ts IS NOT NULL)) WHERE k = 1)""",
    "al": f"""al AS (SELECT DISTINCT alert_id, {_CLEAN('airport', 'upper')} AS airport, event, severity, effective_ts,
  coalesce(ends_ts, timezone('UTC', try_cast(json_extract_string(raw, '$.expires') AS TIMESTAMPTZ))) AS ends_ts FROM weather_alerts WHERE alert_id IS NOT NULL AND airport IS NOT NULL AND effective_ts IS NOT NULL)""",
    "ls": f"""ls AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY ts DESC, poll_ts DESC, delivery_id) AS k
  FROM (SELECT {_CLEAN('icao24', 'lower')} AS icao24, CASE WHEN api_ts < 100000000000 THEN api_ts ELSE api_ts // 1000 END AS ts, nullif(trim(callsign), '') AS callsign, lat, lon,
    CASE WHEN NOT isnan(baro_alt_m) THEN baro_alt_m END AS baro_alt_m, on_ground, CASE WHEN NOT isnan(velocity_ms) THEN velocity_ms END AS velocity_ms, CASE WHEN NOT isnan(track_deg) THEN track_deg END AS track_deg,
    CASE WHEN NOT isnan(vrate_ms) THEN vrate_ms END AS vrate_ms, category, poll_ts, delivery_id FROM state_messages
    WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon))) WHERE k = 1)""",
    "bz": """bz AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS FlightDate, 'C' || (l_suppkey % 7) AS Reporting_Airline, l_orderkey::VARCHAR AS Flight_Number_Reporting_Airline, 'O' || (l_partkey % 20) AS Origin,
  (['JFK', 'LGA', 'EWR', 'BOS'])[l_suppkey % 4 + 1] AS Dest, l_linenumber::VARCHAR AS CRSDepTime, CASE WHEN l_partkey % 50 = 0 THEN '' ELSE (l_quantity::BIGINT - 15)::VARCHAR END AS ArrDelay,
  CASE WHEN l_quantity >= 30 THEN '1.00' ELSE '0.00' END AS ArrDel15, CASE WHEN l_returnflag = 'R' AND l_discount >= 0.05 THEN '1.00' ELSE '0.00' END AS Cancelled,
  CASE WHEN l_returnflag = 'R' AND l_discount >= 0.05 THEN CASE WHEN l_linestatus = 'F' THEN 'B' ELSE 'A' END ELSE '' END AS CancellationCode,
  CASE WHEN l_shipdate >= TIMESTAMP '1997-06-01' THEN round(l_tax * 100)::BIGINT::VARCHAR ELSE '' END AS WeatherDelay, CASE WHEN l_shipdate >= TIMESTAMP '1997-06-01' THEN (l_orderkey % 13)::VARCHAR ELSE '' END AS NASDelay,
  'v' || lpad((l_partkey % 97)::VARCHAR, 2, '0') AS _ingest_ym FROM lineitem)""",
    "mr": """mr AS (SELECT (['JFK', 'LGA', 'EWR'])[o_custkey % 3 + 1] AS station, strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad((o_orderkey % 24)::VARCHAR, 2, '0') || ':51' AS valid,
  CASE WHEN o_orderkey % 17 = 0 THEN 'M' WHEN o_orderkey % 19 = 0 THEN 'T' ELSE ((o_orderkey * 53 % 160) / 16.0)::DECIMAL(6,2)::VARCHAR END AS vsby, """
    + ", ".join(f"(['FEW', 'SCT', 'BKN', 'OVC ', 'VV', 'M'])[(o_orderkey + {n}) % 6 + 1] AS skyc{n}" for n in range(1, 5))
    + ", "
    + ", ".join(f"CASE WHEN (o_orderkey + {n}) % 9 = 0 THEN 'M' WHEN (o_orderkey + {n}) % 11 = 0 THEN '' ELSE ((o_orderkey * 97 + o_custkey * {n}) % 60 * 100)::VARCHAR END AS skyl{n}" for n in range(1, 5))
    + " FROM orders)",
}

#: ls as it was 16 hours before the newest report.
_PAST = "WHERE icao24 IS NOT NULL AND api_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)"
SQL["lp"] = SQL["ls"].replace("ls AS", "lp AS", 1).replace(_PAST, f"{_PAST} AND CASE WHEN api_ts < 100000000000 THEN api_ts ELSE api_ts // 1000 END <= (SELECT max(CASE WHEN api_ts < 100000000000 THEN api_ts ELSE api_ts // 1000 END) - 57600 FROM state_messages {_PAST})")


def with_views(*names: str) -> str:
    """The WITH clause's beginning, with the named relations."""
    return "WITH " + ",\n".join(SQL[n] for n in names)
