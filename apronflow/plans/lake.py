"""Lakehouse layers (bronze, silver, gold) and the history queries over gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apronflow.functions import weather
from apronflow.functions.common import half_up, mean, share, total
from apronflow.operators.dedupe import fingerprint, one_per_key, packed
from apronflow.plans.marts import avg, half
from apronflow.operators.upsert import write_clustered
from apronflow.sources import views
from apronflow.sources.store import stored

DESTINATIONS = ("JFK", "LGA", "EWR")
WORST_METRICS = {"wx_cancelled": "cancelled_weather", "wx_delay": "weather_delay_min_total"}
FLIGHT_KEY = ["flight_date", "carrier", "flight_number", "origin", "dest", "crs_dep_time"]


def silver_ontime(bronze: DataFrame) -> DataFrame:
    """Typed flight legs, one per natural key: the version of the latest load month wins.

    Load months are told apart by their digits (yyyy-MM). Of two versions of one month, which the
    source does not give, the one with the greater fingerprint stays, on every run the same.
    """
    measure = lambda c, n: F.col(c).try_cast("double").alias(n)
    typed = bronze.select(
        F.col("FlightDate").try_cast("date").alias("flight_date"), F.col("Reporting_Airline").alias("carrier"), F.col("Flight_Number_Reporting_Airline").alias("flight_number"),
        F.col("Origin").alias("origin"), F.col("Dest").alias("dest"), F.col("CRSDepTime").alias("crs_dep_time"), measure("ArrDelay", "arr_delay_min"), measure("ArrDel15", "arr_del15"),
        measure("Cancelled", "cancelled"), F.nullif(F.col("CancellationCode"), F.lit("")).alias("cancellation_code"), measure("WeatherDelay", "weather_delay_min"), measure("NASDelay", "nas_delay_min"), "_ingest_ym",
    ).where(F.col("flight_date").isNotNull())
    month = F.regexp_replace("_ingest_ym", r"\D", "").try_cast("long")
    measures = [c for c in typed.columns if c not in FLIGHT_KEY]
    return one_per_key(typed, FLIGHT_KEY, packed((month, 18), fingerprint(*measures))).withColumn("year", F.year("flight_date"))


def silver_metar(raw: DataFrame) -> DataFrame:
    """Parsed observations with their category, one per station and time (the greatest of repeated ones)."""
    obs = raw.select(
        "station", F.try_to_timestamp("valid", F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz").alias("obs_ts"), weather.number(F.col("vsby")).alias("visibility_sm"),
        weather.ceiling_slots([F.col(f"skyc{i}") for i in range(1, 5)], [F.col(f"skyl{i}") for i in range(1, 5)]).alias("ceiling_ft"),
    ).where(F.col("obs_ts").isNotNull())
    hundredths = lambda c: F.floor(F.col(c) * 100 + 0.5).cast("long")
    one = one_per_key(obs, ["station", "obs_ts"], packed((hundredths("visibility_sm"), 18), (hundredths("ceiling_ft"), 18)))
    return one.withColumn("flight_category", weather.category(F.col("ceiling_ft"), F.col("visibility_sm")))


def gold_day_delay(ontime: DataFrame, metar: DataFrame) -> DataFrame:
    """Day and airport: arrivals, delays and the day's weather."""
    counted = lambda c: F.sum(F.when(c, 1).otherwise(0))
    arrivals = ontime.where(F.col("dest").isin(*DESTINATIONS)).groupBy("flight_date", F.col("dest").alias("airport")).agg(
        F.count(F.lit(1)).alias("arrivals_scheduled"), counted(F.col("cancelled") == 1.0).alias("cancelled"), counted(F.col("cancellation_code") == "B").alias("cancelled_weather"),
        mean("arr_delay_min").alias("avg_arr_delay_min"), F.percentile_approx("arr_delay_min", 0.9, 10_000).alias("p90_arr_delay_min"), counted(F.col("arr_del15") == 1.0).alias("arrivals_delayed_15"),
        total("weather_delay_min").alias("weather_delay_min_total"), total("nas_delay_min").alias("nas_delay_min_total"),
    )
    seen = metar.where(F.col("station").isin(*DESTINATIONS) & F.col("flight_category").isNotNull()).withColumn("severity", weather.severity(F.col("flight_category")))
    daily = seen.groupBy(F.to_date("obs_ts").alias("flight_date"), F.col("station").alias("airport")).agg(
        weather.category_of(F.max("severity")).alias("worst_category"), share(F.count_if(F.col("severity") >= 2), F.count(F.lit(1))).alias("pct_obs_ifr_or_worse"),
        F.min("visibility_sm").alias("min_visibility_sm"), F.min("ceiling_ft").alias("min_ceiling_ft"), F.count(F.lit(1)).alias("obs_count"),
    )
    return arrivals.join(daily, ["flight_date", "airport"], "left")


def checked_year(name: str, value: int) -> int:
    if not 1987 <= value <= 2100:
        raise ValueError(f"{name} must be from 1987 to 2100")
    return value


def checked_limit(value: int, most: int) -> int:
    if not 1 <= value <= most:
        raise ValueError(f"limit must be from 1 to {most}")
    return value


def staircase(gold: DataFrame, from_year: int = 1987, to_year: int = 2100) -> DataFrame:
    if checked_year("from_year", from_year) > checked_year("to_year", to_year):
        raise ValueError("from_year must not be after to_year")
    days = gold.where(F.col("worst_category").isNotNull() & F.year("flight_date").between(from_year, to_year))
    late = mean(share(F.col("arrivals_delayed_15"), F.col("arrivals_scheduled")))
    return days.groupBy("airport", "worst_category").agg(
        F.count(F.lit(1)).alias("days"), half_up(mean("avg_arr_delay_min"), 1).alias("avg_delay_min"), half_up(mean("p90_arr_delay_min"), 1).alias("avg_p90_delay_min"), half_up(late * 100, 1).alias("pct_arrivals_late15"),
    ).orderBy("airport", weather.rank_in(F.col("worst_category"), *weather.CATEGORIES))


def staircase_pivot(gold: DataFrame) -> DataFrame:
    rows = gold.where(F.col("worst_category").isNotNull()).groupBy("worst_category").pivot("airport", list(DESTINATIONS)).agg(half_up(mean("avg_arr_delay_min"), 1))
    return rows.orderBy(weather.rank_in(F.col("worst_category"), *weather.CATEGORIES))


def worst_per_airport(gold: DataFrame, k: int = 10) -> DataFrame:
    """The k days with most weather cancellations of each airport; ties go to the earlier day."""
    order = Window.partitionBy("airport").orderBy(F.desc_nulls_last("cancelled_weather"), "flight_date")
    # a rank filter right above the window lets each task keep k rows of each airport before the shuffle
    top = gold.withColumn("k", F.row_number().over(order)).where(F.col("k") <= k)
    hours = half_up(F.col("weather_delay_min_total") / 60, 1).alias("weather_delay_hours")
    return top.select("flight_date", "airport", "worst_category", "arrivals_scheduled", "cancelled", "cancelled_weather", hours)


def worst_days(gold: DataFrame, limit: int = 10, metric: str = "wx_cancelled") -> DataFrame:
    checked_limit(limit, 50)
    if metric not in WORST_METRICS:
        raise ValueError(f"metric must be one of {tuple(WORST_METRICS)}")
    rows = gold.where(F.col("cancelled_weather").isNotNull()).orderBy(F.desc_nulls_last(WORST_METRICS[metric]), "flight_date", "airport").limit(limit)
    return rows.select("flight_date", "airport", "worst_category", "arrivals_scheduled", "cancelled", "cancelled_weather", half_up(F.col("weather_delay_min_total") / 60.0, 1).alias("wx_delay_hours"), "min_visibility_sm", "min_ceiling_ft")


def causes_by_year(gold: DataFrame) -> DataFrame:
    rows = gold.groupBy(F.year("flight_date").alias("year")).agg(total("weather_delay_min_total").alias("w"), total("nas_delay_min_total").alias("n")).where(F.col("w").isNotNull())
    return rows.select("year", half_up(F.col("w") / 60000.0, 1).alias("weather_khr"), half_up(F.col("n") / 60000.0, 1).alias("nas_khr")).orderBy("year")


def weather_share(gold: DataFrame, since: str = "2003-06-01") -> DataFrame:
    rows = gold.where(F.col("flight_date") >= F.lit(since).cast("date")).groupBy(F.year("flight_date").alias("yr")).agg(total("weather_delay_min_total").alias("w"), total("nas_delay_min_total").alias("n"))
    return rows.select("yr", half_up(F.col("w") / 60000, 1).alias("weather_khrs"), half_up(F.col("n") / 60000, 1).alias("nas_khrs"), half_up(share(F.col("w"), F.col("w") + F.col("n")) * 100, 1).alias("weather_pct_of_wx_nas")).orderBy("yr")


def seasonality(gold: DataFrame) -> DataFrame:
    return gold.groupBy(F.month("flight_date").alias("mon"), "airport").agg(F.sum("cancelled_weather").alias("wx_cancels"), half_up(mean("pct_obs_ifr_or_worse") * 100, 1).alias("pct_obs_ifr_plus")).orderBy("mon", "airport")


def month_pivot(gold: DataFrame) -> DataFrame:
    rows = gold.groupBy(F.month("flight_date").alias("mon"), F.date_format("flight_date", "MMM").alias("month")).pivot("airport", list(DESTINATIONS)).agg(F.sum("cancelled_weather"))
    return rows.orderBy("mon").drop("mon")


def monthly(gold: DataFrame, category: str | None = None, airport: str | None = None, since: int = 2000) -> DataFrame:
    if category is not None and category not in weather.CATEGORIES:
        raise ValueError(f"category must be one of {weather.CATEGORIES}")
    if airport is not None and airport not in DESTINATIONS:
        raise ValueError(f"airport must be one of {DESTINATIONS}")
    rows = gold.where(F.col("worst_category").isNotNull() & (F.year("flight_date") >= since))
    for name, value in (("worst_category", category), ("airport", airport)):
        rows = rows.where(F.col(name) == value) if value is not None else rows
    return rows.groupBy(F.trunc("flight_date", "month").alias("month"), "worst_category").agg(half_up(mean("avg_arr_delay_min"), 1).alias("avg_delay_min")).orderBy("month", "worst_category")


def monthly_band(gold: DataFrame) -> DataFrame:
    """Least, mean and greatest daily delay by month and category, one series per row."""
    d = F.col("avg_arr_delay_min")
    rows = gold.where(F.col("worst_category").isNotNull() & d.isNotNull()).groupBy(F.trunc("flight_date", "month").alias("month"), "worst_category").agg(F.max(d).alias("max"), mean(d).alias("avg"), F.min(d).alias("min"))
    series = F.array(*[F.struct(F.concat("worst_category", F.lit(f" {n}")).alias("metric"), half_up(F.col(n), 1).alias("value")) for n in ("max", "avg", "min")])
    return rows.select("month", F.explode(series).alias("s")).select("month", "s.metric", "s.value")


def volume_receipt(silver: DataFrame, gold: DataFrame) -> DataFrame:
    def layer(name: str, df: DataFrame, place: str) -> DataFrame:
        return df.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("rows"), F.min("flight_date").alias("from_date"), F.max("flight_date").alias("to_date"), F.countDistinct(place).alias("airports"))

    return layer("silver_ontime", silver, "dest").unionByName(layer("gold_airport_day_delay", gold, "airport"))


def date_drill(gold: DataFrame, first: str, last: str) -> DataFrame:
    rows = gold.where(F.col("flight_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).groupBy("flight_date")
    return rows.agg(F.sum("arrivals_scheduled").alias("scheduled"), F.sum("cancelled").alias("cancelled"), half_up(share(F.sum("cancelled"), F.sum("arrivals_scheduled")) * 100, 1).alias("pct_cancelled")).orderBy("flight_date")


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return silver_ontime(views.ontime_bronze(spark, folder))


def _metar(spark: SparkSession, folder: str) -> DataFrame:
    return silver_metar(views.metar_raw(spark, folder))


def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    """The written silver layer: by year, rows of one destination together, as gold reads few destinations."""
    return stored(spark, folder, "silver_ontime", ["lineitem"], lambda: _silver(spark, folder), lambda df, at: write_clustered(df, at, "dest", "year"))


def metar_table(spark: SparkSession, folder: str) -> DataFrame:
    return stored(spark, folder, "silver_metar", ["orders"], lambda: _metar(spark, folder), lambda df, at: df.repartition("station").write.mode("overwrite").partitionBy("station").parquet(at))


def gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """The written gold mart, which the history queries read: a row per day and airport, whatever the number of flights."""
    return stored(spark, folder, "gold_airport_day_delay", ["lineitem", "orders"], lambda: gold_day_delay(silver_table(spark, folder), metar_table(spark, folder)).repartition(1))


def _on_gold(f, *args):
    return lambda spark, folder: f(gold_table(spark, folder), *args)


def maintenance(spark: SparkSession, folder: str) -> DataFrame:
    """What a rebuild of silver leaves: rows in and out, the rows it has dropped, and years written."""
    count, none = F.count(F.lit(1)), F.lit(0).cast("long")
    read = views.ontime_bronze(spark, folder).agg(count.alias("rows_in"), none.alias("rows_out"), none.alias("years"))
    left = silver_table(spark, folder).agg(none.alias("rows_in"), count.alias("rows_out"), F.countDistinct("year").alias("years"))
    both = read.unionByName(left).agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "years")])
    return both.withColumn("dropped", F.col("rows_in") - F.col("rows_out"))


QUERIES = {
    "ontime_silver": _silver,
    "metar_silver": _metar,
    "gold_day_delay": lambda spark, folder: gold_day_delay(_silver(spark, folder), _metar(spark, folder)),
    "gold_table": gold_table,
    "silver_maintenance": maintenance,
    "staircase": _on_gold(staircase),
    "staircase_pivot": _on_gold(staircase_pivot),
    "worst_topn_per_airport": _on_gold(worst_per_airport),
    "worst_topk": _on_gold(worst_days, 12),
    "worst_topk_delay": _on_gold(worst_days, 50, "wx_delay"),
    "causes_by_year": _on_gold(causes_by_year),
    "weather_share": _on_gold(weather_share, "1997-06-01"),
    "seasonality": _on_gold(seasonality),
    "month_pivot": _on_gold(month_pivot),
    "monthly": _on_gold(monthly, None, None, 1992),
    "monthly_filtered": _on_gold(monthly, "IFR", "JFK", 1992),
    "monthly_band": _on_gold(monthly_band),
    "volume_receipt": lambda spark, folder: volume_receipt(silver_table(spark, folder), gold_table(spark, folder)),
    "date_drill": _on_gold(date_drill, "1995-03-01", "1995-04-15"),
}

_KEY = ", ".join(FLIGHT_KEY)
_SILVER = f"""so AS (SELECT * EXCLUDE (k), year(flight_date) AS year FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY _ingest_ym DESC, arr_delay_min DESC NULLS LAST, arr_del15 DESC NULLS LAST, cancelled DESC NULLS LAST,
    cancellation_code DESC NULLS LAST, weather_delay_min DESC NULLS LAST, nas_delay_min DESC NULLS LAST) AS k
  FROM (SELECT try_cast(FlightDate AS DATE) AS flight_date, Reporting_Airline AS carrier, Flight_Number_Reporting_Airline AS flight_number, Origin AS origin, Dest AS dest, CRSDepTime AS crs_dep_time,
    try_cast(ArrDelay AS DOUBLE) AS arr_delay_min, try_cast(ArrDel15 AS DOUBLE) AS arr_del15, try_cast(Cancelled AS DOUBLE) AS cancelled, nullif(CancellationCode, '') AS cancellation_code,
    try_cast(WeatherDelay AS DOUBLE) AS weather_delay_min, try_cast(NASDelay AS DOUBLE) AS nas_delay_min, _ingest_ym FROM bz)) WHERE k = 1)"""
_N = lambda c: f"CASE WHEN trim({c}) NOT IN ('M', 'T', '') THEN try_cast(trim({c}) AS DOUBLE) END"
_SLOTS = ", ".join(f"CASE WHEN trim(skyc{i}) IN ('BKN', 'OVC', 'VV') THEN {_N(f'skyl{i}')} END" for i in range(1, 5))
_METAR = f"""mo AS (SELECT *, CASE WHEN ceiling_ft < 500 OR visibility_sm < 1 THEN 'LIFR' WHEN ceiling_ft < 1000 OR visibility_sm < 3 THEN 'IFR' WHEN ceiling_ft <= 3000 OR visibility_sm <= 5 THEN 'MVFR'
    WHEN ceiling_ft IS NOT NULL OR visibility_sm IS NOT NULL THEN 'VFR' END AS flight_category
  FROM (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY station, obs_ts ORDER BY visibility_sm DESC NULLS LAST, ceiling_ft DESC NULLS LAST) AS k
    FROM (SELECT station, try_strptime(valid, '%Y-%m-%d %H:%M') AS obs_ts, {_N('vsby')} AS visibility_sm, least({_SLOTS}) AS ceiling_ft FROM mr)) WHERE k = 1))"""
_GOLD = f"""ar AS (SELECT flight_date, dest AS airport, count(*) AS arrivals_scheduled, count(*) FILTER (cancelled = 1) AS cancelled, count(*) FILTER (cancellation_code = 'B') AS cancelled_weather, {avg('arr_delay_min')} AS avg_arr_delay_min,
    quantile_disc(arr_delay_min, 0.9) AS p90_arr_delay_min, count(*) FILTER (arr_del15 = 1) AS arrivals_delayed_15, sum(weather_delay_min::DECIMAL(18,4))::DOUBLE AS weather_delay_min_total, sum(nas_delay_min::DECIMAL(18,4))::DOUBLE AS nas_delay_min_total
  FROM so WHERE dest IN ('JFK', 'LGA', 'EWR') GROUP BY 1, 2),
wd AS (SELECT obs_ts::DATE AS flight_date, station AS airport, (['VFR', 'MVFR', 'IFR', 'LIFR'])[max(list_position(['VFR', 'MVFR', 'IFR', 'LIFR'], flight_category))] AS worst_category,
    (count(*) FILTER (flight_category IN ('IFR', 'LIFR')))::DOUBLE / count(*) AS pct_obs_ifr_or_worse, min(visibility_sm) AS min_visibility_sm, min(ceiling_ft) AS min_ceiling_ft, count(*) AS obs_count
  FROM mo WHERE flight_category IS NOT NULL GROUP BY 1, 2),
gold AS (SELECT * FROM ar LEFT JOIN wd USING (flight_date, airport))"""
_SO = f"{views.with_views('bz')},\n{_SILVER}"
GOLD_SQL = f"{views.with_views('bz', 'mr')},\n{_SILVER},\n{_METAR},\n{_GOLD}"
_T = lambda c: f"sum({c}::DECIMAL(18,4))::DOUBLE"
_P = lambda f: ", ".join(f'{f.format(a=a)} AS "{a}"' for a in DESTINATIONS)
_DAYS = "SELECT flight_date, airport, worst_category, arrivals_scheduled, cancelled, cancelled_weather, "

SQL = {
    "ontime_silver": f"{_SO} SELECT * FROM so",
    "metar_silver": f"{views.with_views('mr')},\n{_METAR} SELECT * FROM mo",
    "gold_day_delay": f"{GOLD_SQL} SELECT * FROM gold",
    "gold_table": f"{GOLD_SQL} SELECT * FROM gold",
    "silver_maintenance": f"{_SO} SELECT (SELECT count(*) FROM bz) AS rows_in, count(*) AS rows_out, count(DISTINCT year) AS years, (SELECT count(*) FROM bz) - count(*) AS dropped FROM so",
    "staircase": f"""{GOLD_SQL} SELECT airport, worst_category, count(*) AS days, {half(avg('avg_arr_delay_min'), 1)} AS avg_delay_min, {half(avg('p90_arr_delay_min'), 1)} AS avg_p90_delay_min,
  {half(avg('(arrivals_delayed_15::DOUBLE / nullif(arrivals_scheduled, 0))') + ' * 100', 1)} AS pct_arrivals_late15 FROM gold WHERE worst_category IS NOT NULL GROUP BY 1, 2""",
    "staircase_pivot": f"{GOLD_SQL} SELECT worst_category, " + ", ".join(f"""{half(avg(f"(CASE WHEN airport = '{a}' THEN avg_arr_delay_min END)"), 1)} AS "{a}" """ for a in DESTINATIONS) + " FROM gold WHERE worst_category IS NOT NULL GROUP BY 1",
    "worst_topn_per_airport": f"{GOLD_SQL} {_DAYS} {half('weather_delay_min_total / 60', 1)} AS weather_delay_hours FROM gold QUALIFY row_number() OVER (PARTITION BY airport ORDER BY cancelled_weather DESC NULLS LAST, flight_date) <= 10",
    "worst_topk": f"{GOLD_SQL} {_DAYS} {half('weather_delay_min_total / 60.0::DOUBLE', 1)} AS wx_delay_hours, min_visibility_sm, min_ceiling_ft FROM gold WHERE cancelled_weather IS NOT NULL ORDER BY cancelled_weather DESC NULLS LAST, flight_date, airport LIMIT 12",
    "worst_topk_delay": f"{GOLD_SQL} {_DAYS} {half('weather_delay_min_total / 60.0::DOUBLE', 1)} AS wx_delay_hours, min_visibility_sm, min_ceiling_ft FROM gold WHERE cancelled_weather IS NOT NULL ORDER BY weather_delay_min_total DESC NULLS LAST, flight_date, airport LIMIT 50",
    "causes_by_year": f"{GOLD_SQL} SELECT year(flight_date) AS year, {half(_T('weather_delay_min_total') + ' / 60000.0::DOUBLE', 1)} AS weather_khr, {half(_T('nas_delay_min_total') + ' / 60000.0::DOUBLE', 1)} AS nas_khr FROM gold GROUP BY 1 HAVING sum(weather_delay_min_total) IS NOT NULL",
    "weather_share": f"""{GOLD_SQL}, y AS (SELECT year(flight_date) AS yr, {_T('weather_delay_min_total')} AS w, {_T('nas_delay_min_total')} AS n FROM gold WHERE flight_date >= DATE '1997-06-01' GROUP BY 1)
SELECT yr, {half('w / 60000', 1)} AS weather_khrs, {half('n / 60000', 1)} AS nas_khrs, {half('w / nullif(w + n, 0) * 100', 1)} AS weather_pct_of_wx_nas FROM y""",
    "seasonality": f"{GOLD_SQL} SELECT month(flight_date) AS mon, airport, sum(cancelled_weather)::BIGINT AS wx_cancels, {half(avg('pct_obs_ifr_or_worse') + ' * 100', 1)} AS pct_obs_ifr_plus FROM gold GROUP BY 1, 2",
    "month_pivot": f"{GOLD_SQL} SELECT strftime(min(flight_date), '%b') AS month, " + _P("sum(cancelled_weather) FILTER (airport = '{a}')::BIGINT") + " FROM gold GROUP BY month(flight_date)",
    "monthly": f"{GOLD_SQL} SELECT date_trunc('month', flight_date)::DATE AS month, worst_category, {half(avg('avg_arr_delay_min'), 1)} AS avg_delay_min FROM gold WHERE worst_category IS NOT NULL AND year(flight_date) >= 1992 GROUP BY 1, 2",
    "monthly_filtered": f"{GOLD_SQL} SELECT date_trunc('month', flight_date)::DATE AS month, worst_category, {half(avg('avg_arr_delay_min'), 1)} AS avg_delay_min FROM gold WHERE worst_category = 'IFR' AND airport = 'JFK' AND year(flight_date) >= 1992 GROUP BY 1, 2",
    "monthly_band": f"""{GOLD_SQL}, b AS (SELECT date_trunc('month', flight_date)::DATE AS month, worst_category AS c, max(avg_arr_delay_min) AS hi, {avg('avg_arr_delay_min')} AS mid, min(avg_arr_delay_min) AS lo FROM gold WHERE worst_category IS NOT NULL AND avg_arr_delay_min IS NOT NULL GROUP BY 1, 2)
SELECT month, c || ' max' AS metric, {half('hi', 1)} AS value FROM b UNION ALL SELECT month, c || ' avg', {half('mid', 1)} FROM b UNION ALL SELECT month, c || ' min', {half('lo', 1)} FROM b""",
    "volume_receipt": f"""{GOLD_SQL} SELECT 'silver_ontime' AS tbl, count(*) AS rows, min(flight_date) AS from_date, max(flight_date) AS to_date, count(DISTINCT dest) AS airports FROM so
UNION ALL SELECT 'gold_airport_day_delay', count(*), min(flight_date), max(flight_date), count(DISTINCT airport) FROM gold""",
    "date_drill": f"""{GOLD_SQL} SELECT flight_date, sum(arrivals_scheduled)::BIGINT AS scheduled, sum(cancelled)::BIGINT AS cancelled, {half('sum(cancelled)::DOUBLE / nullif(sum(arrivals_scheduled), 0) * 100', 1)} AS pct_cancelled
FROM gold WHERE flight_date BETWEEN DATE '1995-03-01' AND DATE '1995-04-15' GROUP BY 1""",
}
