"""Queries of the llm problems on the test tables, and their SQL where SQL can tell the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apronflow.llm import nearest, packing, splitting, tokens
from apronflow.operators import keys
from apronflow.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "flight_events").select("event_id", "event_type", keys.icao("icao24").alias("icao24"), keys.place("airport").alias("airport"), keys.epoch("event_ts").alias("wanted_s"))
    events = events.where(F.col("event_id").isNotNull())
    obs = table(spark, folder, "weather_obs").select(keys.place("station").alias("entity"), keys.epoch("obs_ts").alias("time_s"))
    landings = table(spark, folder, "arrivals_reported").select(F.concat_ws("|", keys.icao("icao24"), keys.place("airport")).alias("entity"), keys.epoch("est_arrival_ts").alias("time_s"), keys.icao("icao24").alias("a"), keys.place("airport").alias("b"))
    landings = landings.where(F.col("a").isNotNull() & F.col("b").isNotNull()).drop("a", "b")
    weather = nearest.nearest_times(events.select("event_id", F.col("airport").alias("entity"), "wanted_s"), obs, 2700)
    arrived = events.where((F.col("event_type") == "arrival") & F.col("icao24").isNotNull() & F.col("airport").isNotNull())
    arrived = nearest.nearest_times(arrived.select("event_id", F.concat_ws("|", "icao24", "airport").alias("entity"), "wanted_s"), landings, 600)
    both = weather.select("event_id", F.lit("weather_obs").alias("src"), F.col("match_s").alias("match_ts"))
    return both.unionByName(arrived.select("event_id", F.lit("arrivals_reported").alias("src"), F.col("match_s").alias("match_ts"))).distinct()


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encoded(table(spark, folder, "documents"))


def p9_packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(packing.token_sizes(table(spark, folder, "documents")))


def p10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.pieces(table(spark, folder, "documents"))


def p9_checked(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of any packing: containers over the capacity, documents packed, and those split although they would fit."""
    parts = p9_packed(spark, folder)
    count = lambda c: F.count_if(c)
    full = parts.groupBy("container").agg(F.sum("tokens").alias("held")).agg(count(F.col("held") > packing.CAPACITY).alias("over_capacity"), F.lit(0).cast("long").alias("documents"), F.lit(0).cast("long").alias("split_small"))
    own = parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("n"))
    own = own.agg(F.lit(0).cast("long").alias("over_capacity"), F.count(F.lit(1)).alias("documents"), count((F.col("pieces") > 1) & (F.col("n") <= packing.CAPACITY)).alias("split_small"))
    return full.unionByName(own).agg(*[F.sum(c).alias(c) for c in ("over_capacity", "documents", "split_small")])


def p10_checked(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of any splitting: documents cut, pieces over the limit, and documents that their pieces do not give back."""
    documents, rule = table(spark, folder, "documents"), splitting.Split()
    got = splitting.pieces(documents.select("doc_id", "text"))
    fresh = F.when(F.col("piece") == 0, F.col("ids")).otherwise(F.slice("ids", rule.overlap + 1, F.greatest(F.size("ids") - rule.overlap, F.lit(0))))
    # a document's own pieces, which are as long as its text
    whole = got.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", fresh.alias("ids")))).alias("p"), F.count_if(F.col("tokens") > rule.limit).alias("long"))
    back = tokens.decoded(whole.select("doc_id", F.flatten(F.col("p.ids")).alias("ids"))).withColumnRenamed("text", "back")
    both = documents.where(F.length("text") > 0).select("doc_id", "text").join(back, "doc_id", "left").join(whole.select("doc_id", "long"), "doc_id", "left")
    return both.agg(F.count(F.lit(1)).alias("documents"), F.sum("long").alias("too_long"), F.count_if(~F.col("text").eqNullSafe(F.col("back"))).alias("not_given_back"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p3_found, p8_ids, p9_packed, p9_checked, p10_pieces, p10_checked)}

SQL: dict[str, str] = {
    "p9_checked": "SELECT 0::BIGINT AS over_capacity, count(*) AS documents, 0::BIGINT AS split_small FROM documents WHERE text <> ''",
    "p10_checked": "SELECT count(*) AS documents, 0::BIGINT AS too_long, 0::BIGINT AS not_given_back FROM documents WHERE text <> ''",
    "p3_found": """
WITH e AS (SELECT DISTINCT event_id, event_type, lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, upper(regexp_replace(airport, '\\s', '', 'g')) AS airport, epoch(event_ts)::BIGINT AS t FROM flight_events),
o AS (SELECT DISTINCT upper(regexp_replace(station, '\\s', '', 'g')) AS station, epoch(obs_ts)::BIGINT AS t FROM weather_obs),
r AS (SELECT DISTINCT lower(regexp_replace(icao24, '\\s', '', 'g')) AS icao24, upper(regexp_replace(airport, '\\s', '', 'g')) AS airport, epoch(est_arrival_ts)::BIGINT AS t FROM arrivals_reported),
p AS (SELECT event_id, e.t AS wanted, 'weather_obs' AS src, o.t FROM e JOIN o ON o.station = e.airport AND abs(o.t - e.t) <= 2700
  UNION ALL SELECT event_id, e.t, 'arrivals_reported', r.t FROM e JOIN r ON r.icao24 = e.icao24 AND r.airport = e.airport AND abs(r.t - e.t) <= 600 WHERE e.event_type = 'arrival')
SELECT event_id, src, t AS match_ts FROM (SELECT *, row_number() OVER (PARTITION BY event_id, wanted, src ORDER BY abs(t - wanted), t) AS k FROM p) WHERE k = 1""",
}
