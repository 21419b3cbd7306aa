"""Messages and raw records into typed rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apronflow.functions import weather
from apronflow.operators.upsert import write_partitions

#: The message contract: one row per position report.
ENVELOPE = T.StructType([
    T.StructField("poll_ts", T.LongType()), T.StructField("api_ts", T.LongType()), T.StructField("icao24", T.StringType()), T.StructField("callsign", T.StringType()),
    T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()), T.StructField("baro_alt_m", T.DoubleType()), T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity_ms", T.DoubleType()), T.StructField("track_deg", T.DoubleType()), T.StructField("vrate_ms", T.DoubleType()), T.StructField("category", T.IntegerType()),
])
#: Positions of the fields in a state vector.
SLOTS = {"icao24": 0, "callsign": 1, "lon": 5, "lat": 6, "baro_alt_m": 7, "on_ground": 8, "velocity_ms": 9, "track_deg": 10, "vrate_ms": 11, "category": 17}
QUANTITY = "struct<value: double, unitCode: string>"
OBSERVATION = (
    f"timestamp string, textDescription string, temperature {QUANTITY}, windSpeed {QUANTITY}, windGust {QUANTITY}, windDirection {QUANTITY}, visibility {QUANTITY}, "
    f"precipitationLastHour {QUANTITY}, cloudLayers array<struct<base: {QUANTITY}, amount: string>>"
)


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to envelope rows with their event time; what cannot be decoded is null throughout."""
    m = raw.select(F.from_json(F.col(value).cast("string"), ENVELOPE).alias("m")).select("m.*")
    return m.withColumn("api_time", F.timestamp_seconds("api_ts"))


def undecodable(raw: DataFrame, value: str = "value") -> DataFrame:
    """The messages that decode would turn into nothing: not JSON objects, or without the identifier."""
    m = F.from_json(F.col(value).cast("string"), ENVELOPE)
    return raw.where(m.isNull() | m["icao24"].isNull() | m["api_ts"].isNull())


def kafka(spark: SparkSession, servers: str, topic: str, replay_from_ms: int | None = None, partitions: int = 3, per_trigger: int = 50_000) -> DataFrame:
    """The stream from Kafka (its connector must be on the class path). A replay needs a fresh checkpoint to take effect."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("maxOffsetsPerTrigger", per_trigger)
    if replay_from_ms is None:
        reader = reader.option("startingOffsets", "earliest")
    else:
        offsets = ", ".join(f'"{p}": {int(replay_from_ms)}' for p in range(partitions))
        reader = reader.option("startingOffsetsByTimestamp", f'{{"{topic}": {{{offsets}}}}}')
    return decode(reader.load())


def files(spark: SparkSession, folder: str, per_trigger: int = 1, replay_from: int | None = None) -> DataFrame:
    """The stream from Parquet files of messages; replay_from leaves out what happened before."""
    rows = spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", per_trigger).parquet(folder).withColumn("api_time", F.timestamp_seconds("api_ts"))
    return rows if replay_from is None else rows.where(F.col("api_ts") >= replay_from)


def state_vectors(payloads: DataFrame, poll_ts: Column) -> DataFrame:
    """Polls of positional arrays (columns time and states, an array of arrays of text) to envelope rows."""
    rows = payloads.select(poll_ts.cast("long").alias("poll_ts"), F.col("time").cast("long").alias("api_ts"), F.explode("states").alias("s"))
    kinds = {f.name: f.dataType for f in ENVELOPE}
    slot = lambda n: F.get(F.col("s"), F.lit(SLOTS[n]))
    fields = [F.nullif(F.trim(slot(n)), F.lit("")).alias(n) if n == "callsign" else slot(n).try_cast(kinds[n]).alias(n) for n in SLOTS]
    out = rows.select("poll_ts", "api_ts", *fields)
    return out.where(F.col("icao24").isNotNull()).select(*ENVELOPE.names)


def observation(raw: DataFrame, station: Column, properties: str = "properties") -> DataFrame:
    """Observation records (JSON text) to rows in fixed units, with the derived category."""
    p = F.from_json(F.col(properties), OBSERVATION)
    x = raw.select(station.alias("station"), p.alias("p"), F.col(properties).alias("raw")).where(F.col("p.timestamp").isNotNull())
    units = {"temp_c": ("temperature", "degC"), "wind_speed_kmh": ("windSpeed", "kmh"), "wind_gust_kmh": ("windGust", "kmh"), "wind_dir_deg": ("windDirection", "deg"), "visibility_m": ("visibility", "m"), "precip_last_hr_mm": ("precipitationLastHour", "mm")}
    rows = x.select(
        "station", F.try_to_timestamp("p.timestamp").cast("timestamp_ntz").alias("obs_ts"), *[weather.convert(F.col(f"p.{a}"), u).alias(n) for n, (a, u) in units.items()],
        weather.ceiling_layers(F.col("p.cloudLayers")).alias("ceiling_ft"), F.col("p.textDescription").alias("text_desc"), "raw",
    )
    return rows.withColumn("flight_category", weather.category_metric(F.col("ceiling_ft"), F.col("visibility_m")))


def changes_only(polls: DataFrame, keys: list[str], signature: list[str], order: list[str]) -> DataFrame:
    """Polls whose signature differs from the key's poll before; the first poll of a key counts."""
    line = Window.partitionBy(*keys).orderBy(*order)
    same = F.struct(*signature).eqNullSafe(F.lag(F.struct(*signature)).over(line))
    return polls.withColumn("__same", same & (F.row_number().over(line) > 1)).where(~F.col("__same")).drop("__same")


def tracks(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited messages, each with its place (from 1 on) in its aircraft's order of time; unreadable lines are left out.

    Rows stay rows, so an aircraft may have any number of pings: its order is told by a sort that spills.
    """
    rows = spark.read.schema(ENVELOPE).option("mode", "DROPMALFORMED").json(path).where(F.col("icao24").isNotNull())
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("icao24").orderBy("api_ts", "poll_ts")))


def report_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """Station reports as text, every column a string."""
    return spark.read.option("header", True).csv(pattern)


def months(first: str, last: str) -> list[str]:
    """`yyyy-MM` from first to last."""
    return [str(p) for p in pd.period_range(first, last, freq="M")]


def decades(first: int, last: int, size: int = 10) -> list[tuple[int, int]]:
    """Chunks of years, the last one cut."""
    return [(y, min(y + size - 1, last)) for y in range(first, last + 1, size)]


def zipped_csv(spark: SparkSession, folder: str, columns: list[str], loaded: DataFrame | None = None) -> DataFrame:
    """Rows of the month archives under folder/ym=*/, all text, with _ingest_ym; months in loaded are left out.

    Each archive must hold exactly one CSV; columns that a file lacks are null. Archives are read
    where their task runs, never on the driver, and a file streams in chunks.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(folder)
    found = found.withColumn("_ingest_ym", F.regexp_extract("path", r"/ym=([^/]+)/", 1)).where(F.col("_ingest_ym") != "")
    if loaded is not None:
        found = found.join(loaded.select("_ingest_ym").distinct(), "_ingest_ym", "left_anti")

    def unzip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for ym, content in zip(f["_ingest_ym"], f["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = [n for n in z.namelist() if n.lower().endswith(".csv")]
                    if len(names) != 1:
                        raise ValueError(f"{ym}: expected one CSV, found {len(names)}")
                    with z.open(names[0]) as handle:
                        for part in pd.read_csv(handle, dtype=str, keep_default_na=False, chunksize=50_000):
                            whole = part.reindex(columns=columns).astype(object)
                            yield whole.where(whole.notna(), None).assign(_ingest_ym=str(ym))

    ddl = ", ".join(f"`{c}` string" for c in [*columns, "_ingest_ym"])
    return found.select("_ingest_ym", "content").mapInPandas(unzip, ddl)


def bronze_ingest(spark: SparkSession, landing: str, bronze: str, columns: list[str]) -> DataFrame:
    """Loads the months that have landed and are not in bronze yet; gives their months and rows.

    Idempotent: a month is a partition that is written whole, and a second run finds nothing to do.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(bronze)
    there = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    loaded = spark.read.parquet(bronze).select("_ingest_ym").distinct() if there else spark.createDataFrame([], "_ingest_ym string")
    done = [r[0] for r in loaded.collect()]  # a row per month
    write_partitions(zipped_csv(spark, landing, columns, spark.createDataFrame([(m,) for m in done], "_ingest_ym string")), bronze, "_ingest_ym")
    return spark.read.parquet(bronze).where(~F.col("_ingest_ym").isin(done)).groupBy("_ingest_ym").agg(F.count(F.lit(1)).alias("rows"))
