"""Functions at their boundaries, parameters, sources and sinks."""

import random
import zipfile

import pytest
from pyspark.sql import functions as F

from apronflow import session
from apronflow.functions import geo, weather
from apronflow.operators import late, quality, upsert
from apronflow.plans import lake, serving
from apronflow.plans.sinks import publish_history
from apronflow.sources import envelope, exports
from apronflow.streaming import pipelines, retractions, sinks
from apronflow.streaming.tables import KeyedTable

MILE = 1609.344
BOUNDARIES = [
    (499, 10, "LIFR"), (10_000, 0.9, "LIFR"), (500, 10, "IFR"), (999, 10, "IFR"), (10_000, 1, "IFR"), (10_000, 2.9, "IFR"), (1000, 10, "MVFR"), (3000, 10, "MVFR"), (10_000, 3, "MVFR"), (10_000, 5, "MVFR"),
    (3001, 5.1, "VFR"), (None, 10, "VFR"), (400, 10, "LIFR"), (5000, 0.5, "LIFR"), (None, None, None), (2000, None, "MVFR"),
]


def test_category_boundaries(spark):
    df = spark.createDataFrame([(None if c is None else float(c), None if v is None else float(v), w) for c, v, w in BOUNDARIES], "c double, v double, want string")
    for got in df.select("want", weather.category(F.col("c"), F.col("v")).alias("a"), weather.category_metric(F.col("c"), F.col("v") * MILE).alias("b")).collect():
        assert got.a == got.want == got.b


def test_angles_and_distances(spark):
    got = spark.range(1).select(
        geo.track_delta(F.lit(350.0), F.lit(10.0)).alias("a"), geo.track_delta(F.lit(10.0), F.lit(350.0)).alias("b"), geo.track_delta(F.lit(0.0), F.lit(180.0)).alias("c"),
        geo.haversine_km(F.lit(40.6413), F.lit(-73.7781), F.lit(40.7769), F.lit(-73.8740)).alias("d"), geo.nearest_airport(F.lit(40.7), F.lit(-74.17)).alias("n"), geo.nearest_airport(F.lit(None).cast("double"), F.lit(1.0)).alias("x"),
    ).first()
    assert (got.a, got.b, got.c) == (20, -20, 180) and got.d == pytest.approx(17.1, abs=0.2) and got.n.airport == "KEWR" and got.x is None


def test_dead_reckoning_stops_after_its_limit(spark):
    go = lambda v, s: geo.dead_reckon(F.lit(40.0), F.lit(-73.0), F.lit(0.0), F.lit(v).cast("double"), F.lit(s))[0]
    got = spark.range(1).select(go(100.0, 45).alias("a"), go(100.0, 900).alias("b"), go(None, 30).alias("c"), go(100.0, -5).alias("d")).first()
    assert got.a == got.b == pytest.approx(40.0405, abs=1e-3) and got.c == got.d == 40.0


@pytest.mark.parametrize("call", [
    lambda s: serving.arrivals_15m(s, "x", hours=0), lambda s: serving.arrivals_15m(s, "x", hours=169), lambda s: serving.events_feed(s, "x", limit=201), lambda s: serving.events_feed(s, "x", event_type="theft"),
    lambda s: serving.wind_scatter(s, "x", days=91), lambda s: serving.airports(["KBOS"]), lambda s: lake.staircase(None, 1986), lambda s: lake.staircase(None, 2001, 2000), lambda s: lake.worst_days(None, 51),
    lambda s: lake.worst_days(None, 5, "mood"), lambda s: lake.monthly(None, "FOG"), lambda s: lake.monthly(None, None, "BOS"), lambda s: serving.quality_series(s, "x", days=0),
])
def test_parameters_are_checked_before_anything_runs(spark, call):
    with pytest.raises(ValueError):
        call(spark)


def test_guarded_upsert(spark):
    ddl = "k string, v long, x string"
    held = spark.createDataFrame([("a", 5, "old"), ("b", 5, "old")], ddl)
    batch = spark.createDataFrame([("a", 5, "tie"), ("b", 6, "new"), ("c", 1, "new"), ("c", 0, "older"), (None, 9, "no")], ddl)
    once = upsert.newest_wins(held, batch, ["k"], "v")
    want = [("a", 5, "old"), ("b", 6, "new"), ("c", 1, "new")]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, upsert.newest_wins(once, batch, ["k"], "v").collect()))


def test_partial_upsert_writes_nulls(spark):
    ddl = "k string, d int, x string"
    held, batch = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], ddl), spark.createDataFrame([("a", None, "y"), ("c", 3, "z")], ddl)
    assert sorted(map(tuple, upsert.overwrite(held, batch, ["k"], ["d"]).collect()), key=str) == [("a", None, "x"), ("b", 2, "x"), ("c", 3, "z")]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id int, kind string")
    assert [tuple(r) for r in quality.repeated_keys(df, ["id"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.outside(df, "kind", ["a"]).collect()] == [("b", 1)]
    assert {r.check: r.n for r in quality.failing(df, {"known": F.col("kind").isNotNull(), "small": F.col("id") < 5}).collect()} == {"known": 1, "small": 0}
    assert quality.freshness(df.limit(0).withColumn("t", F.current_timestamp()), "t", F.current_timestamp(), 1, 2).first().level == "error"


def test_decode_keeps_bad_messages_apart(spark):
    raw = spark.createDataFrame([('{"icao24": "a", "api_ts": 5, "lat": 1.5}',), ("not json",), ("[1]",), ('{"lat": 2}',), (None,)], "value string")
    assert envelope.decode(raw).where("icao24 = 'a'").first().lat == 1.5
    assert envelope.undecodable(raw).count() == 4


def test_state_vectors(spark):
    vector = ["abc", "  ", "US", None, None, "-73.5", "40.5", "NaN?", "true", "88.5", None, "1.0", None, None, None, None, None, "3"]
    df = spark.createDataFrame([(7, [vector, vector[:12], [None] * 18])], "time long, states array<array<string>>")
    rows = envelope.state_vectors(df, F.lit(9)).collect()
    assert len(rows) == 2 and rows[0].callsign is None and rows[0].lat == 40.5 and rows[0].on_ground and rows[0].baro_alt_m is None and {r.category for r in rows} == {3, None}


def test_changes_only(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, None), ("a", 4, None), ("a", 5, "x"), ("b", 1, None)], "k string, t int, s string")
    assert sorted(tuple(r)[:2] for r in envelope.changes_only(df, ["k"], ["s"], ["t"]).collect()) == [("a", 1), ("a", 3), ("a", 5), ("b", 1)]


def test_month_archives(spark, tmp_path):
    for ym, text in (("2001-01", "A,B\n1,\n2,x\n"), ("2001-02", "B,C\nq,9\n"), ("2001-03", "A\n5\n")):
        (tmp_path / f"ym={ym}").mkdir()
        with zipfile.ZipFile(tmp_path / f"ym={ym}" / "m.zip", "w") as z:
            z.writestr("data.csv", text)
            z.writestr("readme.html", "x")
    loaded = spark.createDataFrame([("2001-03",)], "_ingest_ym string")
    got = envelope.zipped_csv(spark, str(tmp_path), ["A", "B"], loaded)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("1", "", "2001-01"), ("2", "x", "2001-01"), (None, "q", "2001-02")], key=str)
    out = str(tmp_path / "bronze")
    upsert.write_partitions(got, out, "_ingest_ym")
    upsert.write_partitions(got.where("_ingest_ym = '2001-01'"), out, "_ingest_ym")
    assert spark.read.parquet(out).count() == 3
    assert envelope.months("1999-11", "2000-02") == ["1999-11", "1999-12", "2000-01", "2000-02"] and envelope.decades(1987, 2003) == [(1987, 1996), (1997, 2003)]


def test_bronze_to_silver_end_to_end(spark, tmp_path):
    """Archives land, are loaded once, a new month is added, a reload of a month replaces it, and silver keeps the latest version."""
    names = ["FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest", "CRSDepTime", "ArrDelay", "ArrDel15", "Cancelled", "CancellationCode", "WeatherDelay", "NASDelay"]
    leg = lambda number, delay, dest="JFK": f"2001-02-03,AA,{number},BOS,{dest},0900,{delay},0.00,0.00,,,"
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")

    def land(ym, *legs):
        (landing / f"ym={ym}").mkdir(parents=True, exist_ok=True)
        with zipfile.ZipFile(landing / f"ym={ym}" / "m.zip", "w") as z:
            z.writestr("data.csv", "\n".join([",".join(names), *legs]) + "\n")

    run = lambda: sorted(map(tuple, envelope.bronze_ingest(spark, str(landing), bronze, names).collect()))
    land("2001-02", leg(1, 5), leg(2, 7))
    assert run() == [("2001-02", 2)] and run() == []
    land("2001-03", leg(1, 9), leg(3, ""))
    assert run() == [("2001-03", 2)] and spark.read.parquet(bronze).count() == 4
    silver = lake.silver_ontime(spark.read.parquet(bronze))
    assert sorted((r.flight_number, r.arr_delay_min) for r in silver.collect()) == [("1", 9.0), ("2", 7.0), ("3", None)]
    out = str(tmp_path / "silver")
    upsert.write_clustered(silver, out, "dest", "year")
    assert spark.read.parquet(out).count() == 3


def test_a_failing_slice_costs_itself(spark, tmp_path):
    def fails(s, f):
        raise ValueError("no")

    told = publish_history(spark, "", str(tmp_path / "h"), {"good": lambda s, f: s.range(3), "bad": fails})
    assert told["good"] == "written" and told["bad"].startswith("failed") and spark.read.json(str(tmp_path / "h" / "good")).count() == 3


def test_consumer_counts_what_it_cannot_write(spark, tmp_path):
    good = '{"station": "KJFK", "obs_ts": "2001-01-01T00:00:00", "temp_c": %s}'
    for i, lines in enumerate([[good % 1, "not json", "[1]", '{"station": "KJFK"}', '"text"'], [good % 2, good.replace("KJFK", "KLGA") % "null"]]):
        (tmp_path / f"in{i}.txt").write_text("\n".join(lines) + "\n")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in*.txt"))
    held = sinks.obs_table(spark, str(tmp_path / "t"))
    for checkpoint in ("c", "d"):  # given again from the beginning, the table and the counts of a run are the same
        sinks.consume(stream, held, str(tmp_path / f"n{checkpoint}"), str(tmp_path / checkpoint)).awaitTermination()
        assert sorted((r.station, r.temp_c) for r in held.read().collect()) == [("KJFK", 2.0), ("KLGA", None)]
        assert {r.outcome: r.n for r in sinks.drops(spark, str(tmp_path / f"n{checkpoint}")).collect()} == {"written": 3, "undecodable": 1, "non_object": 2, "unwritable": 1}


def test_exports_come_back(spark, tmp_path):
    gold = spark.createDataFrame([("2001-09-11", "JFK", 12, 3.5, None), ("2001-09-12", "LGA", None, None, "IFR")], "flight_date string, airport string, cancelled int, avg_arr_delay_min double, worst_category string")
    seen, rows = exports.counted(gold, "gold", without_category=F.col("worst_category").isNull())
    exports.export_csv(seen, str(tmp_path / "gold"))
    assert rows.get == {"rows": 2, "without_category": 1}
    back = exports.read_gold_csv(spark, str(tmp_path / "gold"))
    assert dict(back.dtypes)["cancelled"] == "bigint" and sorted((str(r.flight_date), r.cancelled, r.avg_arr_delay_min, r.worst_category) for r in back.collect()) == [("2001-09-11", 12, 3.5, None), ("2001-09-12", None, None, "IFR")]
    told = exports.publish_json({"gold": gold, "bad": gold.select(F.raise_error(F.lit("no")).alias("x"))}, str(tmp_path / "json"))
    assert told["gold"] == "written" and told["bad"].startswith("failed") and spark.read.json(str(tmp_path / "json" / "gold")).count() == 2


def test_reported_arrivals(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"icao24":" AB ","airport":"KJFK","lastSeen":100,"callsign":" "}\n{"icao24":null,"lastSeen":1}\n{"icao24":"c","firstSeen":1}\n')
    got = exports.read_arrivals(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].icao24 == "ab" and got[0].callsign is None and got[0].first_seen == got[0].est_arrival_ts


def test_time_frames():
    assert serving.frame_hours("7d") == 168 and serving.frame_hours(None) == 24
    with pytest.raises(ValueError):
        serving.frame_hours("2y")


def test_three_streams_side_by_side(spark, tmp_path):
    rows = [(3, 600 + 60 * t, "a", None, -73.7781, 40.6413 + 0.01 * max(0, 5 - t), 600.0 - 100 * t if t < 6 else None, t >= 6, 70.0, 200.0, -4.0, None) for t in range(8)]
    spark.createDataFrame(rows + rows[:2], envelope.ENVELOPE).coalesce(1).write.parquet(str(tmp_path / "in"))
    for q in pipelines.start_all(envelope.files(spark, str(tmp_path / "in")), str(tmp_path / "out"), (None, None, None)):
        q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "archive")).count() == 8
    assert [r.on_ground for r in pipelines.live_table(spark, str(tmp_path / "out" / "live")).read().collect()] == [True]
    assert [r.event_type for r in pipelines.events_table(spark, str(tmp_path / "out" / "events")).read().collect()] == ["arrival"]


def test_a_broken_write_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    ddl = "k string, v long"
    held = KeyedTable(spark, str(tmp_path / "t"), ddl, ["k"], lambda held, batch: upsert.newest_wins(held, batch, ["k"], "v"), buckets=4)
    held.upsert(spark.createDataFrame([(f"k{i}", 1) for i in range(20)], ddl))

    def breaks(manifest):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(held, "_publish", breaks)
        with pytest.raises(OSError, match="lost"):
            held.upsert(spark.createDataFrame([("k1", 9), ("new", 9)], ddl))
    assert {r.k: r.v for r in held.read().collect()} == {f"k{i}": 1 for i in range(20)}
    held.upsert(spark.createDataFrame([("k2", 5)], ddl))
    assert {r.k: r.v for r in held.read().collect()} == {f"k{i}": 5 if i == 2 else 1 for i in range(20)}


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(600).selectExpr("id", "id % 3 AS year", "concat('d', id % 7) AS dest")
    df.repartition(12).write.partitionBy("year").parquet(path)
    told = upsert.compact(spark, path, "dest", "year")
    assert told["rows"] == 600 and told["files_after"] < told["files_before"] == 36
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "year", "dest").collect())) == sorted(map(tuple, df.collect()))


def test_streams_run_until_one_ends(spark, tmp_path):
    reports(spark, tmp_path / "in", ("a", 100, 40.0))
    pipelines.run(envelope.files(spark, str(tmp_path / "in")), str(tmp_path / "out"), (None, "10 seconds", "10 seconds"))
    assert not spark.streams.active and spark.read.parquet(str(tmp_path / "out" / "archive")).count() == 1


def test_checkpoints_need_a_shared_folder_off_local_masters(monkeypatch):
    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    class Session:
        sparkContext = Context()  # noqa: N815 - the interface's name
        conf = type("C", (), {"get": lambda self, k, d: d})()

    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_dir(Session())


def test_tracks(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"icao24":"a","api_ts":5,"poll_ts":9}\nrubbish\n\n{"icao24":"a","api_ts":3,"poll_ts":9}\n{"api_ts":1}\n')
    assert sorted((r.icao24, r.place, r.api_ts) for r in envelope.tracks(spark, str(tmp_path)).collect()) == [("a", 1, 3), ("a", 2, 5)]


def reports(spark, where, *rows):
    spark.createDataFrame([(3, t, k, None, -73.0, lat, None, False, None, None, None, None) for k, t, lat in rows], envelope.ENVELOPE).coalesce(1).write.parquet(str(where))


def test_archive_has_a_file_per_hour_of_a_batch(spark, tmp_path):
    """However many tasks hold the state, which lies in RocksDB; copies are dropped, also those of a later batch."""
    rows = [(f"a{i}", 3600 * h + 60 * (i % 60), 40.0) for h in (1, 2, 3) for i in range(80)]
    reports(spark, tmp_path / "in" / "0", *rows, *rows[:40])
    archive = tmp_path / "archive"

    def run():
        pipelines.archive(envelope.files(spark, str(tmp_path / "in" / "*")), str(archive), str(tmp_path / "offsets")).awaitTermination()
        back = spark.read.parquet(str(archive)).collect()
        assert all((str(r.dt), int(r.hr), r.api_time.minute) == ("1970-01-01", r.api_ts // 3600, r.api_ts // 60 % 60) for r in back)
        return sorted((r.icao24, r.api_ts, r.lat) for r in back)

    assert run() == sorted(rows)
    assert [len(list(d.glob("*.parquet"))) for d in sorted(archive.glob("dt=*/hr=*"))] == [1, 1, 1]
    assert "RocksDBStateStoreProvider" in (tmp_path / "offsets" / "offsets" / "0").read_text()
    new = ("b", 4 * 3600, 41.0)
    reports(spark, tmp_path / "in" / "1", max(rows, key=lambda r: r[1]), new)
    assert run() == sorted([*rows, new])


def test_live_stream_from_fresh_checkpoints(spark, tmp_path):
    """The same rows again change nothing; new rows under a second checkpoint, whose batches count from 0 again, are kept."""
    held = pipelines.live_table(spark, str(tmp_path / "live"))

    def run(folder, checkpoint):
        pipelines.latest_positions(envelope.files(spark, str(tmp_path / folder)), held, str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.icao24, r.lat) for r in held.read().collect())

    for i, row in enumerate([("a", 1, 40.0), ("a", 2, 41.0), ("b", 1, 40.0)]):
        reports(spark, tmp_path / f"first{i}", row)
    want = [("a", 41.0), ("b", 40.0)]
    assert run("first*", "one") == want == run("first*", "two")
    reports(spark, tmp_path / "second0", ("b", 5, 45.0))
    reports(spark, tmp_path / "second1", ("c", 1, 50.0), ("a", 1, 1.0))
    assert run("second*", "three") == [("a", 41.0), ("b", 45.0), ("c", 50.0)]


def test_keyed_table_rewrites_touched_buckets_only(spark, tmp_path):
    ddl = "k string, v long, __held string"
    merge = lambda held, batch: upsert.overwrite(held, batch, ["k"])
    held = KeyedTable(spark, str(tmp_path / "t"), ddl, ["k"], merge, buckets=16)
    held.upsert(spark.createDataFrame([], ddl))
    assert held.read().count() == 0 and held.versions() == []
    held.upsert(spark.createDataFrame([(f"k{i}", 0, "x") for i in range(200)] + [(None, 1, "x")], ddl))
    before = held.manifest()["held"]
    again = KeyedTable(spark, str(tmp_path / "t"), ddl, ["k"], merge, buckets=99)  # the first upsert has fixed the number of buckets
    again.upsert(spark.createDataFrame([("k7", 5, None)], ddl), 0)
    again.upsert(spark.createDataFrame([("k7", 5, None)], ddl), 0)
    after = again.manifest()["held"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == 16 and again.versions() == [2, 3]
    assert {r.k: r.v for r in held.read().collect()} == {f"k{i}": 5 if i == 7 else 0 for i in range(200)}
    assert held.read(2).count() == 200


def test_retraction_stream_gives_the_changelog_of_the_batch(spark, tmp_path):
    """Micro-batches that cut a second's arrivals apart, copies, corrections, drops: row by row what late.changes gives."""
    ddl = "icao24 string, record string, event_s long, arrival_s long"
    parts = [
        [("a", "1", 10, 20), ("a", "2", 20, 30)],
        [("a", "3", 30, 5000), ("a", "1", 10, 5001), ("b", "9", 9000, 9000), ("a", "6", 36, 9000)],
        [("a", "5", 35, 9000), ("a", "7", 37, 8999), ("c", "1", 100, 9100)],
        [("a", "4", 40, 40_000), ("a", "4", 40, 40_001), ("a", "8", 41, 40_000), ("a", "2", 20, 40_002)],
        [("z", "1", 500_000, 500_000)],
    ]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))
    out = retractions.deltas(stream).writeStream.outputMode("update").format("memory").queryName("deltas").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    whole = late.changes(spark.createDataFrame([r for p in parts for r in p], ddl), ["record"], ["icao24"])
    key = lambda df: sorted((r.icao24, r.period_s, r.version, r.at_s, r.sign, r.n) for r in df.where("sign <> 0 AND icao24 <> 'z'").collect())
    assert key(spark.table("deltas")) == key(whole) and len(key(whole)) == 10
    lost = lambda df: {(r.icao24, r.period_s): r.n for r in df.where("sign = 0").groupBy("icao24", "period_s").agg(F.sum("n").alias("n")).collect()}
    assert lost(spark.table("deltas")) == lost(whole) == {("a", 0): 2}


def test_retraction_stream_on_random_arrivals(spark, tmp_path):
    """Records of three aircraft in order of arrival, copies among them, cut into batches anywhere: the changelog is the batch's."""
    r = random.Random(11)
    ddl = "icao24 string, record string, event_s long, arrival_s long"
    raw = []
    for i in range(400):
        event = r.randrange(1, 4 * 3600)
        late_s = r.choice([5, 60, 3000, 9000, 9000, 20_000, 30_000]) + r.randrange(0, 40)
        raw.append((r.choice("abc"), str(i), event, event + late_s))
    raw += [(k, n, e, a + r.choice([0, 0, 3, 900])) for k, n, e, a in r.sample(raw, 120)]
    raw.sort(key=lambda x: (x[3], x[1]))
    cuts = sorted(r.sample(range(1, len(raw)), 6))
    parts = [raw[i:j] for i, j in zip([0, *cuts], [*cuts, len(raw)], strict=True)] + [[("z", "end", 900_000, 900_000)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, ddl).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))
    out = retractions.deltas(stream).writeStream.outputMode("update").format("memory").queryName("random_deltas").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    whole = late.changes(spark.createDataFrame(raw, ddl), ["record", "event_s"], ["icao24"])
    key = lambda df: sorted((x.icao24, x.period_s, x.version, x.at_s, x.sign, x.n) for x in df.where("sign <> 0 AND icao24 <> 'z'").collect())
    assert key(spark.table("random_deltas")) == key(whole) and len(key(whole)) > 100
    lost = lambda df: {(x.icao24, x.period_s): x.n for x in df.where("sign = 0").groupBy("icao24", "period_s").agg(F.sum("n").alias("n")).collect()}
    assert lost(spark.table("random_deltas")) == lost(whole) != {}
