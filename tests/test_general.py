"""The general problems on small tables: nulls, ties, repeated rows, empty tables, extra columns, and brute force."""

import random
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from apronflow.operators import asof, dedupe, grid, intervals, keys, late, spikes, trips
from apronflow.operators.sessions import sessionize
from apronflow.plans.readings import SPIKE_RULES


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# 1 grid


def test_imputation_restores_a_cycle():
    t = np.arange(24 * 20)
    whole = 10 + 3 * np.sin(2 * np.pi * t / 24)
    holed = whole.copy()
    holed[[50, 51, 52, 120, 200, 201, 300]] = np.nan
    assert np.abs(grid.impute(holed) - whole).max() < 0.3
    assert np.isnan(grid.impute(np.full(5, np.nan))).all()
    assert (grid.impute(np.array([np.nan, 4.0, np.nan])) == 4).all()


def plain_fill(series, window, rank):
    """Round after round by a plain singular value decomposition, until the moves are so small that even their long sum is."""
    hole = np.isnan(series)
    at = np.arange(len(series))
    x = np.interp(at, at[~hole], series[~hole])
    mean, spread = x[~hole].mean(), x[~hole].std()
    x = (x - mean) / spread
    while True:
        track = np.lib.stride_tricks.sliding_window_view(x, window)
        u, s, v = np.linalg.svd(track, full_matrices=False)
        weight = 1 - np.square(s[rank:]).mean() / np.square(s[:rank])
        low = (u[:, :rank] * s[:rank] * weight) @ v[:rank]
        rebuilt = np.array([np.diagonal(low[:, ::-1], window - 1 - i).mean() for i in range(len(x))])
        moved = np.abs(rebuilt - x)[hole].max()
        x[hole] = rebuilt[hole]
        if moved < 1e-9:
            return x * spread + mean, spread


@pytest.mark.parametrize(("window", "rank"), [(24, 2), (24, 6), (12, 3)])
def test_imputation_goes_on_until_convergence(window, rank, monkeypatch):
    rng = np.random.default_rng(4)
    series = np.cumsum(rng.normal(0, 1, 120)) + rng.normal(0, 2, 120)
    series[rng.random(120) < 0.2] = np.nan
    series[40:52] = np.nan
    want, spread = plain_fill(series, window, rank)
    assert np.abs(grid.impute(series, window, rank) - want).max() < 2e-3 * spread
    monkeypatch.setattr(grid, "HOLD", 5)  # held vectors come to rest too, on another fill
    held = grid.impute(series, window, rank)
    known = np.isfinite(series)
    assert np.isfinite(held).all() and np.allclose(held[known], series[known])


@pytest.mark.parametrize("field", ["visibility_m", "ceiling_ft"])
@pytest.mark.parametrize("gap", [1, 6, 24])
def test_imputation_is_nearer_than_a_line(field, gap):
    """Held-out hours of all stations, hidden in runs on top of the holes that are there."""
    folder = "/root/testdata/sf0.1/weather_obs.parquet"
    if not Path(folder).exists():
        pytest.skip("needs the test tables")
    value = {"visibility_m": "CASE WHEN visibility_m BETWEEN 0 AND 100000 AND NOT isnan(visibility_m) THEN visibility_m END", "ceiling_ft": "coalesce(CASE WHEN ceiling_ft BETWEEN 0 AND 25000 AND NOT isnan(ceiling_ft) THEN ceiling_ft END, 25000)"}[field]
    told = duckdb.sql(f"SELECT upper(regexp_replace(station, '\\s', '', 'g')) AS s, epoch(obs_ts)::BIGINT // 3600 AS h, avg({value}) AS v FROM '{folder}' WHERE station IS NOT NULL AND obs_ts IS NOT NULL GROUP BY 1, 2 HAVING v IS NOT NULL").fetchnumpy()
    rng, ours, line = np.random.default_rng(gap), 0.0, 0.0
    for s in np.unique(told["s"]):
        h, v = told["h"][told["s"] == s], told["v"][told["s"] == s]
        series = np.full(int(h.max() - h.min()) + 1, np.nan)
        series[h - h.min()] = np.log1p(v)
        hidden = np.zeros(len(series), bool)
        for begin in rng.integers(1, len(series) - gap - 1, max(1, len(series) // (12 * gap))):
            hidden[begin : begin + gap] = True
        seen = np.isfinite(series) & ~hidden
        hidden &= np.isfinite(series)
        at = np.arange(len(series))
        ours += np.square(grid.impute(np.where(seen, series, np.nan)) - series)[hidden].sum()
        line += np.square(np.interp(at, at[seen], series[seen]) - series)[hidden].sum()
    assert ours < line


def test_grid(spark):
    raw = [("KA", 0, 5.0, None), ("KA", 60, 7.0, 100.0), ("KA", 60, 7.0, 100.0), ("KA", 3 * 3600, -1.0, None), ("KA", 5 * 3600, float("nan"), None), (None, 0, 1.0, 1.0), ("KA", None, 1.0, 1.0), ("KB", 7200, None, None)]
    df = spark.createDataFrame(raw, "source string, t long, v double, c double").withColumn("slot", F.lit("clash"))
    fields = [grid.Field("v", F.col("v").between(0, 100) & ~F.isnan("v")), grid.Field("c", F.col("c") > 0, present=F.lit(True), open_level=1000.0)]
    got = {(r["source"], r["slot_ts"]): r for r in grid.regular(df, F.col("source"), F.col("t"), fields).collect()}
    assert sorted(k for k in got) == [("KA", h * 3600) for h in range(6)] + [("KB", 7200)]
    assert got["KA", 0]["v"] == pytest.approx(19 / 3, abs=1e-3) and not got["KA", 0]["v_filled"]
    assert [got["KA", h * 3600]["v_filled"] for h in range(6)] == [False, True, True, True, True, True]
    assert [got["KA", h * 3600]["c_filled"] for h in range(6)] == [False, True, True, False, True, False]
    assert got["KA", 3 * 3600]["c"] is None and got["KB", 7200]["v_filled"] and got["KB", 7200]["v"] is None
    assert grid.regular(df.limit(0), F.col("source"), F.col("t"), fields).count() == 0


def test_grid_blocks_meet(spark):
    df = spark.range(0, 400).select(F.lit("S").alias("source"), (F.col("id") * 7200).alias("t"), (F.col("id") % 12).cast("double").alias("v"))
    got = grid.regular(df, F.col("source"), F.col("t"), [grid.Field("v", F.col("v") >= 0)], block=100, halo=50)
    assert rows(got, "slot_ts") == [(h * 3600,) for h in range(799)]


# 2 intervals


def brute_periods(raw):
    by = {}
    for e, s, t in raw:
        if None not in (e, s, t) and t > s:
            by.setdefault(e, []).append((s, t))
    out = []
    for e, own in by.items():
        merged = []
        for s, t in sorted(own):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], t)
            else:
                merged.append([s, t])
        out += [(e, "period", s, t) for s, t in merged]
        out += [(e, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:], strict=False) if b[0] - a[1] <= 60]
    return sorted(out)


def test_intervals_equal_brute_force(spark):
    r = random.Random(3)
    raw = [(r.choice("ab"), s := r.randrange(3000), s + r.choice([0, -5, 1, 5, 30, 400])) for _ in range(300)]
    raw += [(None, 1, 2), ("a", None, 2), ("a", 1, None), ("c", 10, 20), ("c", 20, 30), ("c", 30, 31), ("c", 10, 20), ("d", -50, 5000)]
    df = spark.createDataFrame(raw, "entity string, s long, e long").withColumn("shard", F.lit("clash")).repartition(7)
    for shard in (10, 100, 10_000):
        got = intervals.periods_and_gaps(df, "entity", "s", "e", max_gap=60, shard_s=shard)
        assert rows(got, "entity", "kind", "start_s", "end_s") == brute_periods(raw)
    assert intervals.periods_and_gaps(df.limit(0), "entity", "s", "e").count() == 0


def test_merge_is_associative():
    r = np.random.default_rng(0)
    lists = []
    for _ in range(3):
        s = np.sort(r.integers(0, 200, 15))
        lists.append(intervals.merge((s, s + r.integers(1, 9, 15)), (np.zeros(0, int), np.zeros(0, int))))
    a, b, c = lists
    left, right = intervals.merge(intervals.merge(a, b), c), intervals.merge(a, intervals.merge(b, c))
    assert all((x == y).all() for x, y in zip(left, right, strict=True))


# 4 trips


def pings(name, start, n, lat, lon, ground, step=60, seed=0, jitter=0.0003):
    r = random.Random(seed)
    return [(name, start + i * step, lat + r.uniform(-jitter, jitter), lon + r.uniform(-jitter, jitter), ground) for i in range(n)]


def journey():
    out = pings("a", 0, 20, 40.0, -74.0, True)
    out += [("a", 1200 + i * 60, 40.0 + 0.05 * (i + 1), -74.0, False) for i in range(10)]
    out += pings("a", 1800, 30, 40.6, -74.0, True, seed=1)
    out[5] = ("a", out[5][1], 10.0, 10.0, True)  # wrong positions
    out[36] = ("a", out[36][1], 0.0, 0.0, True)
    out[3] = (*out[3][:4], False)  # a wrong flag
    return out


TRIPS = "icao24 string, ts long, lat double, lon double, on_ground boolean"


def test_trips(spark):
    raw = journey() + pings("b", 0, 12, 41.0, -73.0, False) + [("c", 5, None, None, True), ("d", 0, 40.0, -74.0, True), ("d", 700, 40.0, -74.0, True)]
    df = spark.createDataFrame(raw + raw[:9], TRIPS).withColumn("path_m", F.lit("clash")).repartition(5)
    want = [("a", "stop", 0, 1140), ("a", "stop", 1800, 3540), ("a", "trip", 1140, 1800), ("d", "stop", 0, 700)]
    for block in (86_400, 1000, 333):
        assert rows(trips.stops_and_trips(df, block_s=block), "icao24", "kind", "start_ts", "end_ts") == want
    way = [r.distance_m for r in trips.stops_and_trips(df).collect() if r.kind == "trip"][0]
    assert way == pytest.approx(66_700, rel=0.05)
    assert trips.stops_and_trips(df.limit(0)).count() == 0


def test_silence_ends_a_stay(spark):
    raw = pings("a", 0, 15, 40.0, -74.0, True) + pings("a", 30_000, 15, 40.0, -74.0, True) + pings("a", 30_840 + 21_600, 15, 40.0, -74.0, True)
    got = trips.stops_and_trips(spark.createDataFrame(raw, TRIPS))
    assert rows(got, "kind", "start_ts", "end_ts") == [("stop", 0, 840), ("stop", 30_000, 30_840 + 21_600 + 840)]


def test_four_readings_elsewhere_end_a_stay(spark):
    raw = pings("a", 0, 40, 40.0, -74.0, True)
    for i in (17, 18, 19):
        raw[i] = ("a", raw[i][1], 40.5, -74.0, True)
    assert trips.stops_and_trips(spark.createDataFrame(raw, TRIPS)).count() == 1
    raw[20] = ("a", raw[20][1], 40.5, -74.0, True)
    assert rows(trips.stops_and_trips(spark.createDataFrame(raw, TRIPS)), "kind") == [("stop",), ("stop",), ("trip",)]


# 5 spikes

MEASURED = "icao24 string, ts long, on_ground boolean, baro_alt_m double, velocity_ms double, vrate_ms double"


def cruise(name="a", n=400, seed=1):
    r = random.Random(seed)
    return [[name, i * 30, False, 5000 + r.gauss(0, 8), 200 + r.gauss(0, 1.5), r.gauss(0, 0.5)] for i in range(n)]


def test_flags(spark):
    raw = cruise()
    raw[50][3] += 900
    raw[90][4] -= 70
    raw[91][4] -= 75
    raw[150][5] = 250.0
    raw[160][3] = -9999.0
    raw[170][4] = float("inf")
    raw[10][3] = None
    raw[11][4] = float("nan")
    for i in range(200, 212):
        raw[i][5] = raw[200][5]
    for i in range(300, 307):
        raw[i][3] = raw[300][3]  # seven are too few
    raw += [[None, 1, False, 1.0, 1.0, 1.0], ["b", 0, False, 99_999.0, None, None], ["c", 0, None, None, None, None]]
    df = spark.createDataFrame([tuple(x) for x in raw + raw[40:60]], MEASURED).where("icao24 IS NOT NULL").withColumn("block", F.lit("clash")).repartition(4)
    want = [("a", 50 * 30, "baro_alt_m", "spike"), ("a", 90 * 30, "velocity_ms", "spike"), ("a", 91 * 30, "velocity_ms", "spike"), ("a", 150 * 30, "vrate_ms", "impossible"), ("a", 160 * 30, "baro_alt_m", "impossible"), ("a", 170 * 30, "velocity_ms", "impossible"), ("b", 0, "baro_alt_m", "impossible")]
    want += [("a", i * 30, "vrate_ms", "stuck") for i in range(200, 212)]
    for block in (86_400, 1500, 170):  # blocks smaller than the runs and neighbourhoods that reach over their edges
        assert rows(spikes.implausible(df, SPIKE_RULES, block), "icao24", "ts", "field", "reason") == sorted(want)
    assert spikes.implausible(df.limit(0), SPIKE_RULES).count() == 0


def test_a_long_chain_of_spikes_is_peeled_to_its_end(spark):
    raw = cruise("a") + cruise("b", seed=2)
    for k in range(9):  # every second reading, each larger than the one before, so a round finds only the last
        raw[100 + 2 * k][3] += 700 + 100 * k
    raw[400 + 50][3] += 900
    df = spark.createDataFrame([tuple(x) for x in raw], MEASURED)
    want = [("a", (100 + 2 * k) * 30, "baro_alt_m", "spike") for k in range(9)] + [("b", 50 * 30, "baro_alt_m", "spike")]
    for block in (86_400, 3300):  # one block, and an edge within the chain
        assert rows(spikes.implausible(df, SPIKE_RULES, block), "icao24", "ts", "field", "reason") == want


def test_ordinary_changes_are_no_spikes(spark):
    raw = [["a", i * 30, False, 3000.0 + r, 200.0 + r, 0.0 + r] for i, r in enumerate(np.random.default_rng(2).normal(0, 0.5, 60).tolist())]
    raw += [["a", 1800 + i * 30, False, 3000.0 - 360 * i, 200.0 - 10 * i, -12.0 + 0.1 * (i % 3)] for i in range(8)]
    raw += [["a", 2040 + i * 30, True, None, 14.0 + (i % 4), None] for i in range(30)]
    raw += [["a", 2940 + i * 30, False, 300.0 + 390 * i, 80.0 + 12 * i, 13.0 + 0.1 * (i % 3)] for i in range(10)]
    raw += [["a", 90_000, False, 9000.0, 250.0, 0.2], ["a", 90_030, False, 9003.0, 251.0, 0.1]]
    assert spikes.implausible(spark.createDataFrame([tuple(x) for x in raw], MEASURED), SPIKE_RULES).count() == 0


def test_a_pair_counts_its_silences_one_by_one(spark):
    raw = cruise()
    for x in raw[101:]:
        x[1] += 250  # 280 s after the pair's second reading comes the next one, over 300 s after its first
    raw[99][4] += 90
    raw[100][4] += 92
    raw[200][5] += 40
    for x in raw[201:]:
        x[1] += 300  # here the next reading comes after a silence
    df = spark.createDataFrame([tuple(x) for x in raw], MEASURED)
    assert rows(spikes.implausible(df, SPIKE_RULES), "ts", "field", "reason") == [(99 * 30, "velocity_ms", "spike"), (100 * 30, "velocity_ms", "spike")]


def test_steps_and_the_ends_of_stuck_values_are_no_spikes(spark):
    speeds = [132.5, 125.4, 119.5, 105.6, 96.4, 84.0, 15.2, 12.3, 15.5, 15.3, 15.0, 14.2, 12.8, 77.3, 94.9, 116.5, 130.6]
    at = [0, 32, 63, 90, 161, 194, 225, 262, 298, 332, 366, 402, 439, 483, 533, 580, 627]
    raw = [("a", t, 6 <= i <= 12, None, v, None) for i, (t, v) in enumerate(zip(at, speeds, strict=True))]
    raw += [("b", 40 * i, False, 4793.9, 116.9, None) for i in range(12)] + [("b", 520, False, 1081.4, 221.5, None), ("b", 561, False, 626.5, 219.8, None), ("b", 592, False, 269.0, 219.5, None)]
    got = spikes.implausible(spark.createDataFrame(raw, MEASURED), SPIKE_RULES)
    assert rows(got, "icao24", "ts", "field", "reason") == sorted(("b", 40 * i, f, "stuck") for i in range(12) for f in ("baro_alt_m", "velocity_ms"))


def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(0)
    e = rng.random((700, 4)) + 0.05
    seg = np.repeat([0, 1], [400, 300])
    got = spikes.posterior(seg, e)
    for lo, hi in ((0, 400), (400, 700)):
        a, b = np.zeros((hi - lo, 4)), np.ones((hi - lo, 4))
        a[0] = spikes.START * e[lo]
        for k in range(1, hi - lo):
            a[k] = (a[k - 1] @ spikes.MOVES) * e[lo + k]
            a[k] /= a[k].sum()
        for k in range(hi - lo - 2, -1, -1):
            b[k] = spikes.MOVES @ (e[lo + k + 1] * b[k + 1])
            b[k] /= b[k].sum()
        p = a * b
        assert np.abs(got[lo:hi] - p / p.sum(1, keepdims=True)).max() < 1e-9


# 6 late


def test_changelog(spark):
    raw = [("a", i, 100 + i, 150 + i) for i in range(5)] + [("a", 9, 200, 3900), ("a", 10, 201, 3901), ("a", 10, 201, 5000), ("a", 11, 202, 5000), ("a", 12, 203, 3600 + 21_601), ("b", 1, 10, 4000), (None, 1, 5, 6), ("a", 13, None, 5), ("a", 14, 10, None)]
    df = spark.createDataFrame(raw, "icao24 string, id long, event_s long, arrival_s long")
    records = df.where("event_s IS NOT NULL AND arrival_s IS NOT NULL")
    log = late.changes(records, ["id"], ["icao24"])
    assert rows(log.where("icao24 = 'a' AND sign = 0"), "version", "at_s", "n") == [(None, 25_200, 1)]
    assert rows(log.where("icao24 = 'a' AND sign <> 0"), "version", "at_s", "sign", "n") == [(0, 3900, 1, 6), (1, 3901, -1, 6), (1, 3901, 1, 7), (2, 5000, -1, 7), (2, 5000, 1, 8)]
    assert rows(late.outcomes(log, ["icao24"]).where("icao24 IS NOT NULL"), "icao24", "period_s", "outcome") == [("a", 0, "corrected"), ("a", 0, "dropped"), ("b", 0, "corrected")]
    assert {r.icao24: r.n for r in late.current(log, ["icao24"]).collect()} == {"a": 8, "b": 1, None: 1}
    assert late.changes(records.limit(0), ["id"], ["icao24"]).count() == 0


# 7 copies


def test_copies(spark):
    raw = [("a", 1, 5, "x"), ("a", 1, 3, "y"), ("a", 1, 9, None), ("a", 2, 4, "z"), (None, 1, 6, "n"), (None, 1, 7, "n"), ("a", None, 8, "n")]
    df = spark.createDataFrame(raw, "icao24 string, ts long, delivery_id long, __kept string")
    assert rows(dedupe.dropped_copies(df, ["icao24", "ts"], "delivery_id"), "delivery_id") == [(5,), (9,)]
    kept = dedupe.keep_one(df.withColumnRenamed("__kept", "o0"), ["icao24", "ts"], "delivery_id")
    assert rows(kept, "delivery_id", "o0") == [(3, "y"), (4, "z"), (6, "n"), (7, "n"), (8, "n")]
    assert rows(dedupe.keep_one(df.drop("__kept").union(df.drop("__kept")), ["icao24", "ts"], "delivery_id").where("icao24 IS NOT NULL AND ts IS NOT NULL"), "delivery_id") == [(3,), (4,)]
    assert dedupe.dropped_copies(df.limit(0), ["icao24", "ts"], "delivery_id").count() == 0


def test_copies_in_a_struct_order(spark):
    """min_by over (delivery time, tie-break): nulls first, then the time, then the tie-break."""
    raw = [("a", 1, 50, 7, "late"), ("a", 1, 20, 9, "tie"), ("a", 1, 20, 8, "first"), ("b", 1, None, 5, "null"), ("b", 1, -3, 1, "known"), ("c", 1, 4, 4, None)]
    df = spark.createDataFrame(raw, "icao24 string, ts long, poll_ts long, delivery_id long, text string")
    order = [(F.col("poll_ts"), 18), (F.col("delivery_id"), 20)]
    assert rows(dedupe.keep_one(df, ["icao24", "ts"], order), "icao24", "text") == [("a", "first"), ("b", "null"), ("c", None)]
    assert rows(dedupe.dropped_copies(df, ["icao24", "ts"], "delivery_id", order), "delivery_id") == [(1,), (7,), (9,)]
    best = dedupe.one_per_key(df, ["icao24"], dedupe.packed(*order))
    assert rows(best, "icao24", "ts", "poll_ts", "text") == [("a", 1, 50, "late"), ("b", 1, -3, "known"), ("c", 1, 4, None)]
    assert dedupe.one_per_key(df.limit(0), ["icao24"], dedupe.packed(*order)).count() == 0


def test_packed_orders_as_the_struct_does(spark):
    r = random.Random(4)
    raw = [(r.choice([None, -5, 0, 3, 10**11]), r.choice([None, -(2**63), 2**63 - 1, 0, 7])) for _ in range(60)]
    df = spark.createDataFrame(raw, "a long, b long")
    got = [tuple(x) for x in df.orderBy(dedupe.packed((F.col("a"), 18), (F.col("b"), 20))).collect()]
    assert got == [tuple(x) for x in df.orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()).collect()]


# joins in time and sessions


@pytest.mark.parametrize("strict", [False, True])
def test_backward_join_equals_brute_force(spark, strict):
    r = random.Random(8)
    left = [(i, r.choice("ab"), r.randrange(400_000)) for i in range(200)] + [(900, None, 5), (901, "a", None), (902, "z", 7)]
    right = sorted({(r.choice("ab"), r.randrange(400_000)) for _ in range(60)} | {(k, t) for _, k, t in left[:10]})
    ts = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    lf = spark.createDataFrame(left, "id long, k string, t long").withColumn("at", ts("t"))
    rf = spark.createDataFrame([(k, t, t * 2) for k, t in right], "k string, s long, v long").withColumn("seen", ts("s")).drop("s")
    got = {r.id: r.v for r in asof.backward(lf, rf, "k", "at", "seen", ["seen", "v"], strict).collect()}
    for i, k, t in left:
        near = [s for q, s in right if q == k and t is not None and (s < t if strict else s <= t)]
        assert got[i] == (2 * max(near) if near else None)


def test_sessions_equal_brute_force(spark):
    r = random.Random(2)
    raw = sorted({(r.choice("ab"), int(r.expovariate(1 / 60)) + 40 * i) for i in range(600)})
    got = {(x.k, x.t): x.session_s for x in sessionize(spark.createDataFrame(raw, "k string, t long"), "k", "t", 90, shard_s=500).collect()}
    for k in "ab":
        begin = before = None
        for t in [t for q, t in raw if q == k]:
            begin = t if before is None or t - before > 90 else begin
            before = t
            assert got[k, t] == begin


def test_rows_without_key_or_time_are_spread_and_kept(spark):
    rows_ = [(None, 5, 1), (None, 5, 1), ("a", None, 2), ("a", 7, 3)]
    df = spark.createDataFrame(rows_, "k string, t long, id long")
    got = sessionize(df, "k", "t", 90).collect()
    assert sorted((r.id, r.session_s) for r in got if r.session_s is not None) == [(3, 7)] and len(got) == 4
    ts = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    right = spark.createDataFrame([("a", 6, 9), (None, 1, 8)], "k string, s long, v long").withColumn("seen", ts("s")).drop("s")
    out = asof.backward(df.withColumn("at", ts("t")), right, "k", "at", "seen", ["v"]).collect()
    assert sorted((r.id, r.v) for r in out if r.v is not None) == [(3, 9)] and len(out) == 4


def test_units_of_time(spark):
    got = spark.createDataFrame([(1483232431,), (1483232431000,), (1483232431000000,), (None,)], "t long").select(keys.seconds("t").alias("s"))
    assert [r.s for r in got.collect()] == [1483232431] * 3 + [None]
