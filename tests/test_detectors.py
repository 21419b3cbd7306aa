"""Detectors on generated tracks: what they find, and that batching, state round trips and NaN change nothing."""

import json
import math

import pytest

from apronflow.streaming.detectors import Flight, Ping
from apronflow.streaming.events import MESSAGE, detect

LAT, LON = 40.6413, -73.7781


def ping(ts, lat, lon, alt, speed=80.0, track=220.0, climb=-4.0, ground=False, category=4, callsign="T1"):
    return dict(icao24="abc123", api_ts=ts, poll_ts=ts + 3, lat=lat, lon=lon, baro_alt_m=alt, velocity_ms=speed, track_deg=track, vrate_ms=climb, on_ground=ground, category=category, callsign=callsign)


def landing(ground=True, null_altitude=False):
    out = [ping(30 * i, LAT + 0.01 * (10 - i), LON, None if null_altitude else 900.0 - 80 * i) for i in range(10)]
    if ground:
        out += [ping(300 + 30 * i, LAT, LON, None, 10.0, climb=None, ground=True) for i in range(3)]
    return out


def racetrack(alt=2400.0, speed=120.0, category=4):
    out = []
    for i in range(17):
        angle = 2 * math.pi * i * 30 / 200
        out.append(ping(30 * i, LAT + 0.03 * math.sin(angle), LON + 0.03 * math.cos(angle), alt, speed, track=(math.degrees(-angle) % 360), climb=0.0, category=category))
    return out + [ping(510 + 30 * i, LAT, LON + 0.05 * i, alt, speed, track=90.0, climb=0.0, category=category) for i in range(6)]


def balked():
    down = [ping(30 * i, LAT + 0.01 * (8 - i), LON, 750.0 - 80 * i, climb=-4.0) for i in range(8)]
    return down + [ping(240 + 30 * i, LAT - 0.01 * i, LON, 190.0 + 110 * i, climb=6.0) for i in range(6)]


def run(messages, size=1, roundtrip=False, end=True):
    flight, out = Flight("abc123"), []
    pings = [p for m in messages if (p := Ping.of(m)) is not None]
    for i in range(0, len(pings), size):
        for p in sorted(pings[i : i + size], key=lambda p: p.ts):
            out += flight.feed(p)
        if roundtrip:
            flight = Flight.load(flight.dump())
    if end:
        out += flight.lost()
    return list({e["event_id"]: e for e in reversed(out)}.values())[::-1]


def kinds(events):
    return [(e["event_type"], e["airport"]) for e in events]


def test_landings():
    assert kinds(run(landing())) == [("arrival", "KJFK")]
    lost = run(landing(ground=False))
    assert kinds(lost) == [("arrival", "KJFK")] and json.loads(lost[0]["details"])["confirmation"] == "coverage_loss"
    assert run(landing(ground=False), end=False) == []
    assert run(landing(ground=False, null_altitude=True)) == []
    assert run([ping(30 * i, LAT, LON, None, ground=True) for i in range(12)]) == []
    assert run([ping(30 * i, LAT + 0.03 * i, LON, 9000.0, climb=0.0) for i in range(12)]) == []


def test_a_landing_is_told_once_in_twenty_minutes():
    flying = ping(380, LAT, LON, 100.0)
    assert kinds(run([*landing(), flying, ping(400, LAT, LON, None, ground=True)])) == [("arrival", "KJFK")]


def test_holding():
    held = run(racetrack())
    assert kinds(held) == [("holding", "KJFK")] and held[0]["duration_s"] >= 300
    assert run(racetrack(900.0, 55.0, 2)) == []
    assert run(racetrack(category=8)) == []


def test_go_around():
    assert kinds(run(balked())) == [("go_around", "KJFK")]
    wobble = landing()
    wobble[7]["vrate_ms"] = 3.5
    assert kinds(run(wobble)) == [("arrival", "KJFK")]


@pytest.mark.parametrize("track", [landing, racetrack, balked])
def test_batching_state_and_nan_change_nothing(track):
    one = run(track())
    assert run(track(), size=7) == one == run(track(), size=100) == run(track(), roundtrip=True)
    nan = [{k: float("nan") if v is None and k not in ("callsign", "category") else v for k, v in m.items()} for m in track()]
    assert run(nan) == one
    assert run([*track(), *track()][: len(track())]) == one


def test_a_silence_equals_the_loss_of_contact():
    later = ping(2000, LAT + 1, LON, 9000.0)
    assert kinds(run([*landing(ground=False), later], end=False)) == [("arrival", "KJFK")]


def test_state_is_bounded_and_strict_json():
    flight = Flight("abc123")
    for i in range(300):
        flight.feed(Ping.of(ping(30 * i, LAT, LON, 5000.0, climb=float("nan"))))
    assert len(flight.pings) == 20 and "NaN" not in flight.dump()


def test_batch_over_sessions(spark):
    tracks = [*landing(), *[m | {"api_ts": m["api_ts"] + 90_000} for m in balked()]]
    rows = [tuple(m[c] if c != "api_ts" else m["api_ts"] for c in ("icao24", *MESSAGE)) for m in tracks]
    ddl = "icao24 string, api_ts long, callsign string, lat double, lon double, baro_alt_m double, on_ground boolean, velocity_ms double, track_deg double, vrate_ms double, category int"
    df = spark.createDataFrame(rows + rows[:4], ddl).withColumnRenamed("api_ts", "ts")
    got = detect(df).collect()
    assert sorted((r.event_type, r.airport) for r in got) == [("arrival", "KJFK"), ("go_around", "KJFK")]
    assert {r.event_id for r in got} == {e["event_id"] for e in run(tracks)}
    assert detect(df.limit(0)).count() == 0
