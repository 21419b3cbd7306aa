"""Detected events: as a batch over sessions, and as a stream with keyed state."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from apronflow.operators.sessions import sessionize
from apronflow.streaming.detectors import APPROACH_M, FIELDS, HOLD_ALTITUDE, HOLD_SPEED, LOST_S, Flight, Ping

EVENTS_DDL = "event_id string, icao24 string, callsign string, event_type string, airport string, event_ts long, duration_s int, details string"
EVENTS = pa.schema([("event_id", pa.string()), ("icao24", pa.string()), ("callsign", pa.string()), ("event_type", pa.string()), ("airport", pa.string()), ("event_ts", pa.int64()), ("duration_s", pa.int32()), ("details", pa.string())])
#: Degrees of latitude and longitude that hold every rule's distance from an airport.
BOX_DEG = (0.12, 0.16)
MESSAGE = ("api_ts", "callsign", "lat", "lon", "baro_alt_m", "on_ground", "velocity_ms", "track_deg", "vrate_ms", "category")


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feeds each session's pings to a flight; only the current flight is in memory."""
    flight, key = None, None
    for b in batches:
        out: list[dict] = []
        for row in b.to_pylist():
            if (row["icao24"], row["session_s"]) != key:
                out += flight.lost() if flight else []
                key = (row["icao24"], row["session_s"])
                flight = Flight(row["icao24"])
            if (ping := Ping.of(row)) is not None:
                out += flight.feed(ping)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=EVENTS)
    if flight and (out := flight.lost()):
        yield pa.RecordBatch.from_pylist(out, schema=EVENTS)


def _possible(rows: DataFrame) -> DataFrame:
    """The sessions that may hold an event: some ping low or on the ground in a box about an airport, or enough in the holding band.

    A superset, told by a hash aggregation of columns alone, so that the pings of all others stay out of Python.
    """
    low = F.coalesce(F.col("on_ground"), F.lit(False)) | F.coalesce(F.col("baro_alt_m") < APPROACH_M, F.lit(False))
    near = F.lit(False)
    for _, lat, lon in FIELDS:
        near = near | ((F.abs(F.col("lat") - lat) <= BOX_DEG[0]) & (F.abs(F.col("lon") - lon) <= BOX_DEG[1]))
    band = F.col("baro_alt_m").between(*HOLD_ALTITUDE) & F.col("velocity_ms").between(*HOLD_SPEED)
    flags = rows.groupBy("icao24", "session_s").agg(F.max(near & low).alias("near"), F.count_if(band).alias("band"))
    return flags.where(F.col("near") | (F.col("band") >= 4)).select("icao24", "session_s")


def detect(readings: DataFrame) -> DataFrame:
    """Events of all flights, as the stream would find them over the same messages.

    readings: icao24, ts and the message's measurements. A silence of over LOST_S resets everything
    the detectors know, so sessions between silences are independent and go to different tasks; a
    session's pings stream through in order, those of sessions that cannot hold an event are left out
    before. Equal events (by event_id) are given once: the first told of them. Rows without a position
    are left out.
    """
    rows = readings.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).withColumn("api_ts", F.col("ts"))
    rows = sessionize(rows.select("icao24", "ts", *MESSAGE), "icao24", "ts", LOST_S)
    rows = rows.join(_possible(rows), ["icao24", "session_s"], "left_semi")
    laid = rows.select("icao24", "session_s", *MESSAGE).repartition("icao24", "session_s").sortWithinPartitions("icao24", "session_s", "api_ts")
    found = laid.mapInArrow(_walk, EVENTS_DDL)
    rest = [c for c in found.columns if c != "event_id"]
    return found.groupBy("event_id").agg(F.min(F.struct("event_ts", *[c for c in rest if c != "event_ts"])).alias("x")).select("event_id", *[f"x.{c}" for c in rest])


#: Typed state of an aircraft: its newest pings, when what was told of which airport, and the holding that goes on.
PINGS_DDL = "ts long, lat double, lon double, alt double, speed double, track double, climb double, ground boolean, category int, callsign string"
TOLD_KEY_DDL, TOLD_DDL = "kind string, airport string", "ts long"
HOLD_DDL = "start long, last long, turn double"


class Tracker(StatefulProcessor):
    """Feeds an aircraft's pings to its flight and keeps the flight's state between batches.

    One timer runs per aircraft, LOST_S behind its last ping on the query's clock; when it fires the
    flight is taken as lost and its state goes.
    """

    def __init__(self, clock: str) -> None:
        self.clock = clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pings, self.told, self.hold = handle.getListState("pings", PINGS_DDL), handle.getMapState("told", TOLD_KEY_DDL, TOLD_DDL), handle.getValueState("hold", HOLD_DDL)

    def _flight(self, icao24: str) -> Flight:
        flight = Flight(icao24)
        if self.pings.exists():
            flight.pings = [Ping(*p) for p in self.pings.get()]
        if self.told.exists():
            for (kind, airport), (ts,) in self.told.iterator():
                flight.told[kind][airport] = ts
        if self.hold.exists():
            flight.hold = dict(zip(("start", "last", "turn"), self.hold.get(), strict=True))
        return flight

    def _keep(self, flight: Flight) -> None:
        self.pings.put([tuple(p) for p in flight.pings])
        self.told.clear()
        for kind, airports in flight.told.items():
            for airport, ts in airports.items():
                self.told.updateValue((kind, airport), (ts,))
        if flight.hold:
            self.hold.update((flight.hold["start"], flight.hold["last"], float(flight.hold["turn"])))
        else:
            self.hold.clear()

    def _forget(self) -> None:
        self.pings.clear(), self.told.clear(), self.hold.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 - the interface's name
        flight, out = self._flight(key[0]), []
        pings = [p for f in rows for r in f.to_dict("records") if (p := Ping.of(r)) is not None]
        for p in sorted(pings, key=lambda p: p.ts):
            out += flight.feed(p)
        if flight.pings:
            self._keep(flight)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if self.clock == "processing":
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + LOST_S * 1000)
            else:
                self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs() + 1, (flight.pings[-1].ts + LOST_S) * 1000))
        yield from _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802 - the interface's name
        out = self._flight(key[0]).lost()
        self._forget()
        yield from _frame(out)


def _frame(out: list[dict]) -> Iterator[pd.DataFrame]:
    if out:
        once = {e["event_id"]: e for e in reversed(out)}
        yield pd.DataFrame(list(once.values())).astype({"duration_s": "Int32"})


def detect_stream(messages: DataFrame, clock: str = "processing", lateness: str = "2 minutes") -> DataFrame:
    """The streaming twin of detect: typed keyed state per aircraft in a RocksDB store, in update mode.

    An aircraft is lost after LOST_S without a message: of processing time when live, or (clock
    "event") of event time behind the watermark when a replay must end by itself.
    """
    if clock not in ("processing", "event"):
        raise ValueError("clock must be processing or event")
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = messages.where(F.col("icao24").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if clock == "event":
        rows = rows.withWatermark("api_time", lateness)
    rows = rows.select("icao24", *MESSAGE, *(["api_time"] if clock == "event" else []))
    return rows.groupBy("icao24").transformWithStateInPandas(Tracker(clock), EVENTS_DDL, "Update", "ProcessingTime" if clock == "processing" else "EventTime")
