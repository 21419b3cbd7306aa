"""Arrivals, holdings and go-arounds of one aircraft, from its pings one at a time.

A Flight keeps the newest pings and what has been told already. Whoever feeds it (a stream's keyed
state or a sorted partition) gets the same events however the pings are batched, because every
rule looks at the flight after each single ping.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import dataclass, field
from typing import NamedTuple

from apronflow.functions.geo import AIRPORTS

FIELDS = tuple((code, lat, lon) for code, (lat, lon) in AIRPORTS.items())
#: The thresholds of the rules.
EARTH_KM = 6371.0
KEPT = 20
LOST_S = 90
AGAIN_S = 1200
APPROACH_KM, APPROACH_M = 7.0, 1000.0
GROUND_KM = 4.0
FINAL_KM, FINAL_M = 5.0, 450.0
HOLD_ALTITUDE, HOLD_SPEED = (1700.0, 5000.0), (90.0, 160.0)
HOLD_TURN, HOLD_S, HOLD_KM, HOLD_END_S = 340.0, 480, 15.0, 120
LIGHT = frozenset({2, 8, 9, 10, 11, 12, 14})
BALK_KM, BALK_M, SINK, CLIMB, GAIN_M, LOOK_BACK = 12.0, 800.0, -2.0, 3.0, 200.0, 6


class Ping(NamedTuple):
    ts: int
    lat: float
    lon: float
    alt: float | None
    speed: float | None
    track: float | None
    climb: float | None
    ground: bool
    category: int | None
    callsign: str | None

    @classmethod
    def of(cls, row: dict) -> Ping | None:
        """From a message; NaN counts as null, and without a position or time there is no ping."""
        clean = {k: None if isinstance(v, float) and math.isnan(v) else v for k, v in row.items()}
        if any(clean.get(k) is None for k in ("lat", "lon", "api_ts")):
            return None
        category = clean.get("category")
        return cls(
            int(clean["api_ts"]), float(clean["lat"]), float(clean["lon"]), clean.get("baro_alt_m"), clean.get("velocity_ms"), clean.get("track_deg"), clean.get("vrate_ms"),
            bool(clean.get("on_ground")), None if category is None else int(category), clean.get("callsign") or None,
        )


def km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * math.asin(math.sqrt(h))


def nearest(p: Ping) -> tuple[float, str]:
    return min(((km(p.lat, p.lon, lat, lon), code) for code, lat, lon in FIELDS), key=lambda x: x[0])


def turned(pings: list[Ping]) -> float:
    """Degrees turned along the pings, either way."""
    return sum(abs((b.track - a.track + 180.0) % 360.0 - 180.0) for a, b in zip(pings, pings[1:], strict=False))


@dataclass
class Flight:
    icao24: str
    pings: list[Ping] = field(default_factory=list)
    told: dict[str, dict[str, int]] = field(default_factory=lambda: {"arrival": {}, "go_around": {}})
    hold: dict | None = None

    def dump(self) -> str:
        return json.dumps({"icao24": self.icao24, "pings": [list(p) for p in self.pings], "told": self.told, "hold": self.hold}, allow_nan=False)

    @classmethod
    def load(cls, text: str) -> Flight:
        x = json.loads(text)
        return cls(x["icao24"], [Ping(*p) for p in x["pings"]], x["told"], x["hold"])

    def feed(self, p: Ping) -> list[dict]:
        """Events that this ping brings; after a silence the flight is first taken as lost and begins anew."""
        out: list[dict] = []
        if self.pings and p.ts - self.pings[-1].ts > LOST_S:
            out = self.lost()
            self.pings, self.told, self.hold = [], {"arrival": {}, "go_around": {}}, None
        if all(p.ts != q.ts for q in self.pings):
            self.pings = sorted([*self.pings, p], key=lambda q: q.ts)[-KEPT:]
        for rule in (self._landed, self._holding, self._balked):
            if (event := rule()) is not None:
                out.append(event)
        return out

    def lost(self) -> list[dict]:
        """Events told by the loss of contact: a landing on short final, and the end of a holding."""
        out = []
        if self.pings:
            p = self.pings[-1]
            if not p.ground and p.alt is not None and p.alt < FINAL_M:
                away, airport = nearest(p)
                if away < FINAL_KM and self._first("arrival", airport, p.ts):
                    details = {"confirmation": "coverage_loss", "last_alt_m": round(p.alt, 1), "dist_km": round(away, 2)}
                    out.append(self._event("arrival", airport, p.ts, self._approach(p.ts), None, details))
        if self.hold and (event := self._end_hold()) is not None:
            out.append(event)
        return out

    def _event(self, kind: str, airport: str, at: int, start: int, duration: int | None, details: dict) -> dict:
        identity = hashlib.sha1(f"{self.icao24}|{kind}|{start}".encode()).hexdigest()[:16]
        callsign = next((p.callsign for p in reversed(self.pings) if p.callsign), None)
        return {"event_id": identity, "icao24": self.icao24, "callsign": callsign, "event_type": kind, "airport": airport, "event_ts": at, "duration_s": duration, "details": json.dumps(details, allow_nan=False)}

    def _first(self, kind: str, airport: str, ts: int) -> bool:
        """Whether nothing of the kind was told for the airport shortly before; if so it is noted now."""
        before = self.told[kind].get(airport)
        if before is not None and ts - before < AGAIN_S:
            return False
        self.told[kind][airport] = ts
        return True

    def _approach(self, otherwise: int) -> int:
        """When the approach began: the first low ping near an airport that is not climbing."""
        for p in self.pings:
            if not p.ground and p.alt is not None and p.alt < APPROACH_M and (p.climb is None or p.climb < 0) and nearest(p)[0] < APPROACH_KM:
                return p.ts
        return otherwise

    def _landed(self) -> dict | None:
        *before, p = self.pings
        if not p.ground:
            return None
        flown = [q.ts for q in before if not q.ground]
        if not flown:
            return None
        away, airport = nearest(p)
        if away >= GROUND_KM or not self._first("arrival", airport, p.ts):
            return None
        return self._event("arrival", airport, p.ts, self._approach(flown[-1]), None, {"confirmation": "on_ground", "dist_km": round(away, 2)})

    @staticmethod
    def _may_hold(p: Ping) -> bool:
        known = not p.ground and None not in (p.alt, p.speed, p.track) and p.category not in LIGHT
        return known and HOLD_ALTITUDE[0] <= p.alt <= HOLD_ALTITUDE[1] and HOLD_SPEED[0] <= p.speed <= HOLD_SPEED[1]

    def _holding(self) -> dict | None:
        p = self.pings[-1]
        if self.hold:
            recent = [q for q in self.pings if q.track is not None and p.ts - q.ts <= HOLD_END_S]
            span = recent[-1].ts - recent[0].ts if len(recent) > 1 else 0
            if span > 0 and turned(recent) / span >= HOLD_TURN / HOLD_S and self._may_hold(p):
                last = [q for q in self.pings[-2:] if q.track is not None]
                self.hold["last"], self.hold["turn"] = p.ts, self.hold["turn"] + turned(last)
            elif p.ts - self.hold["last"] >= HOLD_END_S:
                return self._end_hold()
            return None
        band = [q for q in self.pings if p.ts - q.ts <= HOLD_S and self._may_hold(q)]
        if len(band) >= 4 and (turn := turned(band)) >= HOLD_TURN and km(band[0].lat, band[0].lon, band[-1].lat, band[-1].lon) < HOLD_KM:
            self.hold = {"start": band[0].ts, "last": p.ts, "turn": turn}
        return None

    def _end_hold(self) -> dict | None:
        hold, self.hold = self.hold, None
        duration = hold["last"] - hold["start"]
        if duration <= 0:
            return None
        inside = [q for q in self.pings if hold["start"] <= q.ts <= hold["last"]] or self.pings
        away, airport = nearest(inside[len(inside) // 2])
        return self._event("holding", airport, hold["start"], hold["start"], duration, {"cum_track_deg": round(hold["turn"], 0), "dist_to_airport_km": round(away, 1)})

    def _balked(self) -> dict | None:
        rise = len(self.pings)
        while rise and not self.pings[rise - 1].ground and (self.pings[rise - 1].climb or 0) > CLIMB:
            rise -= 1
        up, before = self.pings[rise:], self.pings[max(0, rise - LOOK_BACK) : rise]
        if len(up) < 2 or any(q.ground for q in before) or up[-1].alt is None:
            return None
        down = [(q, *nearest(q)) for q in before if (q.climb or 0) < SINK and not q.ground and q.alt is not None and q.alt < BALK_M]
        down = [x for x in down if x[1] < BALK_KM]
        if len(down) < 2:
            return None
        low = min(q.alt for q in [*(x[0] for x in down), *up] if q.alt is not None)
        gain = up[-1].alt - low
        _, away, airport = down[-1]
        if gain < GAIN_M or not self._first("go_around", airport, up[0].ts):
            return None
        return self._event("go_around", airport, up[0].ts, up[0].ts, None, {"low_alt_m": round(low, 1), "gain_m": round(gain, 1), "dist_km": round(away, 2)})
