"""Stops and trips from location pings.

Pass one streams (source, day) blocks. In each, windows over positions that are smoothed by a running
median compare the net displacement with the length of the path: where the ratio is low and the
window's extent bounded, the readings belong to a stop. Runs of such readings become fragments,
readings on the move become one item per run, and the few readings for which a block cannot decide
(at its edges and beside silences) go on one by one. Pass two walks each source's items, merges
fragments into stays, and pairs consecutive stays into trips.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronflow.operators import batches

BLOCK_S = 86_400
EARTH_M = 6_371_000.0


@dataclass(frozen=True)
class Stay:
    radius_m: float = 250.0
    least_s: int = 600
    silence_s: int = 21_600
    #: Consecutive readings elsewhere that a stay survives.
    strays: int = 3
    #: Readings on either side of the movability window's middle; its running median survives as many strays.
    half: int = 4
    #: Net displacement over travelled length from which on a window is on the move.
    ratio: float = 0.6
    #: Seconds between readings from which on the readings beside are looked at one by one.
    sparse_s: int = 100


def metres(lat1, lon1, lat2, lon2):
    """Great-circle distance, elementwise."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    x = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(np.subtract(lon2, lon1)) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(x, 1.0)))


def stopped(lat: np.ndarray, lon: np.ndarray, seg: np.ndarray, rule: Stay) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Movability windows: which readings stand, and the smoothed track. Windows stay within a block."""
    n, h = len(lat), rule.half
    if not n:
        return np.zeros(0, bool), lat, lon
    lo = np.maximum(np.searchsorted(seg, seg, "left"), np.arange(n) - h)
    hi = np.minimum(np.searchsorted(seg, seg, "right") - 1, np.arange(n) + h)
    at = np.arange(n)[:, None] + np.arange(-h, h + 1)[None, :]
    outside = (at < lo[:, None]) | (at > hi[:, None])
    at = np.clip(at, 0, n - 1)
    la, lo_ = np.where(outside, np.nan, lat[at]), np.where(outside, np.nan, lon[at])
    slat, slon = np.nanmedian(la, 1), np.nanmedian(lo_, 1)
    at = np.clip(at, lo[:, None], hi[:, None])
    wlat, wlon = slat[at], slon[at]
    travelled = metres(wlat[:, :-1], wlon[:, :-1], wlat[:, 1:], wlon[:, 1:]).sum(1)
    net = metres(wlat[:, 0], wlon[:, 0], wlat[:, -1], wlon[:, -1])
    extent = metres(wlat, wlon, slat[:, None], slon[:, None]).max(1)
    low = (net <= rule.ratio * travelled) | (net <= rule.radius_m / 4)
    return low & (extent <= rule.radius_m), slat, slon


#: Kinds of items: on the move, standing (or single), a way that no stay reaches over, and a settled stay.
MOVE, STAND, WAY, STAY = range(4)
ITEMS = pa.schema([("icao24", pa.string()), ("t0", pa.int64()), ("t1", pa.int64()), ("n", pa.int64()), ("ground", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("lat0", pa.float64()), ("lon0", pa.float64()), ("lat1", pa.float64()), ("lon1", pa.float64()), ("path_m", pa.float64()), ("pause", pa.int64()), ("kind", pa.int8())])
ITEMS_DDL = "icao24 string, t0 long, t1 long, n long, ground long, lat double, lon double, lat0 double, lon0 double, lat1 double, lon1 double, path_m double, pause long, kind byte"


def _fragments(rule: Stay):
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        grp = np.zeros(table.num_rows, np.int64)
        grp[starts[1:]] = 1
        grp, t = np.cumsum(grp), batches.integers(table, "ts")
        lat, lon, ground = batches.doubles(table, "lat"), batches.doubles(table, "lon"), batches.flags(table, "on_ground")
        once = np.r_[True, (grp[1:] != grp[:-1]) | (t[1:] != t[:-1])]
        row = np.flatnonzero(once)
        grp, t, lat, lon, ground = grp[row], t[row], lat[row], lon[row], ground[row]
        n = len(row)
        still, slat, slon = stopped(lat, lon, grp, rule)
        new = np.r_[True, grp[1:] != grp[:-1]]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        pos = np.arange(n) - first[grp - grp[0]]
        edge = rule.half + rule.strays + 1
        single = (pos < edge) | (pos >= size[grp - grp[0]] - edge)
        sparse = np.r_[False, (np.diff(t) > rule.sparse_s) & ~new[1:]]
        for k in range(-rule.strays - 1, rule.strays + 2):
            near = np.flatnonzero(sparse) + k
            single[near[(near >= 0) & (near < n)]] = True
        # a window reaches half readings to either side and each of those is smoothed over half more: within that of a turn it cannot tell
        turn = np.flatnonzero(np.r_[False, (still[1:] != still[:-1]) & ~new[1:]])
        for k in range(-2 * rule.half - 1, 2 * rule.half + 1):
            near = turn + k
            near = near[(near >= 0) & (near < n)]
            single[near[~still[near]]] = True
        # a fragment's readings lie within the radius of its own median; strays inside a standing run go on one by one
        def cut(kind: np.ndarray) -> np.ndarray:
            return np.cumsum(np.r_[True, new[1:] | (kind[1:] != kind[:-1]) | (kind[1:] == 2)]) - 1

        kind = np.where(single, 2, np.where(still, 1, 0))
        far = metres(lat, lon, slat, slon) > rule.radius_m
        kind[(kind == 1) & far] = 2
        item = cut(kind)
        while True:  # each round takes a reading out of a fragment, so this ends
            mlat, mlon = _middle(item, lat), _middle(item, lon)
            out = (kind == 1) & (metres(lat, lon, mlat[item], mlon[item]) > rule.radius_m / 2)
            if not out.any():
                break
            kind[out] = 2
            item = cut(kind)
        begin = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        end = np.append(begin[1:], n) - 1
        mlat, mlon = _middle(item, lat), _middle(item, lon)
        step = np.r_[0.0, metres(slat[:-1], slon[:-1], slat[1:], slon[1:])]
        step[begin] = 0.0
        stand = kind[begin] == 1
        path = np.where(stand, 0.0, np.add.reduceat(step, begin))
        gap = np.r_[0, np.diff(t)]
        gap[begin] = 0
        x = {
            "t0": t[begin], "t1": t[end], "n": end - begin + 1, "ground": np.add.reduceat(ground.astype(np.int64), begin), "lat": mlat, "lon": mlon, "lat0": slat[begin], "lon0": slon[begin],
            "lat1": slat[end], "lon1": slon[end], "path_m": path, "pause": np.maximum.reduceat(gap, begin), "kind": np.where(kind[begin] > 0, STAND, MOVE),
        }
        own = grp[begin]
        groups = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        x = {k: v.tolist() for k, v in x.items()}
        name = table.column("icao24").take(pa.array(row[begin[groups]])).to_pylist()
        out: list[tuple] = []
        for who, i, j in zip(name, groups.tolist(), [*groups[1:].tolist(), len(begin)], strict=True):
            out += [(who, *r) for r in _settle(x, i, j, rule)]
        yield batches.batch(ITEMS, **dict(zip(ITEMS.names, zip(*out, strict=True), strict=True)))

    return lambda incoming: batches.whole_groups(incoming, ("icao24", "block"), work)


def _middle(item: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Median of x by item."""
    order = np.lexsort((x, item))
    begin = np.searchsorted(item, np.arange(item[-1] + 1))
    size = np.diff(np.append(begin, len(item)))
    return (x[order[begin + (size - 1) // 2]] + x[order[begin + size // 2]]) / 2


FOUND = pa.schema([("icao24", pa.string()), ("kind", pa.string()), ("start_ts", pa.int64()), ("end_ts", pa.int64()), ("distance_m", pa.float64()), ("lat", pa.float64()), ("lon", pa.float64()), ("readings", pa.int64())])
FOUND_DDL = "icao24 string, kind string, start_ts long, end_ts long, distance_m double, lat double, lon double, readings long"


def _walk(x: dict[str, list], i: int, j: int, rule: Stay) -> list[tuple]:
    """Stays among the items i..j: (first item, last item, n, ground, lat, lon); settled ones as they are."""
    t0, t1, n, ground, lat, lon, kind = (x[k] for k in ("t0", "t1", "n", "ground", "lat", "lon", "kind"))
    found, at = [], i
    while at < j:
        if kind[at] == STAY:
            found.append((at, at, n[at], ground[at], lat[at], lon[at]))
        if kind[at] != STAND:
            at += 1
            continue
        la, lo, count, on, last, strays = lat[at], lon[at], n[at], ground[at], at, 0
        scale = METRES_A_DEGREE * math.cos(math.radians(la))
        k = at + 1
        while k < j and kind[k] < WAY and t0[k] - t1[k - 1] <= rule.silence_s:
            if kind[k] == STAND and ((lat[k] - la) * METRES_A_DEGREE) ** 2 + ((lon[k] - lo) * scale) ** 2 <= rule.radius_m**2:
                count, on, last, strays = count + n[k], on + ground[k], k, 0
                la, lo = la + (lat[k] - la) * n[k] / count, lo + (lon[k] - lo) * n[k] / count
            else:
                strays += n[k]
                if strays > rule.strays:
                    break
            k += 1
        if t1[last] - t0[at] >= rule.least_s:
            found.append((at, last, count, on, la, lo))
            at = last + 1
        else:
            at += 1
    return found


def _settle(x: dict[str, list], i: int, j: int, rule: Stay) -> list[tuple]:
    """A block's items with everything between its first and last break settled: stays, and ways between them."""
    t0, t1, n, kind = x["t0"], x["t1"], x["n"], x["kind"]
    fields = [x[k] for k in ITEMS.names[1:]]
    out: list[tuple] = []
    way: list[int] = []

    def close() -> None:
        """The items gathered in way as one."""
        if way:
            a, b = way[0], way[-1]
            hops = sum(_hop(x, q - 1, q) for q in way[1:])
            longest = max([*(x["pause"][q] for q in way), *(t0[q] - t1[q - 1] for q in way[1:])])
            out.append((t0[a], t1[b], sum(n[q] for q in way), sum(x["ground"][q] for q in way), x["lat"][a], x["lon"][a], x["lat0"][a], x["lon0"][a], x["lat1"][b], x["lon1"][b], sum(x["path_m"][q] for q in way) + hops, longest, WAY))
            way.clear()

    def segment(a: int, b: int, settled: bool) -> None:
        if not settled:
            close()
            out.extend(tuple(f[q] for f in fields) for q in range(a, b))
            return
        for first, last, count, on, la, lo in [*_walk(x, a, b, rule), (b, b, 0, 0, 0, 0)]:
            way.extend(range(a, first))
            if first < b:
                if 2 * on > count:
                    close()
                    out.append((t0[first], t1[last], count, on, la, lo, x["lat0"][first], x["lon0"][first], x["lat1"][last], x["lon1"][last], 0.0, 0, STAY))
                else:  # a stay in the air separates nothing
                    way.extend(range(first, last + 1))
            a = last + 1

    begin, closed = i, False
    for k in range(i, j):
        if k > i and t0[k] - t1[k - 1] > rule.silence_s:
            segment(begin, k, closed)
            begin, closed = k, True
        if kind[k] == MOVE and n[k] > rule.strays:
            segment(begin, k, closed)
            way.append(k)
            begin, closed = k + 1, True
    segment(begin, j, False)
    close()
    return out


def _hop(x: dict[str, list], a: int, b: int) -> float:
    """Metres from the end of one item to the beginning of another."""
    north = (x["lat0"][b] - x["lat1"][a]) * METRES_A_DEGREE
    east = (x["lon0"][b] - x["lon1"][a]) * METRES_A_DEGREE * math.cos(math.radians(x["lat1"][a]))
    return math.hypot(north, east)


METRES_A_DEGREE = EARTH_M * math.pi / 180


def _stays(rule: Stay):
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        x = {f.name: table.column(f.name).to_pylist() for f in ITEMS}
        rows: list[tuple] = []
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            name, before = x["icao24"][i], None
            for stay in _walk(x, i, j, rule):
                first, last, count, on, la, lo = stay
                if 2 * on <= count:
                    continue
                if before is not None:
                    between = range(before + 1, first + 1)
                    if max(x["t0"][q] - x["t1"][q - 1] for q in between) <= rule.silence_s and max([0, *(x["pause"][q] for q in between[:-1])]) <= rule.silence_s:
                        length = sum(_hop(x, q - 1, q) for q in between) + sum(x["path_m"][q] for q in between[:-1])
                        rows.append((name, "trip", x["t1"][before], x["t0"][first], length, None, None, None))
                rows.append((name, "stop", x["t0"][first], x["t1"][last], 0.0, la, lo, count))
                before = last
        if rows:
            yield batches.batch(FOUND, **dict(zip(FOUND.names, zip(*rows, strict=True), strict=True)))

    return lambda incoming: batches.whole_groups(incoming, ("icao24",), work, rows=16_384)


def stops_and_trips(readings: DataFrame, rule: Stay = Stay(), block_s: int = BLOCK_S) -> DataFrame:
    """Stops and trips of each source: icao24, kind, start_ts, end_ts, distance_m, lat, lon, readings.

    readings: icao24, ts, lat, lon, on_ground as sources.tables.readings gives them; copies of one
    (icao24, ts) agree and count once. Readings without a position, or with one that is not on the
    globe, do not count. A null on_ground counts as in the air. A stay within radius_m that lasts
    least_s or more and is on the ground by most of its readings is a stop; a trip joins two
    consecutive stops between which no silence is longer than silence_s. Stays in the air separate
    nothing. Empty tables give empty results; extra columns are ignored.

    Scale: one exchange of the readings by (source, block), so a hot source is spread over its
    blocks. What goes on to a source's own task is bounded by its days and stops, not by its
    readings: per block the items about its edges, and per stop two.
    """
    rows = readings.where(F.abs("lat").between(0, 90) & F.abs("lon").between(0, 180))
    rows = rows.select("icao24", F.floor(F.col("ts") / block_s).cast("long").alias("block"), "ts", "lat", "lon", "on_ground")
    laid = rows.repartition("icao24", "block").sortWithinPartitions("icao24", "block", "ts")
    items = laid.mapInArrow(_fragments(rule), ITEMS_DDL)
    return items.repartition("icao24").sortWithinPartitions("icao24", "t0").mapInArrow(_stays(rule), FOUND_DDL)
