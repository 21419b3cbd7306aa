"""Implausible measurements per source: a hidden Markov model over spikes, stuck values and impossible readings.

Two passes over the same exchange of (source, day) blocks. The first gives, per block and field, a
histogram of how far readings lie off their course (mergeable, so a source's usual scatter comes
from all of its rows however they are spread over tasks) and the readings at the block's edges. The
second gets each block together with the scatter and its neighbours' edges, runs forward-backward
over the states normal, spike, stuck and out of range, and checks the likely ones exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronflow.operators import batches

#: Readings of a neighbour block that a block sees at each side; a stuck run needs EDGE >= its least length.
EDGE = 12
BLOCK_S = 86_400
#: Bins of |distance from the course|: 2 % wide, from 0.001 up.
LOW, STEP, BINS = 1e-3, 0.02, 1200


@dataclass(frozen=True)
class Limits:
    """What is impossible, and how far off its course a spike lies at least."""

    name: str
    low: float
    high: float
    least: float
    #: Its values hold a level rather than a slope, so a reading beyond both neighbours is off by the lesser distance to them.
    level: bool = False


@dataclass(frozen=True)
class Rules:
    fields: tuple[Limits, ...]
    times_scatter: float = 8.0
    stuck_run: int = 8
    #: Seconds between readings from which on there is no course.
    silence: int = 300


def course(seg: np.ndarray, t: np.ndarray, v: np.ndarray, silence: int, width: int, level: bool = False) -> np.ndarray:
    """How far width consecutive readings, beginning at each position, lie off the course around them.

    The course is told three ways: between the reading before and the one after, on from the two
    before, and back from the two after. The distance is that from the first, unless the others lie
    nearer (an ordinary bend of the course explains the reading from one side) by more than BEND
    allows; with level, it is at least the lesser distance to both neighbours, if the reading lies
    beyond both. (A slope's turning point, as in a go-around, lies beyond both and is no spike.) It is 0 where the ways disagree about its sign or two of the readings from the one before to the one after follow each other by more than a silence. For
    two readings it is the lesser of theirs.
    """
    n = len(t)

    def near(k: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(n) + k
        inside = (at >= 0) & (at < n)
        at = np.clip(at, 0, max(n - 1, 0))
        inside &= seg[at] == seg
        return np.where(inside, t[at], np.nan), np.where(inside, v[at], np.nan)

    if not n:
        return np.zeros(0)
    (t1, v1), (t2, v2), (n1t, n1), (n2t, n2) = near(-1), near(-2), near(width), near(width + 1)
    worst = np.full(n, np.inf)
    up = None
    unbroken = np.ones(n, bool)  # from the reading before to the one after no two consecutive ones are a silence apart
    with np.errstate(all="ignore"):
        back, ahead = (v1 - v2) / (t1 - t2), (n2 - n1) / (n2t - n1t)
        back[~(t1 - t2 <= silence)] = np.nan
        ahead[~(n2t - n1t <= silence)] = np.nan
        for k in range(width + 1):
            unbroken &= near(k)[0] - near(k - 1)[0] <= silence
        for k in range(width):
            tk, vk = (t, v) if k == 0 else near(k)
            between = vk - (v1 + (n1 - v1) * (tk - t1) / (n1t - t1))
            off = np.stack([between, vk - (v1 + back * (tk - t1)), vk - (n1 + ahead * (tk - n1t))])
            known = ~np.isnan(off)
            agree = (np.where(known, off, np.inf).min(0) > 0) | (np.where(known, off, -np.inf).max(0) < 0)
            least = np.where(agree, np.minimum(np.abs(between), np.where(known, np.abs(off), np.inf).min(0) / BEND), 0)
            one, other = vk - v1, vk - n1
            if level:
                least = np.maximum(least, np.where(one * other > 0, np.minimum(np.abs(one), np.abs(other)), 0))
                # a level that goes on from either side and then changes for good explains the reading too
                for side in (one, other):
                    least = np.minimum(least, np.where(side * between > 0, np.abs(side) / STEP_SHARE, 0))
            least = np.where(unbroken & (True if up is None else up == (between > 0)), least, 0)
            up = between > 0 if up is None else up
            worst = np.minimum(worst, least)
    return worst


#: Share of its distance from the line between its neighbours that a reading must keep from the lines on either side.
BEND = 0.75
#: With level, the share that it must keep from the values on either side.
STEP_SHARE = 0.5

#: States of the model: normal, spike, stuck, out of range.
START = np.array([0.97, 0.01, 0.01, 0.01])
MOVES = np.array([[0.988, 0.006, 0.001, 0.005], [0.60, 0.35, 0.01, 0.04], [0.03, 0.004, 0.962, 0.004], [0.88, 0.01, 0.01, 0.10]])


def emissions(score: np.ndarray, repeats: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Likelihood of each reading under the four states. score: distance off the course over its threshold."""
    u = np.minimum(score, 3.0)
    normal = np.exp(-(u**2) / (2 * 0.2**2)) * np.where(repeats, 0.05, 0.95)
    spike = np.full(len(u), np.exp(-4.0)) * np.where(repeats, 0.5, 0.95)
    # a stuck value departs from the course by and by; two equal values far off it are a spike
    stuck = np.where(repeats, 0.9, 1e-6) * np.where(u > 0.5, 1e-4, 1.0)
    out = np.full(len(u), 1e-12)
    e = np.stack([normal, spike, stuck, out], 1) + 1e-30
    e[outside] = [1e-12, 1e-12, 1e-12, 1.0]
    return e


def posterior(seg: np.ndarray, e: np.ndarray, chunk: int = 64) -> np.ndarray:
    """Forward-backward probabilities of the states; sources are separate chains.

    The chain is laid out in rows of chunk readings, and all rows step together: once with matrices,
    which tell what a row makes of any message that enters it, and, when a pass over the rows has
    told the messages, once with vectors. The result is exact.
    """
    n = len(seg)
    if not n:
        return np.zeros((0, 4))
    m = -(-n // chunk)
    at = np.arange(m * chunk).reshape(m, chunk)
    inside = at < n
    at = np.minimum(at, n - 1)
    begins = np.r_[True, seg[1:] != seg[:-1]]
    em = np.where(inside[:, :, None], e[at], 1.0)
    first, last = begins[at] & inside, np.r_[begins[1:], True][at] & inside

    def forward(x: np.ndarray, k: int) -> np.ndarray:
        x = np.where(first[:, k, None, None], x.sum(2, keepdims=True) * START, x @ MOVES) * em[:, k, None, :]
        return x / x.sum((1, 2), keepdims=True)

    def entered(x: np.ndarray, k: int) -> np.ndarray:
        """The message about the readings from k on, as it enters k: after a source's last reading it says nothing."""
        return np.where(last[:, k, None, None], x.sum(1, keepdims=True), x)

    def backward(x: np.ndarray, k: int) -> np.ndarray:
        x = MOVES @ (em[:, k, :, None] * entered(x, k))
        return x / x.sum((1, 2), keepdims=True)

    through, back = np.tile(np.eye(4), (m, 1, 1)), np.tile(np.eye(4), (m, 1, 1))
    for k in range(chunk):
        through, back = forward(through, k), backward(back, chunk - 1 - k)
    a, b = np.full((m, 1, 4), 0.25), np.full((m, 4, 1), 0.25)
    for j in range(1, m):
        x = a[j - 1, 0] @ through[j - 1]
        a[j, 0] = x / x.sum()
        x = back[m - j] @ b[m - j, :, 0]
        b[m - j - 1, :, 0] = x / x.sum()
    p = np.empty((m, chunk, 4))
    for k in range(chunk):
        a = forward(a, k)
        p[:, k] = a[:, 0]
    for k in range(chunk - 1, -1, -1):
        p[:, k] *= entered(b, k)[:, :, 0]
        b = backward(b, k)
    p = p.reshape(-1, 4)[:n]
    return p / p.sum(1, keepdims=True)


def stuck_runs(seg: np.ndarray, v: np.ndarray, flying: np.ndarray, least: int) -> np.ndarray:
    """Readings of runs of at least `least` consecutive equal values in flight."""
    if not len(v):
        return np.zeros(0, bool)
    new = np.r_[True, (seg[1:] != seg[:-1]) | (v[1:] != v[:-1]) | ~(flying[1:] & flying[:-1])]
    run = np.cumsum(new) - 1
    return (np.bincount(run)[run] >= least) & flying


def flag(seg: np.ndarray, t: np.ndarray, v: np.ndarray, flying: np.ndarray, threshold: np.ndarray, limit: Limits, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """For one field, sorted by source and time: the reason per reading (0 none, 1 spike, 2 stuck, 3 impossible) and its probability."""
    n = len(v)
    reason, sure = np.zeros(n, np.int8), np.zeros(n)
    outside = (v < limit.low) | (v > limit.high)
    same = np.zeros(n, bool)
    if n > 1:
        pair = (seg[1:] == seg[:-1]) & (v[1:] == v[:-1]) & flying[1:] & flying[:-1]
        same[1:] |= pair
        same[:-1] |= pair
    # impossible and stuck values tell nothing of the course around them
    frozen = stuck_runs(seg, v, flying, rules.stuck_run)
    alive = np.flatnonzero(~outside & ~frozen)
    spiked = np.zeros(n, bool)
    p, judged = np.zeros((n, 4)), np.arange(n)
    # a spike hides or feigns others beside it: the strongest go first, then the rest of their sources is judged anew,
    # until a round finds none; each takes at least one reading away, so this ends
    while True:
        s, ts, vs, th = seg[alive], t[alive], v[alive], threshold[alive]
        one, two = (course(s, ts, vs, rules.silence, width, limit.level) / th for width in (1, 2))
        two[-1:] = 0
        paired = np.maximum(two, np.r_[0, two[:-1]])
        score = np.zeros(n)
        score[alive] = np.maximum(one, paired)
        p[judged] = posterior(seg[judged], emissions(score[judged], same[judged], outside[judged]))
        if not spiked.any():
            sure = np.max(p[:, 1:], 1)
            likely_stuck = p[:, 2] > 0.5
        likely = p[alive, 1] > 0.5
        mine = score[alive]
        # exact: off by more than the threshold, and nothing stronger within two readings
        top = mine.copy()
        for k in (1, 2):
            top[k:] = np.maximum(top[k:], mine[:-k])
            top[:-k] = np.maximum(top[:-k], mine[k:])
        found = likely & (mine > 1) & (mine >= top)
        as_pair = np.flatnonzero(found & (two >= one) & (two > 1) & (two >= mine))
        found[np.minimum(as_pair + 1, len(found) - 1)] = True
        if not found.any():
            break
        spiked[alive[found]] = True
        sure[alive[found]] = np.maximum(sure[alive[found]], p[alive, 1][found])
        busy = np.isin(seg, s[found])
        judged, alive = np.flatnonzero(busy), alive[~found & busy[alive]]
    reason[spiked] = 1
    reason[frozen & likely_stuck & ~spiked if n else spiked] = 2
    reason[outside & (np.argmax(p, 1) == 3) if n else outside] = 3
    return reason, sure


def _own(table: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group number, time, flying and first-copy flag of each row."""
    grp = np.zeros(table.num_rows, np.int64)
    grp[starts[1:]] = 1
    grp = np.cumsum(grp)
    t = batches.integers(table, "ts")
    once = np.r_[True, (grp[1:] != grp[:-1]) | (t[1:] != t[:-1])] if len(t) else np.zeros(0, bool)
    known = table.column("on_ground").combine_chunks().fill_null(True).to_numpy(zero_copy_only=False)
    return grp, t, ~np.asarray(known, bool), once


EDGES = pa.schema([("icao24", pa.string()), ("block", pa.int64()), ("first_ts", pa.int64()), ("edges", pa.binary()), ("bins", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
EDGES_DDL = "icao24 string, block long, first_ts long, edges binary, bins array<int>, counts array<int>"


def _survey(rules: Rules):
    """First pass: per block the histogram of distances from the course, and its edges."""

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        grp, t, flying, once = _own(table, starts)
        m = len(starts)
        bins, counts, edges = [[] for _ in range(m)], [[] for _ in range(m)], [[] for _ in range(m)]
        for f, limit in enumerate(rules.fields):
            v = batches.doubles(table, limit.name)
            with np.errstate(invalid="ignore"):
                idx = np.flatnonzero(once & ~np.isnan(v))
                ok = idx[(v[idx] >= limit.low) & (v[idx] <= limit.high)]
            g, ts, vs, fl = grp[ok], t[ok], v[ok], flying[ok]
            if len(ok) > 2:
                mid = np.arange(1, len(ok) - 1)
                use = (g[mid - 1] == g[mid + 1]) & (ts[mid + 1] - ts[mid - 1] <= rules.silence) & fl[mid]
                mid = mid[use]
                off = np.abs(vs[mid] - (vs[mid - 1] + (vs[mid + 1] - vs[mid - 1]) * (ts[mid] - ts[mid - 1]) / (ts[mid + 1] - ts[mid - 1])))
                b = np.clip(np.floor(np.log(np.maximum(off, LOW) / LOW) / STEP), 0, BINS - 1).astype(np.int64)
                key, number = np.unique(g[mid] * BINS + b, return_counts=True)
                of = np.searchsorted(key // BINS, np.arange(m + 1))
                for i in np.unique(key // BINS):
                    bins[i].append((key[of[i] : of[i + 1]] % BINS + f * BINS).astype(np.int32))
                    counts[i].append(number[of[i] : of[i + 1]].astype(np.int32))
            g = grp[idx]
            of = np.searchsorted(g, np.arange(m + 1))
            for i in range(m):
                own = idx[of[i] : of[i + 1]]
                for part in (own[:EDGE], own[-EDGE:]):
                    edges[i].append(np.r_[len(part), t[part], v[part], flying[part]].astype(np.float64))
        names = table.column("icao24").take(pa.array(starts)).to_pylist()
        block = batches.integers(table, "block")[starts]
        none = np.zeros(0, np.int32)
        yield batches.batch(EDGES, icao24=names, block=block, first_ts=t[starts], edges=[np.concatenate(x).tobytes() for x in edges], bins=[np.concatenate(x) if x else none for x in bins], counts=[np.concatenate(x) if x else none for x in counts])

    return lambda incoming: batches.whole_groups(incoming, ("icao24", "block"), work)


CONTEXT = pa.schema([("icao24", pa.string()), ("block", pa.int64()), ("first_ts", pa.int64()), ("context", pa.binary())])
CONTEXT_DDL = "icao24 string, block long, first_ts long, context binary"


def _parts(edges: bytes, fields: int) -> list[np.ndarray]:
    """head and tail of each field as (3, n) arrays of time, value, flying."""
    x, at, out = np.frombuffer(edges, np.float64), 0, []
    for _ in range(2 * fields):
        n = int(x[at])
        out.append(x[at + 1 : at + 1 + 3 * n].reshape(3, n))
        at += 1 + 3 * n
    return out


def _contexts(rules: Rules):
    """Per source: its scatter from all blocks' histograms, and for each block the neighbours' edges."""
    fields = len(rules.fields)

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, block = table.column("icao24").to_pylist(), table.column("block").to_pylist()
        edges, bins, counts = (table.column(c).to_pylist() for c in ("edges", "bins", "counts"))
        context = []
        for i, j in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            total = np.zeros(fields * BINS)
            for k in range(i, j):
                np.add.at(total, np.asarray(bins[k], np.int64), counts[k])
            scatter = np.zeros(fields)
            for f, h in enumerate(total.reshape(fields, BINS)):
                if h.sum():
                    middle = int(np.searchsorted(np.cumsum(h), h.sum() / 2))
                    # a normal reading's distance from the line between its neighbours has 1.5 times the reading's own variance
                    scatter[f] = 1.4826 / np.sqrt(1.5) * LOW * np.exp((middle + 0.5) * STEP) if middle else 0.0
            parts = [_parts(edges[k], fields) for k in range(i, j)]
            for k in range(j - i):
                x = [scatter]
                for f in range(fields):
                    for side, span in ((1, range(k - 1, -1, -1)), (0, range(k + 1, j - i))):
                        got, have = [], 0
                        for q in span:
                            p = parts[q][2 * f + side]
                            got.append(p)
                            have += p.shape[1]
                            if have >= EDGE:
                                break
                        p = np.concatenate(got[:: -1 if side else 1], 1) if got else np.zeros((3, 0))
                        p = p[:, -EDGE:] if side else p[:, :EDGE]
                        x += [np.array([p.shape[1]]), p.ravel()]
                context.append(np.concatenate(x).astype(np.float64).tobytes())
        yield batches.batch(CONTEXT, icao24=names, block=block, first_ts=table.column("first_ts").to_pylist(), context=context)

    return lambda incoming: batches.whole_groups(incoming, ("icao24",), work, rows=512)


FLAGS = pa.schema([("icao24", pa.string()), ("ts", pa.int64()), ("field", pa.string()), ("value", pa.float64()), ("reason", pa.string()), ("probability", pa.float64())])
FLAGS_DDL = "icao24 string, ts long, field string, value double, reason string, probability double"
REASONS = ("", "spike", "stuck", "impossible")


def _judge(rules: Rules):
    fields = len(rules.fields)

    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        grp, t, flying, once = _own(table, starts)
        m = len(starts)
        context = table.column("context").combine_chunks()
        context = context.chunk(0) if isinstance(context, pa.ChunkedArray) else context
        told: list[tuple] = [None] * m
        for i in np.flatnonzero(context.is_valid().to_numpy(zero_copy_only=False)):
            told[grp[i]] = context[int(i)].as_py()
        scatter, around = np.zeros((m, fields)), []
        for i, c in enumerate(told):
            x = np.frombuffer(c, np.float64) if c else np.zeros(3 * fields)
            scatter[i], at, parts = x[:fields], fields, []
            for _ in range(2 * fields):
                n = int(x[at])
                parts.append(x[at + 1 : at + 1 + 3 * n].reshape(3, n))
                at += 1 + 3 * n
            around.append(parts)
        out: dict[str, list] = {k: [] for k in ("row", "field", "value", "reason", "probability")}
        for f, limit in enumerate(rules.fields):
            v = batches.doubles(table, limit.name)
            own = np.flatnonzero(once & ~np.isnan(v))
            foreign = [(i, p) for i in range(m) for p in around[i][2 * f : 2 * f + 2] if p.shape[1]]
            seg = np.concatenate([grp[own], *[np.full(p.shape[1], i) for i, p in foreign]])
            ts = np.concatenate([t[own], *[p[0].astype(np.int64) for _, p in foreign]])
            vs = np.concatenate([v[own], *[p[1] for _, p in foreign]])
            fl = np.concatenate([flying[own], *[p[2] > 0 for _, p in foreign]])
            row = np.concatenate([own, np.full(len(seg) - len(own), -1)])
            order = np.lexsort((ts, seg))
            seg, ts, vs, fl, row = seg[order], ts[order], vs[order], fl[order], row[order]
            threshold = np.maximum(limit.least, rules.times_scatter * scatter[seg, f])
            reason, sure = flag(seg, ts.astype(np.float64), vs, fl, threshold, limit, rules)
            hit = np.flatnonzero((reason > 0) & (row >= 0))
            out["row"].append(row[hit])
            out["value"].append(vs[hit])
            out["probability"].append(sure[hit])
            out["reason"] += [REASONS[x] for x in reason[hit]]
            out["field"] += [limit.name] * len(hit)
        row = np.concatenate(out["row"])
        if len(row):
            yield batches.batch(FLAGS, icao24=table.column("icao24").take(pa.array(row)).combine_chunks(), ts=t[row], field=out["field"], value=np.concatenate(out["value"]), reason=out["reason"], probability=np.concatenate(out["probability"]))

    return lambda incoming: batches.whole_groups(incoming, ("icao24", "block"), work)


def implausible(readings: DataFrame, rules: Rules, block_s: int = BLOCK_S) -> DataFrame:
    """Implausible readings: icao24, ts, field, value, reason (spike, stuck, impossible), probability.

    readings: icao24, ts, on_ground and the fields, as sources.tables.readings gives them; copies of
    one (icao24, ts) agree and count once. Null and NaN values are missing and never flagged, infinite
    ones are impossible; a null on_ground counts as on the ground, where values may repeat. A source with fewer than three
    readings has no course, hence no spikes. A reading that is both impossible and stuck is given as
    impossible. Empty tables give empty results; extra columns are ignored.

    Scale: one exchange of the readings by (source, block), used by both passes; a hot source is
    spread over its blocks. What is joined back is one row per block.
    """
    names = [f.name for f in rules.fields]
    rows = readings.select("icao24", F.floor(F.col("ts") / block_s).cast("long").alias("block"), "ts", "on_ground", *names)
    order = ("icao24", "block", "ts")
    laid = rows.repartition("icao24", "block")
    survey = laid.sortWithinPartitions(*order).mapInArrow(_survey(rules), EDGES_DDL)
    context = survey.repartition("icao24").sortWithinPartitions("icao24", "block").mapInArrow(_contexts(rules), CONTEXT_DDL)
    # the same exchange again; only a block's first reading carries the context into Python
    both = laid.join(context, ["icao24", "block"], "left")
    both = both.select("icao24", "block", "ts", "on_ground", *names, F.when(F.col("ts") == F.col("first_ts"), F.col("context")).alias("context"))
    return both.sortWithinPartitions(*order).mapInArrow(_judge(rules), FLAGS_DDL)
