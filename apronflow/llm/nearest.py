"""Records of two tables paired by the nearest time of the same entity, within a tolerance.

Each shard (entity and a span of time) of the looked-up side is a sorted array of distinct times. A
piecewise-linear model with a bounded error predicts where a wanted time belongs, and a search
within that error finds the neighbours exactly. Shards overlap by the tolerance, so every shard
answers its own times alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apronflow.operators import batches

#: Seconds of a shard: long enough for hundreds of keys of a station. Times are whole seconds and distinct, which bounds a shard's arrays.
SHARD_S = 28 * 86_400
#: Positions that the model may be off.
ERROR = 2


class LinearIndex:
    """A learned index over sorted distinct integers: segments of lines, each off by at most `error` positions.

    begins (default: the first key) names keys at which a line must begin anew, so that many shards can
    lie in one array. A stretch whose first and last key make a good enough line is one segment;
    only the others are fitted key by key.
    """

    def __init__(self, keys: np.ndarray, error: int = ERROR, begins: np.ndarray | None = None) -> None:
        self.keys, self.error = keys, error
        n = len(keys)
        begins = np.zeros(min(n, 1), np.int64) if begins is None else begins
        ends = np.append(begins[1:], n)
        first, slope = [begins], [np.zeros(len(begins))]
        if n:
            run = np.repeat(np.arange(len(begins)), ends - begins)
            width = (keys[ends - 1] - keys[begins]).astype(np.float64)
            slope[0] = np.divide(ends - 1 - begins, width, out=np.zeros(len(begins)), where=width > 0)
            off = np.abs(slope[0][run] * (keys - keys[begins][run]) - (np.arange(n) - begins[run]))
            bad = np.flatnonzero(np.maximum.reduceat(off, begins) > error)
            for i in bad:
                f, g = self._fit(int(begins[i]), int(ends[i]))
                slope[0][i] = g[0]
                first.append(f[1:])
                slope.append(g[1:])
        first, slope = np.concatenate(first), np.concatenate(slope)
        order = np.argsort(first, kind="stable")
        self.first, self.slope = first[order], slope[order]

    def _fit(self, at: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Segments of keys[at:stop], each the longest that one line fits: with every key the cone of slopes narrows."""
        first, slope = [], []
        while at < stop:
            low, high, end, step = 0.0, np.inf, at + 1, 64
            while end < stop:
                to = min(stop, end + step)
                dx, dy = (self.keys[end:to] - self.keys[at]).astype(np.float64), np.arange(end, to) - at
                lows, highs = np.maximum.accumulate(np.maximum((dy - self.error) / dx, low)), np.minimum.accumulate(np.minimum((dy + self.error) / dx, high))
                bad = np.flatnonzero(lows > highs)
                good = int(bad[0]) if len(bad) else to - end
                if good:
                    low, high = lows[good - 1], highs[good - 1]
                end += good
                if len(bad):
                    break
                step *= 2
            first.append(at)
            slope.append((low + high) / 2 if np.isfinite(high) else 0.0)
            at = end
        return np.asarray(first, np.int64), np.asarray(slope)

    def position(self, wanted: np.ndarray) -> np.ndarray:
        """For each wanted value the number of keys below it: predicted, then searched for within the error."""
        n = len(self.keys)
        if not n:
            return np.zeros(len(wanted), np.int64)
        begin = self.keys[self.first]
        segment = np.clip(np.searchsorted(begin, wanted, "right") - 1, 0, None)
        last = np.append(self.first[1:], n)[segment]
        base = self.first[segment]
        guess = base + np.rint(self.slope[segment] * (wanted - begin[segment]).astype(np.float64)).astype(np.int64)
        # a line is within error of every key of its segment, so of a value between two keys it is so or one more below;
        # beyond a segment's last key the value belongs at the next segment
        low = np.clip(guess - self.error, base, last)
        high = np.clip(guess + self.error + 1, base, last)
        low = np.where((low > base) & (self.keys[np.clip(low - 1, 0, n - 1)] >= wanted), base, low)
        high = np.where((high < last) & (self.keys[np.clip(high, 0, n - 1)] < wanted), last, high)
        self.width = float((high - low).mean()) if len(wanted) else 0.0  # positions left to the search, on the average
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high) // 2
            below = open_ & (self.keys[np.clip(middle, 0, n - 1)] < wanted)
            low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)

    def nearest(self, wanted: np.ndarray, tolerance: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest key of each wanted value, the lesser of two equally near, and whether it is in reach."""
        n = len(self.keys)
        if not n:
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = self.position(wanted)
        after, before = self.keys[np.clip(at, 0, n - 1)], self.keys[np.clip(at - 1, 0, n - 1)]
        take_before = (at >= n) | ((at > 0) & (wanted - before <= after - wanted))
        found = np.where(take_before, before, after)
        return found, np.abs(found - wanted) <= tolerance


ANSWER = pa.schema([("entity", pa.string()), ("wanted_s", pa.int64()), ("match_s", pa.int64())])
ANSWER_DDL = "entity string, wanted_s long, match_s long"


#: Width of a shard's place in an array of several; greater than any shard with its overlaps.
STRIDE = 1 << 40


def _answer(tolerance: int):
    def work(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        shard = np.zeros(table.num_rows, np.int64)
        shard[starts[1:]] = 1
        shard = np.cumsum(shard)
        time, known = batches.integers(table, "time_s"), batches.flags(table, "known")
        origin = time[starts][shard]
        place = shard * STRIDE + STRIDE // 2 + (time - origin)
        # distinct on either side, and a known time may stand in a shard twice only if the input repeats it
        keys = np.unique(place[known])
        begins = np.flatnonzero(np.r_[True, keys[1:] // STRIDE != keys[:-1] // STRIDE]) if len(keys) else np.zeros(0, np.int64)
        asked = np.flatnonzero(~known)
        found, reach = LinearIndex(keys, begins=begins).nearest(place[asked], tolerance)
        asked, found = asked[reach], found[reach]
        if len(asked):
            yield batches.batch(ANSWER, entity=table.column("entity").take(pa.array(asked)).combine_chunks(), wanted_s=time[asked], match_s=time[asked] + (found - place[asked]))

    return lambda incoming: batches.whole_groups(incoming, ("entity", "shard"), work)


def nearest_times(left: DataFrame, right: DataFrame, tolerance: int, shard_s: int = SHARD_S) -> DataFrame:
    """The nearest right time of each left row: left's columns and match_s; rows without one in reach are left out.

    left: entity, wanted_s and any others; right: entity, time_s. Times are whole epoch seconds. Of two
    equally near times the earlier is taken; a distance equal to the tolerance counts. Rows with a
    null entity or time match nothing. Repeated left rows stay repeated; empty tables give no rows.

    Scale: both sides are reduced to distinct (entity, time) before they meet, so an entity with a
    third of all rows gives at most shard_s left and shard_s + 2 * tolerance right times to any
    task, and its shards go to different tasks. The answers return to the rows by an equi-join.
    """
    wanted = left.where(F.col("entity").isNotNull() & F.col("wanted_s").isNotNull()).select("entity", "wanted_s").distinct()
    wanted = wanted.withColumn("shard", F.floor(F.col("wanted_s") / shard_s).cast("long"))
    known = right.where(F.col("entity").isNotNull() & F.col("time_s").isNotNull()).select("entity", "time_s").distinct()
    first, last = (F.floor((F.col("time_s") + d) / shard_s).cast("long") for d in (-tolerance, tolerance))
    known = known.withColumn("shard", F.explode(F.sequence(first, last)))
    both = wanted.select("entity", "shard", F.col("wanted_s").alias("time_s"), F.lit(False).alias("known")).unionByName(known.withColumn("known", F.lit(True)))
    laid = both.repartition("entity", "shard").sortWithinPartitions("entity", "shard")
    answers = laid.mapInArrow(_answer(tolerance), ANSWER_DDL)
    return left.join(answers, ["entity", "wanted_s"])
