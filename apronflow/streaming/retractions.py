"""Late corrections as a stream: the keyed, versioned state behind operators.late, one micro-batch at a time."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DELTAS_DDL = "icao24 string, period_s long, version long, at_s long, sign int, n long"
#: Records told already; those whose arrival second is still open, with it; the count given out last, if any, and its version.
STATE_DDL = "told array<string>, record array<string>, arrival array<long>, n long, given long, version long"


def _advance(period: int, grace: int, cutoff: int, memory: int):
    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        icao24, start = key[0], int(key[1])
        close, end = start + period + grace, start + period + cutoff
        now = state.getCurrentWatermarkMs() // 1000
        told, record, arrival, n, given, version = state.get if state.exists else ([], [], [], 0, None, 0)
        told, waiting = set(told), dict(zip(record, arrival, strict=True))
        if not state.hasTimedOut:
            for f in frames:
                for r, at in zip(f["record"].tolist(), f["arrival_s"].tolist(), strict=True):
                    if r not in told:
                        waiting[r] = min(at, waiting.get(r, at))
        # whatever arrived up to the watermark is complete, for later rows as old as that are not let in
        due = {r: at for r, at in waiting.items() if at <= now}
        steps = Counter(close if at <= close else at if at <= end else end + 1 for at in due.values())
        n += steps.pop(close, 0)
        out: list[tuple] = []
        if given is None and now >= close:
            given = n
            if given:
                out.append((version, close, 1, given))
        lost = steps.pop(end + 1, 0)
        for at in sorted(steps):
            version += 1
            out += [(version, at, -1, given), (version, at, 1, given + steps[at])]
            given += steps[at]
        if lost:
            out.append((None, end, 0, lost))
        if now >= end + memory:
            state.remove()
        else:
            open_ = {r: at for r, at in waiting.items() if r not in due}
            state.update(([*told, *due], list(open_), list(open_.values()), n, given, version))
            # a timer fires once the watermark is past it
            wanted = min([*open_.values(), end + memory, *([close] if given is None else [])])
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, wanted * 1000 - 1))
        if out:
            frame = pd.DataFrame([(icao24, start, *x) for x in out], columns=["icao24", "period_s", "version", "at_s", "sign", "n"])
            yield frame.astype({"version": "Int64"})

    return work


def deltas(records: DataFrame, period: int = 3600, grace: int = 300, cutoff: int = 21_600, lateness: str = "1 minute", memory: int = 86_400) -> DataFrame:
    """Signed deltas per icao24 and period: the rows that operators.late.changes gives for a whole table.

    records: icao24, record (a string that names it), event_s, arrival_s. The watermark follows arrival
    by lateness, in which a second's arrivals may still come in whatever order; then the second is
    complete and gives one version, however the batches cut it. A period is given out once that has
    passed its closing time. Sums of sign times n are the current counts at every moment. Dropped
    records are told as they come, so that their counts per period add up to those of the whole table.

    State: the names of a period's records, so that copies count once, kept for memory seconds after the
    cut-off; a copy that comes later still is told as dropped. With a lateness of 0 (for a replay that
    is one batch) nothing is left open at the end.
    """
    rows = records.withColumn("period_s", (F.floor(F.col("event_s") / period) * period).cast("long")).withColumn("arrival", F.timestamp_seconds("arrival_s"))
    rows = rows.withWatermark("arrival", lateness)
    return rows.groupBy("icao24", "period_s").applyInPandasWithState(_advance(period, grace, cutoff, memory), DELTAS_DDL, STATE_DDL, "update", GroupStateTimeout.EventTimeTimeout)
