"""Irregular readings onto a regular grid, holes filled by singular-spectrum imputation.

Readings are first reduced to one row per source and slot, then every slot from a source's first to
its last row is laid out in blocks of bounded length. In each block the series is embedded as a
Hankel trajectory matrix, its leading singular vectors, weighted against the noise, rebuild it, the
missing entries take the rebuilt values, and this repeats until they stay put. Filled slots are marked.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """A measurement on the grid.

    usable: which readings count. present: which rows make a slot one that isn't missing (default:
    usable ones). A slot that is present without a usable reading keeps a null, as a level of its own:
    `open_level` is its value for the model (an absent ceiling is a high one), and filled values at or
    over it become null again.
    """

    name: str
    usable: Column
    present: Column | None = None
    open_level: float | None = None
    log: bool = False


#: Windows and ranks that a series may be modelled with; a held-out trial on the series itself decides.
MODELS = ((12, 2), (24, 2), (48, 3))
#: Rounds of a trial, share of the known entries that it hides, and the known entries that it takes at least.
TRIAL_ROUNDS, TRIAL_SHARE, TRIAL_LEAST = 30, 0.1, 48
#: Rounds after which the vectors and their weights are held, which leaves a contraction.
HOLD = 20_000


def impute(series: np.ndarray, window: int | None = None, rank: int | None = None, tolerance: float = 1e-3) -> np.ndarray:
    """Missing entries (NaN) of a regular series by iterated truncated SVD of its trajectory matrix.

    With fewer than two known entries the only known value, or NaN, is everywhere. Known entries are
    never changed. Without a window and rank the ones of MODELS are taken that restore hidden entries
    of the series best, hidden in runs as long as its own holes.

    The leading vectors are not taken whole: each is weighted by the share of its variance that is
    above the noise, which is the mean variance of the vectors left out. Without that the fill follows
    the noise of the readings around a hole, and is worse than a straight line.

    The fill is iterated until it is estimated to lie within tolerance (of the series' standard
    deviation) of where it would stay put: a round's move times the geometric sum of such moves. Weights
    below one draw the fill in, so it comes to rest; should the vectors still turn after HOLD rounds,
    they are held, and what is left is a contraction that is carried on to the same tolerance.
    """
    known = np.isfinite(series)
    n, k = len(series), int(known.sum())
    if k == n:
        return series
    if k < 2:
        return np.where(known, series, series[known][0] if k else np.nan)
    at = np.arange(n)
    x = np.interp(at, at[known], series[known])
    mean, spread = x[known].mean(), x[known].std()
    if spread == 0 or n < 4:
        return x
    x = (x - mean) / spread
    if window is None or rank is None:
        window, rank = _model(x, known)
    _fill(x, ~known, window, rank, tolerance)
    return x * spread + mean


def _model(x: np.ndarray, known: np.ndarray) -> tuple[int, int]:
    """The model of MODELS with the least error on entries that are known and hidden; the same on every run."""
    there = np.flatnonzero(known)
    if len(there) < TRIAL_LEAST:
        return MODELS[1]
    edge = np.flatnonzero(np.diff(np.r_[False, ~known, False].astype(np.int8)))
    holes = edge[1::2] - edge[::2]
    draw = np.random.default_rng(len(x))
    hidden = np.zeros(len(x), bool)
    while hidden.sum() < TRIAL_SHARE * len(there):
        begin = int(draw.choice(there))
        hidden[begin : begin + min(int(draw.choice(holes)), len(there) // 4)] = True
        hidden &= known
    hidden[[there[0], there[-1]]] = False
    seen = known & ~hidden
    at = np.arange(len(x))
    start = np.interp(at, at[seen], x[seen])
    error = []
    for window, rank in MODELS:
        y = start.copy()
        _fill(y, ~seen, window, rank, 0.0, TRIAL_ROUNDS)
        error.append(np.square(y[hidden] - x[hidden]).sum())
    return MODELS[int(np.argmin(error))]


def _fill(x: np.ndarray, hole: np.ndarray, window: int, rank: int, tolerance: float, rounds: int | None = None) -> None:
    """Replaces x[hole] until it stays put, or for so many rounds."""
    n = len(x)
    window = max(2, min(window, n // 2))
    rank = min(rank, window - 1)
    counts = np.convolve(np.ones(n - window + 1), np.ones(window))
    before, calm, done = np.inf, 0, 0
    while rounds is None or done < rounds:
        track = np.lib.stride_tricks.sliding_window_view(x, window)
        if done <= HOLD:
            # the leading right singular vectors, from the small window x window product
            values, vectors = np.linalg.eigh(track.T @ track)
            lead, noise = vectors[:, window - rank :], max(values[: window - rank].mean(), 0.0)
            weight = np.clip(1 - noise / np.maximum(values[window - rank :], 1e-12), 0.0, 1 - 1e-6)
        scores = (track @ lead) * weight
        # averaging the anti-diagonals of scores @ lead.T is a sum of convolutions
        rebuilt = sum(np.convolve(scores[:, r], lead[:, r]) for r in range(rank)) / counts
        move = float(np.linalg.norm(rebuilt[hole] - x[hole]))
        x[hole] = rebuilt[hole]
        done += 1
        shrink = move / before if before > 0 else 0.0
        before = move
        # twice in a row, since the first estimates may come before the slowest direction shows
        calm = calm + 1 if move <= STILL or (shrink < 1 and move * shrink / (1 - shrink) < tolerance) else 0
        if rounds is None and calm > 1:
            return


#: A move, in standard deviations, below which the fill rests as far as doubles can tell.
STILL = 1e-10


def _block(fields: Sequence[tuple[str, bool, float | None, bool]], block: int, halo: int, slot_s: int, schema: pa.Schema):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # readings only in the halo of a block that is not in the source's span
            return schema.empty_table()
        source, number = left.column("source")[0], left.column("block")[0].as_py()
        lo, hi = left.column("lo")[0].as_py(), left.column("hi")[0].as_py()
        first, last = max(lo, number * block - halo), min(hi, (number + 1) * block - 1 + halo)
        n = last - first + 1
        at = np.asarray(right.column("slot").to_numpy(), np.int64) - first
        own = slice(max(lo, number * block) - first, min(hi, (number + 1) * block - 1) - first + 1)
        out = {"source": pa.array([source.as_py()] * (own.stop - own.start), pa.string()), "slot_ts": pa.array((np.arange(n)[own] + first) * slot_s)}
        for name, present_only, open_level, log in fields:
            series, present = np.full(n, np.nan), np.zeros(n, bool)
            value = np.asarray(right.column(name).to_numpy(), np.float64)
            there = np.isfinite(value)
            series[at[there]] = value[there]
            present[at] = np.asarray(right.column(f"{name}__present").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False), bool)
            unlimited = present & ~np.isfinite(series) if present_only else np.zeros(n, bool)
            if open_level is not None:
                series = np.minimum(np.where(unlimited, open_level, series), open_level)
            model = np.log1p(np.maximum(series, 0)) if log else series
            model = impute(model)
            filled = np.expm1(model) if log else model
            result = np.where(present, np.where(np.isfinite(value_at(n, at, value)), value_at(n, at, value), np.nan), np.round(filled, 1))
            if open_level is not None:
                result = np.where(~present & (result >= 0.95 * open_level), np.nan, result)
            out[name] = pa.array(result[own], from_pandas=True)
            out[f"{name}_filled"] = pa.array(~present[own])
        return pa.table(out, schema=schema)

    return work


def value_at(n: int, at: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = np.full(n, np.nan)
    out[at] = value
    return out


def regular(df: DataFrame, source: Column, at_s: Column, fields: Sequence[Field], slot_s: int = 3600, block: int = 720, halo: int = 168) -> DataFrame:
    """One row per source and slot from the source's first to its last row.

    Columns: source, slot_ts (start of the slot, epoch seconds), and per field its value and
    `<field>_filled`, true where the slot had no usable reading. A slot's value is the mean of its
    usable readings, to three decimals. Rows without source or time do not count.
    A field without any usable reading in reach stays null, and marked. An empty table gives an
    empty result; extra columns change nothing.

    Scale: rows are reduced to slots before the shuffle that lays out blocks, so a hot source sends
    its slots, not its rows; blocks of `block` slots with `halo` slots of context go to separate tasks.
    """
    slot = F.floor(at_s / slot_s).cast("long")
    aggs = []
    for f in fields:
        ok = F.coalesce(f.usable, F.lit(False))
        aggs.append(F.round(F.avg(F.when(ok, F.col(f.name).cast("double"))), 3).alias(f.name))
        aggs.append(F.max(F.coalesce(f.present, F.lit(False)) if f.present is not None else ok).alias(f"{f.name}__present"))
    hourly = df.where(source.isNotNull() & at_s.isNotNull()).groupBy(source.alias("source"), slot.alias("slot")).agg(*aggs)
    span = hourly.groupBy("source").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    blocks = span.select("source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / block).cast("long"), F.floor(F.col("hi") / block).cast("long"))).alias("block"))
    near = F.array_distinct(F.transform(F.array(F.col("slot") - halo, F.col("slot"), F.col("slot") + halo), lambda x: F.floor(x / block).cast("long")))
    spread = hourly.select("*", F.explode(near).alias("block"))
    schema = pa.schema([("source", pa.string()), ("slot_ts", pa.int64()), *[x for f in fields for x in ((f.name, pa.float64()), (f"{f.name}_filled", pa.bool_()))]])
    ddl = "source string, slot_ts long, " + ", ".join(f"`{f.name}` double, `{f.name}_filled` boolean" for f in fields)
    specs = [(f.name, f.present is not None, f.open_level, f.log) for f in fields]
    work = _block(specs, block, halo, slot_s, schema)
    # a block's work is far greater than its bytes tell, so its partitions are not merged by size
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = (x.repartition(width, "source", "block").groupBy("source", "block") for x in (blocks, spread))
    return left.cogroup(right).applyInArrow(work, ddl)
