"""Items into containers of fixed capacity, with as little unused room as possible.

Items of equal size are alike, so the problem is solved on the histogram of sizes, which is no longer
than the capacity however many items there are. The solver is bin completion: it takes the largest
size left, enumerates fillings of the room beside it, least waste first and within the limits of
Search, applies one as often as the counts allow, and goes on; branches whose waste cannot beat the best solution so far
are pruned, and best-fit decreasing is the first solution to beat. The solution is a list of
patterns; every item finds its container by its rank among the items of its size. Where that stage
misses the lower bound, a complete search over all undominated fillings follows, within a budget.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apronflow.llm import tokens
from apronflow.session import cut_lineage

CAPACITY = 2048
#: Ranks are counted in so many groups per size, so that a size that many items share is ranked by many tasks.
SALTS = 256


@dataclass(frozen=True)
class Search:
    """How long the search goes on; where it stops, the best solution so far stands and no item is left out.

    First stage, for any number of items. fillings: alternatives per pattern; items: beside the
    largest, up to so many are enumerated by number, fewest first; nodes: patterns tried; steps: sizes
    looked at per pattern. Second stage, where the first has not reached the lower bound: every
    undominated filling of every container, one container at a time, until the tree is exhausted (the
    solution is then proven) or exact containers have been filled.
    """

    fillings: int = 4
    items: int = 4
    nodes: int = 4_000
    steps: int = 6_000
    exact: int = 20_000


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Containers that any packing needs: the best of the bounds that pair items over half the capacity with what fits beside them."""
    size = np.arange(len(counts))
    total = int((size * counts).sum())
    best = -(-total // capacity)
    room = capacity - size
    for k in range(0, capacity // 2 + 1):
        big, half, small = size > capacity - k, (size > capacity // 2) & (size <= capacity - k), (size >= max(k, 1)) & (size <= capacity // 2)
        spare = int((counts[half] * room[half]).sum())
        rest = int((counts[small] * size[small]).sum()) - spare
        best = max(best, int(counts[big].sum() + counts[half].sum()) + max(0, -(-rest // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on the histogram: patterns and how often each is used."""
    open_: list[dict[tuple[int, ...], int]] = [{} for _ in range(capacity + 1)]  # by room left: patterns so far
    held = np.zeros(capacity + 1, np.int64)

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        open_[room][pattern] = open_[room].get(pattern, 0) + times
        held[room] += times

    for s in range(len(counts) - 1, 0, -1):
        left, r = int(counts[s]), s
        while left:
            fit = np.flatnonzero(held[r:])
            if not len(fit):
                break
            r += int(fit[0])
            pattern, times = next(iter(open_[r].items()))
            take = min(left, times)
            held[r] -= take
            if take == times:
                del open_[r][pattern]
            else:
                open_[r][pattern] = times - take
            put(r - s, (*pattern, s), take)
            left -= take
        per = capacity // s
        full, part = divmod(left, per)
        if full:
            put(capacity - per * s, (s,) * per, full)
        if part:
            put(capacity - part * s, (s,) * part, 1)
    return [(pattern, times) for room in open_ for pattern, times in room.items()]


def fillings(counts: np.ndarray, room: int, search: Search) -> list[tuple[tuple[int, ...], int]]:
    """Fillings of room beside the largest item, least waste first: (sizes, waste).

    Of fillings with one sum those with fewer, larger items come first, as the finer ones are dominated;
    only the first found of each waste is given, and no more than search allows.
    """
    available = np.flatnonzero(counts[: room + 1])
    available = available[available > 0]
    if not len(available):
        return [((), room)]
    below = np.full(room + 1, 0, np.int64)  # the greatest available size at most x
    below[available] = available
    below = np.maximum.accumulate(below)
    fits, have = below.tolist(), counts[: room + 1].tolist()
    out: list[tuple[tuple[int, ...], int]] = []
    steps = search.steps
    smallest = int(available[0])

    def exact(target: int, top: int, depth: int, last: int, used: int) -> tuple[int, ...] | None:
        """The first set of at most depth items, none over top, that sums to target; used: items of size last taken already."""
        nonlocal steps
        s = fits[min(target, top)]
        while s and steps > 0:
            steps -= 1
            if s * depth < target:  # too small even if all are this large
                return None
            taken = used if s == last else 0
            if taken < have[s]:
                if s == target:
                    return (s,)
                if depth > 1 and target - s >= smallest and (more := exact(target - s, s, depth - 1, s, taken + 1)):
                    return (s, *more)
            s = fits[s - 1]
        return None

    for waste in range(room + 1):
        target = room - waste
        if target == 0:
            out.append(((), room))
            break
        for depth in (*range(1, search.items + 1), target // smallest):
            hit = exact(target, target, depth, 0, 0)
            if hit:
                out.append((hit, waste))
                if len(out) >= search.fillings:
                    return out
                if depth == 1:
                    return out  # one item of this size dominates every filling with as much waste or more
                break
        if steps <= 0:
            # what the enumeration has not reached: the largest that fits, again and again
            chosen, left, spare = [], room, counts.copy()
            s = fits[left]
            while s:
                if spare[s]:
                    spare[s] -= 1
                    chosen.append(s)
                    left -= s
                    s = fits[min(left, s)] if left else 0
                else:
                    s = fits[s - 1]
            out.append((tuple(chosen), left))
            break
    return sorted(out, key=lambda x: x[1])


def maximal(counts: np.ndarray, room: int) -> Iterator[tuple[int, ...]]:
    """All fillings of room that nothing left over fits into besides: those not dominated by a larger set. Large items first."""
    kinds = np.flatnonzero(counts[: room + 1])
    kinds = kinds[kinds > 0][::-1].tolist()
    have = [int(counts[s]) for s in kinds]

    rest = np.append(np.cumsum([s * n for s, n in zip(kinds, have, strict=True)][::-1])[::-1], 0).tolist()  # what all items from here on would fill

    def go(i: int, left: int, chosen: tuple[int, ...], spared: int) -> Iterator[tuple[int, ...]]:
        """spared: the smallest size of which some were left out although they fit; in the end it must not fit."""
        for j in range(i, len(kinds)):
            if left - rest[j] >= spared:
                return
            s = kinds[j]
            if s <= left:
                for k in range(min(have[j], left // s), 0, -1):
                    yield from go(j + 1, left - k * s, chosen + (s,) * k, min(spared, s) if k < have[j] else spared)
                spared = min(spared, s)
        if spared > left:
            yield chosen

    yield from go(0, room, (), room + 1)


def exhaust(counts: np.ndarray, capacity: int, best: list[tuple[tuple[int, ...], int]], goal: int, containers: int) -> tuple[list[tuple[tuple[int, ...], int]], bool]:
    """Complete branch and bound: the best solution and whether it is proven.

    The largest item left goes into the next container; some best solution fills that with an
    undominated set, since items can always move into room that is left. A state that was reached with
    as few containers before, or that needs too many by its sizes or by its items over half the
    capacity, is left.
    """
    counts = counts.astype(np.int64).copy()
    size = np.arange(len(counts))
    limit, tried = sum(times for _, times in best), 0
    path: list[tuple[int, ...]] = []
    seen: dict[bytes, int] = {}

    def options() -> Iterator[tuple[int, ...]]:
        left = np.flatnonzero(counts)
        total = int((size * counts).sum())
        bound = max(-(-total // capacity), int(counts[capacity // 2 + 1 :].sum()))
        state = hashlib.blake2b(counts.tobytes(), digest_size=16).digest()
        if len(path) + bound >= limit or seen.get(state, limit) <= len(path):
            return iter(())
        seen[state] = len(path)
        s = int(left[-1])
        spare = counts.copy()
        spare[s] -= 1
        return ((s, *f) for f in maximal(spare, capacity - s))

    counts[0] = 0
    stack = [options()] if counts.any() else []
    while stack:
        if limit <= goal:
            return best, True
        pattern = next(stack[-1], None)
        if pattern is None:
            stack.pop()
            if path:
                np.add.at(counts, list(path.pop()), 1)
            continue
        tried += 1
        if tried > containers:
            return best, False
        np.subtract.at(counts, list(pattern), 1)
        path.append(pattern)
        if not counts.any():
            if len(path) < limit:
                best, limit = [(p, 1) for p in path], len(path)
            np.add.at(counts, list(path.pop()), 1)
        else:
            stack.append(options())
    return best, True


def complete(counts: np.ndarray, capacity: int, search: Search = Search()) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used: bin completion by depth-first branch and bound.

    counts[s] items of each size s <= capacity. Ends at the lower bound; else with the proven best
    solution if the second stage ends within search.exact containers; else with the best one found.
    Every item is in some pattern in any case.
    """
    return solve(counts, capacity, search)[0]


def solve(counts: np.ndarray, capacity: int, search: Search = Search()) -> tuple[list[tuple[tuple[int, ...], int]], bool]:
    """complete, and whether its solution is proven to be the best."""
    best, goal = _first(counts, capacity, search), lower_bound(counts, capacity)
    used = sum(times for _, times in best)
    if used <= goal or used > search.exact:  # more containers than the budget: not even one branch would come to its end
        return best, used <= goal
    return exhaust(counts, capacity, best, goal, search.exact)


def _first(counts: np.ndarray, capacity: int, search: Search) -> list[tuple[tuple[int, ...], int]]:
    """The first stage: patterns are applied as often as the counts allow, which suits many like items."""
    counts = counts.astype(np.int64).copy()
    size = np.arange(len(counts))
    goal = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    limit = sum(times for _, times in best)
    path: list[tuple[tuple[int, ...], int]] = []
    stack: list[list[tuple[int, ...]]] = []
    used, nodes = 0, 0
    total = int((size * counts).sum())

    def take(pattern: tuple[int, ...]) -> int:
        nonlocal used, total
        need = np.bincount(pattern, minlength=len(counts))
        kinds = np.flatnonzero(need)
        times = int((counts[kinds] // need[kinds]).min())
        counts[kinds] -= times * need[kinds]
        path.append((pattern, times))
        used += times
        total -= times * sum(pattern)
        return times

    def back() -> None:
        nonlocal used, total
        pattern, times = path.pop()
        np.add.at(counts, list(pattern), times)
        used -= times
        total += times * sum(pattern)

    while True:
        nodes += 1
        left = np.flatnonzero(counts)
        left = left[left > 0]
        dead = used + -(-total // capacity) >= limit
        if not len(left):
            if used < limit:
                best, limit = list(path), used
            dead = True
        if limit <= goal or nodes > search.nodes:
            break
        if not dead:
            s = int(left[-1])
            counts[s] -= 1
            options = [(s, *f) for f, _ in fillings(counts, capacity - s, search)]
            counts[s] += 1
            stack.append(options[1:])
            take(options[0])
            continue
        while stack and not stack[-1]:
            stack.pop()
            back()
        if not stack:
            break
        back()
        take(stack[-1].pop(0))
    return best


def assignment(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray], int]:
    """For each size the first ranks, base containers and items per container of its ranges, and the number of containers."""
    starts, bases, per = ([[] for _ in range(capacity + 1)] for _ in range(3))
    seen, container = np.zeros(capacity + 1, np.int64), 0
    for pattern, times in patterns:
        for s in set(pattern):
            k = pattern.count(s)
            starts[s].append(seen[s])
            bases[s].append(container)
            per[s].append(k)
            seen[s] += k * times
        container += times
    as_array = lambda x: [np.asarray(v, np.int64) for v in x]
    return as_array(starts), as_array(bases), as_array(per), container


PACKED_DDL = "first long, tokens long, container long, piece long"


def packed(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, search: Search = Search()) -> DataFrame:
    """The container of every item: key, piece, first, tokens, container.

    sizes: key and n. Items with a null or non-positive n take no room and have no container. An item
    over the capacity fills containers of its own and its rest is an item like the others (pieces 0,
    1, ... from token `first` on); no other item is split. Repeated rows are items of their own; a null
    key is packed as any other. An empty table gives no rows.

    Scale: sizes are written once to the shared checkpoint folder; the driver sees only the histogram
    (capacity numbers), and ranks are counted in SALTS groups per size.
    """
    kind = dict(sizes.dtypes)[key]
    items = sizes.where(F.col("n") > 0).select(key, F.col("n").cast("long").alias("n"))
    items = items.withColumn("full", F.floor(F.col("n") / capacity)).withColumn("rest", (F.col("n") % capacity).cast("int"))
    # told once and then written, so it needs no meaning; rows of one key, null ones say, are spread too
    items = cut_lineage(items.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")))
    groups = items.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("items"), F.sum("full").alias("fulls"))
    groups = cut_lineage(groups)
    counts = np.zeros(capacity + 1, np.int64)
    for r in groups.groupBy("rest").agg(F.sum("items").alias("items")).collect():
        counts[r["rest"]] = r["items"]
    counts[0] = 0
    plan = assignment(complete(counts, capacity, search), capacity)
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # at most capacity * SALTS rows, so their running sum is no bottleneck
    along = Window.orderBy("rest", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("rest", "salt", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("skip"), F.coalesce(F.sum("fulls").over(along), F.lit(0)).alias("skip_full"))
    own = Window.partitionBy("rest", "salt").orderBy(key, "n")
    ranked = items.withColumn("rank", F.row_number().over(own) - 1).withColumn("fulls", F.coalesce(F.sum("full").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranked.join(offsets, ["rest", "salt"]).select(key, "full", "rest", (F.col("rank") + F.col("skip")).alias("rank"), (F.col("fulls") + F.col("skip_full")).alias("fulls"))
    rest = ranked.where(F.col("rest") > 0).mapInArrow(_placer(plan, key, capacity), f"`{key}` {kind}, piece long, first long, tokens long, container long")
    whole = ranked.where(F.col("full") > 0).select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("full").cast("long") - 1)).alias("piece"), "fulls")
    whole = whole.select(key, "piece", (F.col("piece") * capacity).alias("first"), F.lit(capacity).cast("long").alias("tokens"), (F.lit(plan[3]) + F.col("fulls") + F.col("piece")).cast("long").alias("container"))
    return rest.unionByName(whole)


def _placer(plan: tuple, key: str, capacity: int):
    starts, bases, per, _ = plan

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rest, rank, full = (np.asarray(b.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("rest", "rank", "full"))
            container = np.zeros(len(rest), np.int64)
            for s in np.unique(rest):
                own = rest == s
                at = np.searchsorted(starts[s], rank[own], "right") - 1
                container[own] = bases[s][at] + (rank[own] - starts[s][at]) // per[s][at]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(full), pa.array(full * capacity), pa.array(rest), pa.array(container)], names=[key, "piece", "first", "tokens", "container"])

    return work


def _counter(path: str, key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, "text"):
            n = [len(x) for x in tokens.encode(b.column("text").to_pylist(), path)]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(n, pa.int32())], names=[key, "n"])

    return work


def token_sizes(documents: DataFrame, key: str = "doc_id", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """key and n, the text's length in tokens; 0 for null and empty texts."""
    path = f"{tokens.folder(documents.sparkSession)}/{vocabulary}"
    return documents.select(key, "text").mapInArrow(_counter(path, key), f"`{key}` {dict(documents.dtypes)[key]}, n int")
