"""Overlapping and gapped intervals: continuous periods per entity and the gaps between them.

The aggregate of an entity and time shard is a sorted list of disjoint intervals. Two such lists
combine by one linear merge, so the aggregate is associative and commutative: tasks first reduce
their own rows, and a tree of exchanges with a bounded fan-in combines the partial lists. Shards are
told by an interval's start; an interval that reaches into later shards needs no copies, because the
shards of an entity are finally chained by the running maximum of their ends, one number per shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from apronflow.operators import batches
from apronflow.session import cut_lineage

#: Seconds of a shard: a list holds at most half as many disjoint intervals as its shard has seconds.
SHARD_S = 7 * 86_400
#: Partial lists that one node of the tree combines, and levels of the tree. Tasks beyond FAN_IN ** LEVELS share leaves.
FAN_IN, LEVELS = 64, 2

LISTS = pa.schema([("entity", pa.string()), ("shard", pa.int64()), ("node", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
LISTS_DDL = "entity string, shard long, node long, starts array<long>, ends array<long>"


def merge(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The union of two sorted disjoint lists; touching intervals become one.

    Both inputs are sorted, so the stable sort is one linear merge of two runs.
    """
    starts, ends = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), dtype=bool)
    first[1:] = starts[1:] > reach[:-1]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)
    return starts[first], reach[last]


def _tree(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    while len(parts) > 1:
        parts = [merge(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _reduce_rows(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's own rows to one list per entity and shard; held lists are merged batch by batch."""
    held: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    node = -1
    for b in incoming:
        if not b.num_rows:
            continue
        node = b.column("node")[0].as_py() if node < 0 else node
        entity = b.column("entity").dictionary_encode()
        code, names = entity.indices.to_numpy(zero_copy_only=False), entity.dictionary.to_pylist()
        shard, s, e = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "s", "e"))
        order = np.lexsort((s, shard, code))
        code, shard, s, e = code[order], shard[order], s[order], e[order]
        cuts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (shard[1:] != shard[:-1])])
        for i, j in zip(cuts, np.append(cuts[1:], len(code)), strict=True):
            key, empty = (names[code[i]], int(shard[i])), np.zeros(0, np.int64)
            held[key] = merge(held.get(key, (empty, empty)), (s[i:j], e[i:j]))
        if len(held) >= 20_000:
            yield _lists(held, node)
            held = {}
    if held:
        yield _lists(held, node)


def _lists(held: dict, node: int) -> pa.RecordBatch:
    keys = list(held)
    return batches.batch(LISTS, entity=[k[0] for k in keys], shard=[k[1] for k in keys], node=[node] * len(keys), starts=[held[k][0] for k in keys], ends=[held[k][1] for k in keys])


def _combine(fan: int):
    def work(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        entity, shard, node = (table.column(c).to_pylist() for c in ("entity", "shard", "node"))
        starts, ends = table.column("starts").combine_chunks(), table.column("ends").combine_chunks()
        starts, ends = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (starts, ends))
        rows: dict[str, list] = {f.name: [] for f in LISTS}
        for i, j in zip(cuts, np.append(cuts[1:], table.num_rows), strict=True):
            s, e = _tree([(np.asarray(starts[k].values), np.asarray(ends[k].values)) for k in range(i, j)])
            for name, value in zip(rows, (entity[i], shard[i], node[i] // fan, s, e), strict=True):
                rows[name].append(value)
        yield batches.batch(LISTS, **rows)

    return lambda incoming: batches.whole_groups(incoming, ("entity", "shard", "parent"), work, rows=1024)


def disjoint(df: DataFrame, entity: str, start: str, end: str, shard_s: int = SHARD_S, fan_in: int = FAN_IN) -> DataFrame:
    """One list per entity and shard: entity, shard, starts, ends (sorted, disjoint, in start order).

    start and end are longs. Rows with a null entity, start or end, or whose end is not after the
    start, do not count.
    """
    rows = df.select(F.col(entity).cast("string").alias("entity"), F.col(start).alias("s"), F.col(end).alias("e"))
    rows = rows.where(F.col("entity").isNotNull() & (F.col("e") > F.col("s")))
    leaf = F.pmod(F.spark_partition_id(), F.lit(fan_in**LEVELS)).cast("long")
    rows = rows.withColumn("shard", F.floor(F.col("s") / shard_s)).withColumn("node", leaf)
    lists = rows.select("entity", F.col("shard").cast("long").alias("shard"), "node", "s", "e").mapInArrow(_reduce_rows, LISTS_DDL)
    for _ in range(LEVELS):
        lists = lists.withColumn("parent", F.floor(F.col("node") / fan_in))
        lists = lists.repartition("entity", "shard", "parent").sortWithinPartitions("entity", "shard", "parent").mapInArrow(_combine(fan_in), LISTS_DDL)
    return lists.select("entity", "shard", "starts", "ends")


def periods_and_gaps(df: DataFrame, entity: str, start: str, end: str, max_gap: int | None = None, shard_s: int = SHARD_S) -> DataFrame:
    """Continuous periods of each entity and the gaps between consecutive ones.

    Columns: entity, kind (`period` or `gap`), start_s, end_s. An interval that starts when another
    ends continues it. Gaps longer than max_gap are left out. Repeated rows change nothing; an empty
    table gives an empty result; extra columns are ignored.
    """
    # written once, as it is read for its ends, its pieces and their number; what goes through an entity's window is one narrow row per shard
    lists = cut_lineage(disjoint(df, entity, start, end, shard_s))
    before = Window.partitionBy("entity").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ends = lists.select("entity", "shard", F.array_max("ends").alias("end")).withColumn("reach", F.max("end").over(before)).drop("end")
    # what the earlier shards cover is swallowed; of the rest only a shard's first piece can continue an earlier period
    zipped = F.filter(F.arrays_zip("starts", "ends"), lambda x: F.col("reach").isNull() | (x["ends"] > F.col("reach")))
    shards = lists.join(ends, ["entity", "shard"]).select("entity", "shard", "reach", zipped.alias("pieces"))
    joined = F.coalesce(F.get("pieces", F.lit(0))["starts"] <= F.col("reach"), F.lit(False))
    shards = shards.withColumn("joined", F.when(joined, 1).otherwise(0))
    new = shards.select("entity", "shard", (F.size("pieces") - F.col("joined")).alias("new"))
    offsets = new.withColumn("offset", F.coalesce(F.sum("new").over(before), F.lit(0))).drop("new")
    shards = shards.join(offsets, ["entity", "shard"])
    # periods are numbered along the shards, so a period finds the next one by its number instead of by sorting an entity's periods
    pieces = shards.select("entity", "offset", "joined", F.posexplode("pieces").alias("at", "p"))
    run = F.col("offset") + F.col("at") - F.col("joined")
    begins = (F.col("at") > 0) | (F.col("joined") == 0)
    own = F.struct(run.alias("run"), F.col("p.starts").alias("s"), F.col("p.ends").alias("e"), F.lit(None).cast("long").alias("next_s"))
    ahead = F.struct((run - 1).alias("run"), F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("e"), F.col("p.starts").alias("next_s"))
    told = pieces.select("entity", F.explode(F.when(begins, F.array(own, ahead)).otherwise(F.array(own))).alias("x"))
    both = told.groupBy("entity", "x.run").agg(F.min("x.s").alias("start_s"), F.max("x.e").alias("end_s"), F.min("x.next_s").alias("next_s")).where(F.col("start_s").isNotNull())
    period = F.struct(F.lit("period").alias("kind"), F.col("start_s"), F.col("end_s"))
    gap = F.struct(F.lit("gap").alias("kind"), F.col("end_s").alias("start_s"), F.col("next_s").alias("end_s"))
    wanted = F.col("next_s").isNotNull() if max_gap is None else F.col("next_s").isNotNull() & (F.col("next_s") - F.col("end_s") <= max_gap)
    return both.select("entity", F.explode(F.when(wanted, F.array(period, gap)).otherwise(F.array(period))).alias("x")).select("entity", "x.kind", "x.start_s", "x.end_s")
