"""One row of each key: copies of messages, versions of records.

Spark's hash aggregation holds numbers in its buffers, but no structs and no texts; an aggregation
with those sorts whole rows before and after the shuffle. So an order of several columns is packed
into one number here, and rows are carried in one of two ways: column by column through the
aggregation (one_per_key, for keys with many rows), or by their order alone and then fetched by a
semi-join (keep_one, for keys with few).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that a hash aggregation holds in its buffer.
FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
DIGITS = 38


def packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers as one decimal that orders as the struct of them does: by the first, then the second, and so on.

    Each part comes with its digits, 38 in all; a part of d digits lies within half of 10**d on either
    side of 0, and what lies beyond counts as the end of that range. Nulls come first.
    """
    if sum(d for _, d in parts) > DIGITS:
        raise ValueError(f"at most {DIGITS} digits can be packed")
    number = lambda x: F.lit(str(x)).cast(f"decimal({DIGITS},0)")
    out = None
    for c, d in parts:
        shifted = c.cast(f"decimal({DIGITS},0)") + number(10**d // 2)
        value = F.coalesce(F.least(F.greatest(shifted, number(1)), number(10**d - 1)), number(0)).cast(f"decimal({d},0)")
        out = value if out is None else (out * F.lit(str(10**d)).cast(f"decimal({d + 1},0)") + value)
    return out.cast(f"decimal({DIGITS},0)")


def fingerprint(*columns: str) -> tuple[Column, int]:
    """A part for packed that breaks ties between rows of different content the same way on every run."""
    return F.xxhash64(*columns), 20


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names with so many underscores before them that df has no such column."""
    out = []
    for n in names:
        while n in df.columns:
            n = f"_{n}"
        out.append(n)
    return out


def one_per_key(df: DataFrame, keys: Sequence[str], order: Column, least: bool = False) -> DataFrame:
    """One row of each key, the greatest (or least) in order: a number or time that is never null; see packed.

    One hash aggregation carries the row along, so each task first reduces its own rows and a hot key
    sends one row per task through the shuffle. A column that has no fixed width (a text, say) is
    carried as two hashes, 96 bits, and looked up afterwards among the distinct values of that column alone.

    order must tell rows of different content apart (end it with a unique column or a fingerprint);
    then equal rows are all that can tie. Null keys are a key of their own.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in keys]
    texts = [c for c in rest if kinds[c] not in FIXED and not kinds[c].startswith("decimal")]
    by, value, *more = spare(df, "__order", "__value", *[f"__{side}{i}" for i in range(len(texts)) for side in ("own", "told")])
    second = dict(zip(texts, more[::2], strict=True))
    there = lambda c, h: F.when(F.col(c).isNotNull(), h(c))
    rows = df.select(*keys, *[(there(c, F.xxhash64) if c in texts else F.col(c)).alias(c) for c in rest], *[there(c, F.hash).alias(n) for c, n in second.items()], order.alias(by))
    pick = F.min_by if least else F.max_by
    best = rows.groupBy(*keys).agg(*[pick(c, by).alias(c) for c in (*rest, *second.values())], F.count(F.lit(1)).alias(by))
    for c, told in zip(texts, more[1::2], strict=True):
        values = df.where(F.col(c).isNotNull()).select(F.xxhash64(c).alias(told), F.hash(c).alias(f"{told}_2"), F.col(c).alias(value)).distinct()
        best = best.join(values, (F.col(c) == F.col(told)) & (F.col(second[c]) == F.col(f"{told}_2")), "left").withColumn(c, F.col(value)).drop(told, f"{told}_2", value)
    return best.select(*df.columns)


def _known(identifier: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in identifier:
        known = known & F.col(c).isNotNull()
    return known


def _survivors(rows: DataFrame, identifier: Sequence[str], by: str) -> DataFrame:
    """Each identifier with the order of the row that remains and its number of rows, by a hash aggregation of narrow rows."""
    return rows.groupBy(*identifier).agg(F.min_by(by, by).alias("__kept"), F.count(F.lit(1)).alias("__rows"))


def keep_one(df: DataFrame, identifier: Sequence[str], order: Sequence[tuple[Column, int]] | str, unique: bool = False, nulls: bool = True) -> DataFrame:
    """One row of each identifier: the one with the least order, the name of a bigint column or parts for packed.

    min_by over the (packed) struct of the order, in a hash aggregation of identifiers and orders only:
    each task first reduces its own copies. The rows themselves are then fetched by a semi-join whose
    hash table holds one narrow row per identifier; the rows pass it unsorted, and adaptive execution
    splits them where an identifier is hot.

    order must tell rows of different content apart: a unique column, or parts that end with one or
    with a fingerprint. Rows that are equal in all columns give one; where the caller knows that there
    are none, unique saves looking for them. Nulls: an identifier with a null part names no message,
    so such rows all stay, and nulls=False says that there are none; a null in the order comes first.
    An empty table gives an empty one. Extra columns are carried along under their own names.
    """
    by, *own = spare(df, "__by", *[f"__{i}" for i in range(len(identifier))])
    rows = df.where(_known(identifier)).withColumn(by, F.coalesce(F.col(order), F.lit(-(2**63))) if isinstance(order, str) else packed(*order))
    kept = _survivors(rows.select(*identifier, by), identifier, by)
    kept = kept.select(*[F.col(c).alias(n) for c, n in zip(identifier, own, strict=True)], F.col("__kept").alias(f"{by}_kept"))
    on = F.col(by) <= F.col(f"{by}_kept")
    for c, n in zip(identifier, own, strict=True):
        on = on & (F.col(c) == F.col(n))
    out = rows.join(kept.hint("shuffle_hash"), on, "left_semi").drop(by)
    out = out if unique else out.distinct()
    return out.unionByName(df.where(~_known(identifier))) if nulls else out


def dropped_copies(df: DataFrame, identifier: Sequence[str], row_id: str, order: Sequence[tuple[Column, int]] | None = None) -> DataFrame:
    """The row ids of every copy but the one that remains: the one with the least order, by default the least row id.

    The hash aggregation of keep_one names the survivor of each identifier; only identifiers with more
    than one row go on, and their copies are found by an equi-join, which adaptive execution splits
    where one identifier is hot. No list of copies is ever collected. Without an order the row id is
    all of the struct that min_by compares: it is unique, so nothing behind it could decide.
    Row ids are unique; an order must end with a unique column.
    """
    known, by = [f"__{i}" for i in range(len(identifier))], "__order" if order else "__row"
    ordered = [packed(*order).alias(by)] if order else []
    rows = df.where(_known(identifier)).select(*[F.col(c).alias(n) for c, n in zip(identifier, known, strict=True)], F.col(row_id).alias("__row"), *ordered)
    twice = _survivors(rows, known, by).where(F.col("__rows") > 1).drop("__rows")
    return rows.join(twice.hint("shuffle_hash"), known).where(F.col(by) > F.col("__kept")).select(F.col("__row").alias(row_id))
