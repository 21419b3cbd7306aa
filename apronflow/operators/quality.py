"""Data-quality checks: each gives the rows, keys or levels that a check is about."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row: keys and n."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def outside(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values that are not accepted, and how often: value, n. Null is not a value."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted)).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def failing(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that fail each check (false or null): check, n. One pass over the table for all checks."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), F.col(name).alias("n")) for name in checks])
    return counts.select(F.explode(pairs).alias("x")).select("x.check", "x.n")


def freshness(df: DataFrame, ts: str, as_of: Column, warn_s: int, error_s: int) -> DataFrame:
    """Age of the newest row and its level: `pass`, `warn` or `error`; an empty table is an error."""
    age = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max(ts).cast("timestamp"))
    level = F.when(F.col("age_s").isNull() | (F.col("age_s") > error_s), "error").when(F.col("age_s") > warn_s, "warn").otherwise("pass")
    return df.agg(age.alias("age_s")).withColumn("level", level)
