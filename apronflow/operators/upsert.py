"""Upserts into Parquet tables: a target and a batch to the target that follows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def newest_wins(target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows by key, the target's unless the batch has a strictly newer version.

    One aggregation, no join: of equal versions the target's row stays, and within the batch the
    greatest row by its other columns. Rows with a null key do not enter. Both sides have the same columns.
    """
    rest = [c for c in target.columns if c not in keys]
    both = target.select("*", F.lit(1).alias("__held")).unionByName(batch.select(*target.columns, F.lit(0).alias("__held")))
    for k in keys:
        both = both.where(F.col(k).isNotNull())
    order = F.struct(F.col(version), F.col("__held"), *[F.col(c) for c in rest if c != version])
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.`{c}`").alias(c) for c in target.columns])


def overwrite(target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows by key; where the batch has the key its columns (all by default) replace the target's, nulls too.

    Columns not named keep the value the key was first seen with. The batch must have one row per key.
    """
    wanted = [c for c in target.columns if c not in keys and (columns is None or c in columns)]
    fresh = batch.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in target.columns if c not in keys], F.lit(True).alias("__fresh"))
    held = target.withColumn("__old", F.lit(True))
    both = held.join(fresh, list(keys), "full")

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        new = F.col(f"__new_{c}")
        take = F.col("__fresh").isNotNull() if c in wanted else F.col("__old").isNull()
        return F.when(take, new).otherwise(F.col(c)).alias(c)

    return both.select(*[pick(c) for c in target.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the last in order; max_by lets every task reduce its own rows first."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.`{c}`").alias(c) for c in df.columns])


def greatest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by the columns of order and then by the others.

    As latest_per_key where the order is of columns alone: one struct is both order and payload.
    """
    rest = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__best.`{c}`").alias(c) for c in df.columns])


def write_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Idempotent load: replaces only the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def write_clustered(df: DataFrame, path: str, by: str, *partitions: str) -> None:
    """Partitioned rewrite with rows of like `by` together, so that a scan skips files and row groups by their statistics."""
    keys = [*partitions, by]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def data_files(spark: SparkSession, path: str) -> int:
    """Parquet files below a path."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found, n = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True), 0
    while found.hasNext():
        n += found.next().getPath().getName().endswith(".parquet")
    return n


def compact(spark: SparkSession, path: str, by: str, *partitions: str) -> dict[str, int]:
    """Rewrites a table clustered by a column and swaps it in; gives rows, files_before and files_after.

    The table is complete at every moment but between the two renames; the version before is deleted
    only after the swap. Run it while nobody writes the table.
    """
    at = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path, before = path.rstrip("/"), data_files(spark, path)
    write_clustered(spark.read.parquet(path), f"{path}__next", by, *partitions)
    if not (fs.rename(at(path), at(f"{path}__last")) and fs.rename(at(f"{path}__next"), at(path))):
        raise OSError(f"{path} could not be swapped; its rows are in {path}__last")
    fs.delete(at(f"{path}__last"), True)
    return {"rows": spark.read.parquet(path).count(), "files_before": before, "files_after": data_files(spark, path)}
