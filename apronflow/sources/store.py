"""Tables that plans build once and read many times, in the shared folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from apronflow.session import scratch


def _state(spark: SparkSession, folder: str, inputs: Sequence[str]) -> str:
    """A digest of the input files' names, sizes and times, so that a table is built anew when they change."""
    jvm, told = spark.sparkContext._jvm, []
    for name in inputs:
        root = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.parquet")
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files = fs.listFiles(root, True)
        while files.hasNext():
            s = files.next()
            told.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(told)).encode()).hexdigest()[:16]


def stored(spark: SparkSession, folder: str, name: str, inputs: Sequence[str], build: Callable[[], DataFrame], write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """The table of this name over the inputs of folder: written by the first reader of the application, read by all.

    write puts the frame at a path (plain Parquet by default). A table without _SUCCESS is one whose
    writing broke off, and is written again.
    """
    path = scratch(spark, f"tables-{spark.sparkContext.applicationId}/{name}-{_state(spark, folder, inputs)}")
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        (write or (lambda df, at: df.write.mode("overwrite").parquet(at)))(build(), path)
    return spark.read.parquet(path)
