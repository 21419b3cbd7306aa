"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings every entry point wants. None of them depends on the data's size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("apronflow").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Only where the session names none and runs in this one process (tests, the bench) a temporary
    folder is made, set, and deleted when the process ends; executors of a cluster would each see
    their own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="apronflow-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of this name below the shared one, for what a query writes and reads; deleted when the application ends."""
    where = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder; survives the loss of executors."""
    spark = df.sparkSession
    where = checkpoint_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def bench_cpus() -> str:
    return os.environ.get("BENCH_CPUS", "8")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, wherever the driver imported it from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    home = Path(__file__).resolve().parent
    where = tempfile.mkdtemp(prefix="apronflow-code-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    out = Path(where) / "apronflow.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, p.relative_to(home.parent).as_posix())
    context.addPyFile(str(out))
