"""A keyed Parquet table for streams: buckets of keys, of which an upsert rewrites only those that its batch touches."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "__bucket"


class KeyedTable:
    """Upserts by micro-batch into hash buckets of the key.

    Each upsert writes the touched buckets anew under the next version and then, by one rename, a
    manifest that names the version of every bucket. What is not in a manifest does not exist for
    readers, so a broken write leaves nothing behind but files that the next upsert overwrites. The
    two newest manifests and their files are kept, so that a reader of the one before is not cut off.

    merge must be idempotent (newest_wins and overwrite are): batches are merged whenever they come,
    whatever their number, so a batch given again after a failure changes nothing and the batches of a
    fresh checkpoint, which count from 0 again, are kept. One query writes a table at a time. The
    number of buckets is fixed by the first upsert; take so many that one bucket fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.merge, self.buckets = spark, path.rstrip("/"), schema, list(keys), merge, buckets
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str, pattern: str) -> list[int]:
        if not self._fs.exists(self._at(folder)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(pattern, n)))

    def versions(self) -> list[int]:
        return self._names("manifests", r"(\d+)\.json")

    def manifest(self, version: int | None = None) -> dict:
        """version, buckets, and held: by bucket the version that wrote it last."""
        have = self.versions()
        version = version if version is not None else (have[-1] if have else 0)
        if version not in have:
            return {"version": 0, "buckets": self.buckets, "held": {}}
        with_stream = self._fs.open(self._at(f"manifests/{version}.json"))
        try:
            return json.loads(bytes(with_stream.readAllBytes()).decode())
        finally:
            with_stream.close()

    def _load(self, manifest: dict, buckets: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/data/v={manifest['held'][b]}/{BUCKET}={b}" for b in buckets if b in manifest["held"]]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, by default the newest; empty before the first."""
        manifest = self.manifest(version)
        return self._load(manifest, list(manifest["held"]))

    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int")

    def upsert(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Merges the batch; batch_id, which foreachBatch gives, is not looked at."""
        manifest = self.manifest()
        bucket, version = self._bucket(manifest["buckets"]), manifest["version"] + 1
        for k in self.keys:
            batch = batch.where(F.col(k).isNotNull())
        batch = batch.persist()  # a stream's batch is read twice: for its buckets, which are few, and for its rows
        try:
            touched = [str(r[0]) for r in batch.select(bucket).distinct().collect()]
            if not touched:
                return
            merged = self.merge(self._load(manifest, touched), batch).withColumn(BUCKET, bucket)
            merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/v={version}")
        finally:
            batch.unpersist()
        self._publish({"version": version, "buckets": manifest["buckets"], "held": manifest["held"] | {b: version for b in touched}})
        self._forget()

    def _publish(self, manifest: dict) -> None:
        draft, final = self._at(f"manifests/_{manifest['version']}"), self._at(f"manifests/{manifest['version']}.json")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise OSError(f"{self.path}: version {manifest['version']} has been written by someone else")

    def _forget(self) -> None:
        """Deletes manifests but the two newest, and the buckets that neither of these names."""
        *old, _, _ = [0, 0, *self.versions()]
        kept = {(b, v) for m in self.versions()[-2:] for b, v in self.manifest(m)["held"].items()}
        for v in old:
            if v:
                self._fs.delete(self._at(f"manifests/{v}.json"), False)
        for v in self._names("data", r"v=(\d+)"):
            have = self._names(f"data/v={v}", rf"{BUCKET}=(\d+)")
            for b in have:
                if (str(b), v) not in kept:
                    self._fs.delete(self._at(f"data/v={v}/{BUCKET}={b}"), True)
            if not any((str(b), v) in kept for b in have):
                self._fs.delete(self._at(f"data/v={v}"), True)
