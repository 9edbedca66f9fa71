"""Where jobs put tables that they read again."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the session names for checkpoints, which driver and executors share. Only a session without executors
    of its own may go without one; its folders go with the process."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="scratch-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: The folders of the tables that the open `passing` blocks of a thread have staged, block by block.
_OPEN = threading.local()
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession, more: dict[str, str] | None = None) -> Iterator[None]:
    """Within the block, a query's shuffle files go as soon as it ends, not when the driver happens to collect its garbage. `more`: further settings that hold within it."""
    asked = {_FREED: "true"} | (more or {})
    before = {k: spark.conf.get(k) for k in asked}
    for k, v in asked.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged within the block are deleted at its end. One that is staged as `lasting` belongs to the block around it, and stays if there is none: what
    a block hands on is staged so, and nothing else may be read after it."""
    blocks = _OPEN.__dict__.setdefault("blocks", [])
    blocks.append([])
    try:
        yield
    finally:
        for path in blocks.pop():
            delete(spark, path)


def staged(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """A step's result, written down and read back. What follows starts from a scan: the plan is as short as one step's, the file sizes tell the optimiser
    which joins may broadcast, and a lost executor costs the tasks of one step. The step's shuffle files go at once. The folder stays until the `passing` block that it
    belongs to ends; without one, for as long as the result may be read, and whoever owns the checkpoint folder clears it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    blocks = _OPEN.__dict__.get("blocks", [])[: -1 if lasting else None]
    if blocks:
        blocks[-1].append(path)
    with freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over tasks, for steps that take long over each row: a file of one row group is one task otherwise, however many rows it has."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism))


class Buckets:
    """Rows by key, in `count` buckets by a hash of the key; a batch reads and writes only the buckets that its keys fall into.

    A version writes the touched buckets anew, whole, below `data/version=v`, and then a manifest that names the newest version of every bucket. A version that
    runs again reads what stood before it and overwrites its own folder, so a restart at any point neither loses nor doubles rows. Older versions are never
    changed. One writer at a time; versions rise. Choose `count` so that a bucket is a few hundred MB; it can't be changed later. Rows that replace others are dealt to a task for
    each bucket and PART rows of them, so no task sorts more on its disk, however large a bucket grows."""

    PART = 500_000

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], count: int = 64) -> None:
        self.spark, self.path, self.schema, self.keys, self.count = spark, path, schema, keys, count
        spark.createDataFrame([], "bucket int, at long").coalesce(1).write.mode("ignore").parquet(f"{path}/manifest/version=-1")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")

    def newest(self, before: int | None = None) -> dict[int, int]:
        """The newest version of each bucket, as it was before a version. `count` entries at most."""
        names = self.spark.read.schema("bucket int, at long").parquet(f"{self.path}/manifest").inputFiles()
        found = {int(v) for v in re.findall(r"/version=(-?\d+)/", "\n".join(names))}
        held = [v for v in found if before is None or v < before]
        if not held or max(held) < 0:
            return {}
        rows = self.spark.read.schema("bucket int, at long").parquet(f"{self.path}/manifest/version={max(held)}").collect()
        return {r["bucket"]: r["at"] for r in rows}

    def rows(self, versions: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def current(self) -> DataFrame:
        return self.rows(self.newest())

    def asked(self, keys: DataFrame) -> dict[int, int]:
        """The buckets that some keys fall into, and how many rows do: `count` numbers at most."""
        with freed(self.spark):
            return {r[0]: r[1] for r in keys.groupBy(self.bucket()).count().collect()}

    def lookup(self, keys: DataFrame, before: int) -> DataFrame:
        """The rows of some keys, as they were before a version."""
        held = self.newest(before)
        if not held:  # nothing to look in, so nothing is shuffled
            return self.rows(held)
        asked = self.asked(keys)
        return self.rows({b: v for b, v in held.items() if b in asked}).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def replace(self, new: DataFrame, version: int, also: DataFrame | None = None) -> None:
        """Puts rows in place of those of the same keys, and of the keys in `also`, whose rows go."""
        keys = new.select(*self.keys) if also is None else new.select(*self.keys).unionByName(also.select(*self.keys))
        held, asked = self.newest(version), self.asked(keys)
        kept = self.rows({b: v for b, v in held.items() if b in asked})
        whole = new.select(*kept.columns)
        if held:
            whole = kept.join(keys.distinct(), self.keys, "left_anti").unionByName(whole)
        whole = whole.withColumn("bucket", self.bucket())
        folder = f"{self.path}/data/version={version}"
        parts = -(-max(asked.values(), default=1) // self.PART)
        task = F.col("bucket") * parts + F.pmod(F.hash(*self.keys), F.lit(parts))
        with freed(self.spark):
            whole.repartitionById(self.count * parts, task).sortWithinPartitions("bucket").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(folder)
        written = self.spark.read.schema(f"{self.schema}, bucket int").parquet(folder).inputFiles()
        # A touched bucket without a file has lost its last row.
        held = {b: v for b, v in held.items() if b not in asked} | {int(b): version for b in re.findall(r"/bucket=(\d+)/", "\n".join(written))}
        self.spark.createDataFrame(sorted(held.items()), "bucket int, at long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
