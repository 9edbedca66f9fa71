"""Small helpers shared by the document operators."""

from __future__ import annotations

import atexit
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch. Texts can be long, so batches are kept short to bound a worker's memory.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_short_batches(df: DataFrame) -> DataFrame:
    """The same rows in a session of its own, with the caller's settings, whose Arrow batches have BATCH_ROWS rows. The caller's session is not changed. A temporary view hands the
    plan over; it is dropped at once, as the plan is resolved by then."""
    spark, name = df.sparkSession, f"batches_{uuid.uuid4().hex}"
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    df.createGlobalTempView(name)
    try:
        return own.table(f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with short batches: a session's usual ones are 10,000 rows, which executors hold several times over for long texts. Where the result is joined into a plan of another
    session, that session's batches come, so `fn` gets slices of them, which share their memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, batch.num_rows, BATCH_ROWS))

    return in_short_batches(df).mapInArrow(run, schema)


def shared_value(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of a value of classes of this package. A plain broadcast would name the classes, and executors need not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def value_of(shared: Broadcast) -> Any:
    return cloudpickle.loads(shared.value)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that the session names."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The table as it was written to the shared folder: worked out once, read as often as it is needed, whatever executors are lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and tables between stages. Only a session without executors of its own may go without one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not named:
            named = tempfile.mkdtemp(prefix="checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)  # a local session's folder goes with its process
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


#: A key is hot if more than one of so many rows has it; so there are fewer hot keys than that.
HOT_KEYS = 1000


def join_hot(left: DataFrame, right: DataFrame, on: list[str], rows: str) -> DataFrame:
    """Left join with a table that has each key once, and in `rows` how many rows of `left` have it (so it is read three times: give a table or
    a checkpoint). Fewer than HOT_KEYS keys are hot: these are broadcast, and for the shuffle of the others their rows get keys of their own.
    So no task gets more than a thousandth of the rows for one key."""
    share = (right.agg(F.sum(rows)).first()[0] or 0) // HOT_KEYS
    kinds = dict(right.dtypes)
    values = [c for c in right.columns if c not in (*on, rows)]
    held = right.select(*on, F.struct(*values).alias("_held"), F.col(rows).alias("_rows"))
    hot = held.where(F.col("_rows") > share).select(*on, F.col("_held").alias("_hot"))
    apart = F.xxhash64(*left.columns)  # eight bytes, so never equal to a digest
    key = lambda c: F.when(F.col("_hot").isNull(), F.col(c)).otherwise(apart if kinds[c] == "bigint" else apart.cast("string").cast(kinds[c]))
    marked = left.join(F.broadcast(hot), on, "left").select(*left.columns, "_hot", *[key(c).alias(f"_{c}") for c in on])
    cold = held.where(F.col("_rows") <= share).select(*[F.col(c).alias(f"_{c}") for c in on], "_held")
    joined = marked.join(cold, [f"_{c}" for c in on], "left")
    found = F.when(F.col("_hot").isNotNull(), F.col("_hot")).otherwise(F.col("_held"))
    return joined.withColumn("_found", found).select(*left.columns, *[F.col(f"_found.{c}").alias(c) for c in values])


def join_salted(left: DataFrame, right: DataFrame, on: str, counts: DataFrame) -> DataFrame:
    """Inner join with a table that has each key once, and whose values may be long. `counts` (on, rows): how many rows of `left` have a key; a table or a checkpoint, as it is read
    twice. A key with more than a HOT_KEYS-th of the rows is cut into as many parts as it exceeds that share: its left rows are dealt to them, its right row goes to each. That
    makes less than twice HOT_KEYS copies in all, and only (key, parts) of the hot keys, fewer than HOT_KEYS, are broadcast."""
    share = max(1, (counts.agg(F.sum("rows")).first()[0] or 0) // HOT_KEYS)
    hot = F.broadcast(counts.where(F.col("rows") > share).select(on, F.ceil(F.col("rows") / share).cast("int").alias("_parts")))
    dealt = left.join(hot, on, "left").withColumn("_part", F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*left.columns), F.col("_parts")).cast("int"))).drop("_parts")
    copied = right.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copied, [on, "_part"]).drop("_part")


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; null ids give null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def held_out(doc_id: Column) -> Column:
    """True where the fold is 0. A null id is not held out and is not learned from either."""
    return F.coalesce(fold_of(doc_id) == 0, F.lit(False))


class Numbering(dict):
    """Numbers words in the order in which they are first asked for; `new` lists those not yet worked on."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def of(self, words: list[str]) -> list[int]:
        return list(map(self.__getitem__, words))


def kept_by_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gives, made once in each Python worker and kept for the tasks that follow in it.

    Functions are shipped by value, so their modules' globals start anew in every task; `sys` does not.
    Only caches belong here: a task gives the same rows with or without them.
    """
    store = sys.__dict__.setdefault("_tablewright_kept", {})
    if key not in store:
        store.clear()
        store[key] = make()
    return store[key]
