"""Incremental ingest of landing files and invalidation of jobs whose sources changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.functions.text import normalize_company
from tablewright.operators.ingest import FIELDS, RULES, Ingested, Rules, State, evidence_of_batch, evidence_of_state, ingest_feed, projected
from tablewright.operators.linkage import known_companies
from tablewright.sources.landing import ENVELOPE, FEEDS
from tablewright.storage import Buckets, passing, staged

#: Feeds are ingested in this order within a batch; each batch has so many versions of every store.
ORDER = tuple(FEEDS)
STEPS = 16


def payload_keys(rows: DataFrame) -> DataFrame:
    """Identity and digest of each landed record; the latest record of an identity within a batch wins."""
    keyed = rows.withColumns({"source_job_id": F.get_json_object("body", "$.id"), "payload_hash": F.sha2(F.coalesce("body", F.lit("")), 256)})
    w = Window.partitionBy("source_name", "source_job_id").orderBy(F.desc("fetched_at"), F.desc("payload_hash"))
    return keyed.where("source_job_id IS NOT NULL").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


SEEN = "source_name string, source_job_id string, payload_hash string"


def start_ingest_stream(spark: SparkSession, landing: str, store: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Each micro-batch appends the records whose (source, id, digest) the store lacks. What is there is looked up in an index beside the store, in the
    buckets of the batch's identities only. A batch that runs again writes its own folder again, so a restart neither loses nor doubles rows."""
    key = ["source_name", "source_job_id"]

    def write(batch: DataFrame, epoch: int) -> None:
        seen = Buckets(spark, f"{store}-index", SEEN, key, buckets)
        rows = staged(payload_keys(batch), "batch")
        held = staged(seen.lookup(rows, epoch), "held")
        new = rows.join(held, [*key, "payload_hash"], "left_anti")
        new.write.mode("overwrite").parquet(f"{store}/epoch={epoch}")
        seen.replace(held.unionByName(new.select(*held.columns)).distinct(), epoch)

    rows = spark.readStream.schema(ENVELOPE).json(landing)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Stores:
    """The state of R04 in buckets: companies by key, jobs by id, sources by identity and by job, and which jobs some evidence may stand for."""

    def __init__(self, spark: SparkSession, path: str, count: int = 64) -> None:
        source = "source_name string, source_job_id string, job_id string, source_url string, raw_payload string, is_active boolean, last_seen_at timestamp"
        fields = ", ".join(f"{f} string" for f in FIELDS)
        make = lambda name, schema, *keys: Buckets(spark, f"{path}/{name}", schema, list(keys), count)
        self.companies = make("companies", "company_key string, id string, name string, created_at timestamp", "company_key")
        self.jobs = make("jobs", f"id string, {fields}, status string, last_seen_at timestamp", "id")
        self.sources = make("sources", source, "source_name", "source_job_id")
        self.of_job = make("sources-of-jobs", source, "job_id")
        self.evidence = make("evidence", "kind string, key string, job_id string", "kind", "key")

    def state_for(self, batch: DataFrame, feed: str, before: int) -> State:
        """The part of the state that a batch can touch: its own sources, every job that some of its evidence may stand for with all of its sources, its companies."""
        keys = batch.select(normalize_company(F.col("company")).alias("company_key")).where("company_key <> ''")
        with passing(batch.sparkSession):
            companies = staged(self.companies.lookup(keys, before), "companies", lasting=True)
            known = known_companies(batch, companies)
            own = self.sources.lookup(batch.select("source_name", "source_job_id"), before).select("job_id")
            near = self.evidence.lookup(evidence_of_batch(known, feed).select("kind", "key"), before).select("job_id")
            jobs = staged(own.unionByName(near).distinct(), "touched-jobs")
            held = staged(self.jobs.lookup(jobs.withColumnRenamed("job_id", "id"), before), "jobs", lasting=True)
            return State(companies.select("id", "name", "created_at"), held, staged(self.of_job.lookup(jobs, before), "sources", lasting=True))

    def keep(self, state: State, version: int) -> DataFrame:
        """Writes a touched part back and gives its evidence, which `add` takes when the part itself may have gone."""
        # Any feed may ask for a job later, so it is found by the evidence of all of them: some kinds are the same for every feed, others read the addresses of a feed's board.
        found = evidence_of_state(state, "", Rules("", (("url", "uuid", "title"),)))
        for f in ORDER:
            if RULES[f].board:
                found = found.unionByName(evidence_of_state(state, f, RULES[f]._replace(evidence=(("native", "identity", "hosts"),))))
        # Looked for first: its shuffle is the largest, and the stores are not on disk yet.
        found = staged(found.select("kind", "key", F.col("target").alias("job_id")).distinct(), "evidence", lasting=True)
        companies = state.companies.withColumn("company_key", normalize_company(F.col("name"))).where("company_key <> ''")
        self.companies.replace(companies, version)
        self.jobs.replace(state.jobs, version)
        self.sources.replace(state.sources, version)
        self.of_job.replace(state.sources, version)
        return found

    def add(self, found: DataFrame, version: int) -> None:
        """Evidence is only ever added: a key that no longer holds costs a look at its job, and R04 judges by the rows themselves."""
        if self.evidence.newest(version):
            held = self.evidence.lookup(found, version)
            found = staged(held.unionByName(found.select(*held.columns)).distinct(), "all-evidence")
        self.evidence.replace(found, version)


def start_feed_stream(spark: SparkSession, landing: str, store: str, out: str, checkpoint: str, now: Column, count: int = 64) -> StreamingQuery:
    """M01 with R04: each micro-batch is ingested feed by feed (those of its feeds that ORDER names) into the stores below `store`; what happened to each record is
    written to `out`. A batch reads and writes the buckets of its own keys, whatever the stores hold beside them; a batch that runs again gives the same state."""

    def write(batch: DataFrame, epoch: int) -> None:
        stores = Stores(spark, store, count)
        with passing(batch.sparkSession):
            landed = staged(batch.where("body IS NOT NULL").select("source_name", "scope", "body"), "landed")
            present = {r[0] for r in landed.select("source_name").distinct().where(F.col("source_name").isin(*ORDER)).collect()}  # as many as there are feeds at most
            for k, feed in enumerate(f for f in ORDER if f in present):
                ingest(stores, landed, feed, epoch, k)

    def ingest(stores: Stores, landed: DataFrame, feed: str, epoch: int, k: int) -> None:
        version = epoch * STEPS + ORDER.index(feed)
        own = landed.where(F.col("source_name") == feed).select("scope", "body")
        with passing(landed.sparkSession):
            with passing(landed.sparkSession):
                state = taken_in(stores, own, feed, version, epoch, f"{out}/epoch={epoch}/step={k}")
                found = stores.keep(state, version)
            stores.add(found, version)

    def taken_in(stores: Stores, own: DataFrame, feed: str, version: int, epoch: int, log: str) -> State:
        """The new state of what the batch touches: of all that is written down here, only this is left on disk while it goes into the stores."""
        with passing(own.sparkSession):
            first, again, left = projected(own, feed)
            first = staged(first, "rows")
            part = stores.state_for(first, feed, version)
            done: Ingested = ingest_feed(own, part, feed, now, f"run-{epoch}", parts=(first, again, left))
            # Written in one go, so that what is kept and what is reported come from one evaluation.
            state = State(*(staged(df, f"new-{name}", lasting=True) for name, df in zip(State._fields, done.state, strict=True)))
            done.rows.withColumn("source_name", F.lit(feed)).write.mode("overwrite").option("compression", "zstd").parquet(log)
            return state

    rows = spark.readStream.schema(ENVELOPE).json(landing)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


WATCHED = ("job_id", "source_url", "is_active", "payload_hash")


def changed_jobs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Jobs of sources whose identity, address, activity or payload changed; times alone change nothing."""
    key = ["source_name", "source_job_id"]
    side = lambda df, s: df.select(*key, F.struct(*WATCHED).alias(s))
    j = side(before, "old").join(side(after, "new"), key, "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return j.select(F.explode(F.array("old.job_id", "new.job_id")).alias("job_id")).where("job_id IS NOT NULL").distinct()


def source_changes(held: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(job_id, changes) of the jobs that a sequence of events makes stale, and the newest state of their sources.

    held: a row for each source. events: rows of sources as they became at `changed_at`; `deleted` (null is no) ends one. Events of a source count in the order of
    (changed_at, content); each is held against the one before it, the first against the held row, so a change and its reversal are two changes, and an event that
    repeats what stands is none. Events older than the held row are late and change nothing. Both ends of a change count: the job left and the job joined."""
    key = ["source_name", "source_job_id"]
    deleted = F.coalesce("deleted", F.lit(False)) if "deleted" in events.columns else F.lit(False)
    value = F.struct(*WATCHED)
    old = held.select(*key, value.alias("value"), "changed_at", F.lit(0).alias("new"))
    new = events.select(*key, F.when(~deleted, value).alias("value"), "changed_at", F.lit(1).alias("new"))
    last = held.select(*key, F.col("changed_at").alias("_since"))
    new = new.join(last, key, "left").where("_since IS NULL OR changed_at >= _since").drop("_since")
    # Of equal values at one time one is enough, which keeps a source that repeats itself small before it is sorted.
    rows = old.unionByName(new.distinct())
    w = Window.partitionBy(*key).orderBy("new", "changed_at", "value")
    steps = staged(rows.withColumns({"before": F.lag("value").over(w), "later": F.lead("new").over(w)}), "steps")
    moves = steps.where("new = 1").where(~F.col("value").eqNullSafe(F.col("before")))
    stale = moves.select(F.explode(F.array_distinct(F.array_compact(F.array("before.job_id", "value.job_id")))).alias("job_id")).groupBy("job_id").agg(F.count("*").alias("changes"))
    return stale, steps.where("later IS NULL AND value IS NOT NULL").select(*key, "value.*", "changed_at")


def invalidation_store(spark: SparkSession, path: str, job: str = "long", count: int = 64) -> Buckets:
    return Buckets(spark, path, f"source_name string, source_job_id string, job_id {job}, source_url string, is_active boolean, payload_hash string, changed_at timestamp", ["source_name", "source_job_id"], count)


def start_invalidation_stream(spark: SparkSession, changes: str, schema: str, store: Buckets, out: str, checkpoint: str) -> StreamingQuery:
    """M02 as a stream: events of sources arrive as parquet files; each batch is held against the newest state of its sources, which it then advances, and its
    stale jobs are written. Version 0 of the store may hold a snapshot to begin with; batch n is version n + 1, so a batch that runs again sees what it saw."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = staged(batch, "events")
        stale, state = source_changes(store.lookup(rows, epoch + 1), rows)
        stale.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        store.replace(state, epoch + 1, also=rows)

    rows = spark.readStream.schema(schema).parquet(changes)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
