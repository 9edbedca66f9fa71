"""Bucketed state, streams over it, and staged linkage plans."""

import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tablewright import storage
from tablewright.operators import ingest as I
from tablewright.operators import linkage as L
from tablewright.plans import linkage as PL
from tablewright.storage import Buckets
from tablewright.streaming import jobs as J

DAY = lambda n: dt.datetime(2026, 1, n)


def test_buckets_replace_and_rerun(spark, tmp_path):
    store = Buckets(spark, str(tmp_path / "b"), "k string, v long", ["k"], 4)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v long")
    state, draw = {}, random.Random(2)
    for version in range(6):
        new = {f"k{draw.randrange(40)}": draw.randrange(100) for _ in range(draw.randrange(1, 12))}
        gone = {f"k{draw.randrange(40)}" for _ in range(version)} - set(new)
        for _ in range(2):  # a version that runs again sees what it saw
            store.replace(frame(list(new.items())), version, also=frame([(k, 0) for k in gone]) if gone else None)
        state = {k: v for k, v in (state | new).items() if k not in gone}
        assert {r.k: r.v for r in store.current().collect()} == state
    assert {r.k for r in store.lookup(frame([("k1", 0), ("nobody", 0)]), 9).collect()} <= {"k1"}
    store.replace(frame([]), 7, also=store.current())
    assert store.current().count() == 0 and store.newest() == {}


def test_small_batch_reads_its_buckets_only(spark, tmp_path):
    store = Buckets(spark, str(tmp_path / "b"), "k string, v long", ["k"], 32)
    one = spark.createDataFrame([("k7", 1)], "k string, v long")
    files = []
    for version in range(3):
        rows = spark.range(400 * (version + 1)).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
        store.replace(rows, version)
        files.append(len(store.rows({b: v for b, v in store.newest().items() if b in store.asked(one)}).inputFiles()))
    assert files == [1, 1, 1]


EVENTS = "source_name string, source_job_id string, job_id long, source_url string, is_active boolean, payload_hash string, changed_at timestamp, deleted boolean"


def event(key, job, payload, day, active=True, deleted=None):
    return ("s", key, job, "u", active, payload, DAY(day), deleted)


def test_changes_are_held_against_the_newest_state(spark, tmp_path):
    changes, out, cp = (str(tmp_path / n) for n in ("changes", "out", "cp"))
    store = J.invalidation_store(spark, str(tmp_path / "store"), "long", 4)
    store.replace(spark.createDataFrame([event(k, n, "h", 1)[:7] for k, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5))], EVENTS.removesuffix(", deleted boolean")), 0)
    batches = [
        [event("a", 1, "h2", 2), event("a", 1, "h", 3), event("b", 2, "h", 2), event("c", 9, "h", 2), event("f", 6, "x", 2)],  # there and back; a time alone; a move; a new one
        [event("a", 1, "h", 4), event("a", 1, "h", 4), event("c", 3, "h", 3), event("f", 6, "x", 3), event("d", 4, "h", 3, deleted=True)],  # repeats; back to the first job; an end
        [event("d", 4, "h", 4), event("e", 5, "old", 1, active=None), event("e", 5, "older", 1), event("b", 2, "late", 1)],  # again after its end; ties in one time; late
    ]
    want = [{1: 2, 3: 1, 9: 1, 6: 1}, {3: 1, 9: 1, 4: 1}, {4: 1, 5: 2}]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(changes)
        J.start_invalidation_stream(spark, changes, EVENTS, store, out, cp).awaitTermination()
        assert {r.job_id: r.changes for r in spark.read.parquet(f"{out}/epoch={n}").collect()} == want[n]
    J.start_invalidation_stream(spark, changes, EVENTS, store, out, cp).awaitTermination()  # nothing new
    held = {r.source_job_id: (r.job_id, r.payload_hash) for r in store.current().collect()}
    assert held["a"] == (1, "h") and held["b"] == (2, "h") and held["c"] == (3, "h") and held["d"] == (4, "h") and held["f"] == (6, "x")
    # A batch that runs again, as after a crash before its commit, gives what it gave.
    rows = spark.createDataFrame(batches[2], EVENTS)
    stale, _ = J.source_changes(store.lookup(rows, 3), rows)
    assert {r.job_id: r.changes for r in stale.collect()} == want[2]


def record(feed, scope, body, day=1):
    return json.dumps({"source_name": feed, "scope": scope, "run_id": "r", "page_no": 1, "fetched_at": f"2026-01-0{day}T00:00:00", "body": json.dumps(body)})


def test_feed_stream_gives_what_whole_batches_give(spark, tmp_path):
    """Two feeds in three drops against R04 over whole tables, feed by feed."""
    lever = lambda i, title, country="CZ": ("lever_direct", "acme", {"id": str(i), "text": title, "company": "Acme s.r.o.", "country": country, "hostedUrl": f"https://jobs.example.com/acme/{i}", "categories": {"location": "Brno"}})
    jooble = lambda i, title, link: ("jooble_direct", "all", {"id": str(i), "title": title, "company": "ACME", "link": link})
    drops = [
        [lever(1, "Baker"), lever(2, "Cook"), lever(3, "Chef", "US"), jooble(10, "Waiter", "https://else.example.com/w")],
        [jooble(11, "Baker", "https://jobs.example.com/acme/1/?x=1"), jooble(12, "Clerk", "https://jobs.example.com/acme/4/apply")],
        [lever(4, "Clerk of works"), lever(2, "Head cook"), lever(5, "Waiter"), jooble(10, "Waiter again", "https://else.example.com/w")],
    ]
    land = tmp_path / "land"
    land.mkdir()
    args = (str(land), str(tmp_path / "store"), str(tmp_path / "out"), str(tmp_path / "cp"), F.lit("2026-01-31").cast("timestamp"), 4)
    schema = {"companies": "id string, name string, created_at timestamp", "jobs": "id string, " + ", ".join(f"{f} string" for f in I.FIELDS) + ", status string, last_seen_at timestamp", "sources": "source_name string, source_job_id string, job_id string, source_url string, raw_payload string, is_active boolean, last_seen_at timestamp"}
    state = I.State(*(spark.createDataFrame([], schema[n]) for n in I.State._fields))
    for n, drop in enumerate(drops):
        (land / f"{n}.json").write_text("\n".join([*(record(*r) for r in drop), "no record"]))
        J.start_feed_stream(spark, *args).awaitTermination()
        for feed in ("lever_direct", "jooble_direct"):
            rows = spark.createDataFrame([(s, json.dumps(b)) for f, s, b in drop if f == feed] or [], "scope string, body string")
            if rows.count():
                state = I.ingest_feed(rows, state, feed, args[4], f"run-{n}").state
                state = I.State(*(spark.createDataFrame(df.collect(), df.schema) for df in state))
    J.start_feed_stream(spark, *args).awaitTermination()
    stores = J.Stores(spark, args[1], 4)
    plain = lambda df, *cols: sorted(repr(tuple(r)) for r in df.select(*cols).collect())
    assert plain(stores.sources.current(), "source_name", "source_job_id", "job_id", "source_url") == plain(state.sources, "source_name", "source_job_id", "job_id", "source_url")
    assert plain(stores.of_job.current(), "source_name", "source_job_id", "job_id") == plain(state.sources, "source_name", "source_job_id", "job_id")
    assert plain(stores.jobs.current(), "id", *I.FIELDS, "status") == plain(state.jobs, "id", *I.FIELDS, "status")
    assert plain(stores.companies.current(), "id") == plain(state.companies, "id")
    log = {(r.source_job_id, r.change, r.evidence) for r in spark.read.option("recursiveFileLookup", "true").parquet(args[2]).collect()}
    assert {("acme:3", "skipped: foreign", None), ("all:11", "attached", "url"), ("acme:4", "attached", "identity"), ("acme:2", "updated", None)} <= log


def test_stream_leaves_nothing_but_its_stores(spark, tmp_path, monkeypatch):
    """What a batch writes down between its steps goes with the batch, and the log is whole by then."""
    monkeypatch.setattr(storage, "scratch", lambda spark, name: str(tmp_path / "steps" / f"{name}-{uuid.uuid4().hex}"))
    body = lambda i: {"id": str(i), "text": f"Job {i}", "company": "Acme", "country": "CZ", "hostedUrl": f"https://jobs.example.com/acme/{i}"}
    (tmp_path / "land").mkdir()
    for n in range(2):
        (tmp_path / "land" / f"{n}.json").write_text("\n".join(record("lever_direct", "acme", body(i)) for i in range(3 * n, 3 * n + 4)))
        J.start_feed_stream(spark, *(str(tmp_path / x) for x in ("land", "store", "out", "cp")), F.lit("2026-01-31").cast("timestamp"), 4).awaitTermination()
    assert J.Stores(spark, str(tmp_path / "store"), 4).sources.current().count() == 7
    assert spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).count() == 8
    assert list((tmp_path / "steps").iterdir()) == []


def test_shuffle_files_go_with_their_step(spark):
    def files() -> set[str]:
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    before = files()
    rows = storage.staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - before and rows.count() == 7


def test_large_buckets_are_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Buckets, "PART", 10)
    store = Buckets(spark, str(tmp_path / "b"), "k long, v long", ["k"], 2)
    for version in range(2):
        store.replace(spark.range(100).select(F.col("id").alias("k"), (F.col("id") + version).alias("v")), version)
    assert {(r.k, r.v) for r in store.current().collect()} == {(k, k + 1) for k in range(100)} and store.current().count() == 100
    assert len(store.current().inputFiles()) > 2


def test_ranked_evidence(spark):
    probes = spark.createDataFrame([(p, r, k, key) for p, r, k, key in [
        ("one", 0, "url", "u1"), ("two", 0, "url", "u2"), ("two", 1, "title", "t2"), ("both", 0, "native", "n"), ("both", 0, "url", "u3"), ("taken", 0, "title", "t4"), ("taken", 1, "url", "u4"), ("none", 0, "url", "zzz")]], "probe string, rank int, kind string, key string")
    held = spark.createDataFrame([("url", "u1", 1, False), ("url", "u2", 2, False), ("url", "u2", 3, False), ("title", "t2", 3, False), ("native", "n", 4, False), ("url", "u3", 5, False), ("title", "t4", 6, True), ("url", "u4", 7, False)], "kind string, key string, target int, taken boolean")
    assert {(r.probe, r.target, r.kind) for r in L.resolve_ranked(probes, held).collect()} == {("one", 1, "url"), ("two", 3, "title"), ("taken", 7, "url")}


def test_contradicting_addresses_and_unverified_hosts_say_nothing(spark):
    source = "source_name string, source_job_id string, job_id string, source_url string, apply_url string"
    rows = [("x", "1", "j1", "https://jobs.a.com/acme/1", "https://jobs.a.com/acme/1/apply"), ("x", "2", "j2", "https://jobs.a.com/acme/2", "https://jobs.a.com/acme/3"), ("x", "3", "j3", "https://jobs.a.com/acme/4", "https://evil.com/acme/4")]
    jobs = spark.createDataFrame([], "id string, title string, company_id string, canonical_url string")
    state = I.State(jobs, jobs, spark.createDataFrame(rows, source))
    rules = I.Rules("digits", (("identity",), ("hosts",)), (r"", r"^/([a-z]+)/([0-9]+)(?:/apply)?$"), ("jobs.a.com",))
    got = {(r.kind, r.key, r.target) for r in I.evidence_of_state(state, "lever_direct", rules).collect()}
    assert got == {("identity", "acme:1", "j1"), ("identity", "acme:4", "j3"), ("hosts", "1", "j1")}


@pytest.mark.parametrize("make", [PL.r01, PL.r02, PL.r01_pages])
def test_plans_stay_short(spark, sf_dir, make):
    plan = make(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") < 20


def test_endpoints_are_counted_without_a_join(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5), (3, 4, 0.6), (4, 5, 0.7), (6, 7, 0.8), (6, 7, 0.8), (8, 9, None)], "a int, b int, s double")
    out = L.unique_endpoints(pairs)
    assert {(r.a, r.b, r.s) for r in out.collect()} == {(1, 2, 0.5), (8, 9, None)}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_maintained_profiles_equal_a_rebuild(spark):
    """Random changes followed one after another against building all anew; what is not stale is not worked on."""
    from tablewright.operators import maintenance as M
    from tablewright.plans.streams import upkeep

    how, draw = upkeep(), random.Random(8)
    docs = {k: ["en", f"src{k % 3}", "word " * draw.randrange(20, 500)] for k in range(30)}
    frame = lambda d: spark.createDataFrame([(k, *v, "complete") for k, v in d.items()], "doc_id long, lang string, source string, text string, quality string")
    now = lambda n: F.lit(DAY(n)).cast("timestamp")
    state, _ = M.maintain(M.empty_state(frame(docs), how), frame(docs), frame(docs), how, now(1))
    for n in range(2, 5):
        old = {k: list(v) for k, v in docs.items()}
        for k in draw.sample(sorted(docs), 6):
            docs[k][draw.randrange(3)] = draw.choice(["fr", "de", None, "!! " * 200, "word " * 50])
        gone, back = draw.choice(sorted(docs)), 100 + n
        docs.pop(gone)
        docs[back] = ["en", "src9", "new " * 99]
        stale = {k for k in docs if docs[k] != old.get(k)} | {gone, min(docs)}
        state, work = M.maintain(state, frame(docs), spark.createDataFrame([(k,) for k in stale], "doc_id long"), how, now(n))
        whole, _ = M.maintain(M.empty_state(frame(docs), how), frame(docs), frame(docs), how, now(n))
        rows = lambda s: {r.doc_id: (r.input_hash, r.profile) for r in M.current_profiles(s, "doc_id").collect()}
        assert rows(state) == rows(whole)
        ran = {r.layer: r.n for r in work.collect()}
        changed = {k for k in docs if docs[k] != old.get(k)}
        assert ran["profile"] == len(changed) and ran["gone"] == 1 and ran["text"] == sum(docs[k][2] != old.get(k, [0, 0, 0])[2] for k in changed)
    assert state.versions.count() > 30 and state.versions.where(F.col("doc_id") == gone).count() >= 1


def test_contained_in_one_long_run(spark):
    """A text of a million letters without a space, and a part from its middle."""
    import time

    draw = random.Random(4)
    long = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    small = spark.createDataFrame([(1, long[700_000:700_200]), (2, long[:150] + "!"), (3, long[-120:])], "item_id int, text string")
    start = time.time()
    got = L.contained_in(small, "item_id", spark.createDataFrame([(7, long), (8, "short one " * 20)], "doc_id int, text string"), "doc_id").collect()
    assert {tuple(r) for r in got} == {(1, 7), (3, 7)} and time.time() - start < 60
