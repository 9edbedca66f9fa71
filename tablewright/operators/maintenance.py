"""R09 with R10: profiles kept up to date from what changed, not built anew."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.profiles import assemble_profiles, fingerprint, layers_to_run, publish_versions, select_fact
from tablewright.storage import staged

HASHES = ("metadata_hash", "text_hash", "version_hash", "input_hash")
#: From rows of inputs to candidates of facts: (by, field, value, score, active, evidence_id).
Layer = Callable[[DataFrame], DataFrame]


class ProfileState(NamedTuple):
    """prints (by, hashes) of the inputs as they were worked out last; candidates (by, layer, field, value, score, active, evidence_id); versions
    (by, input_hash, created_at, profile), which are only added to; pointers (by, input_hash) to the newest version of jobs that are there."""

    prints: DataFrame
    candidates: DataFrame
    versions: DataFrame
    pointers: DataFrame


class Upkeep(NamedTuple):
    by: str
    metadata: list[str]
    description: str
    quality: str
    fields: list[str]
    native: Layer
    text: Layer
    rules: dict[str, str]


def empty_state(inputs: DataFrame, how: Upkeep) -> ProfileState:
    spark, kind = inputs.sparkSession, dict(inputs.dtypes)[how.by]
    fields = ", ".join(f"{f}: struct<state: string, value: string, evidence_ids: array<string>>" for f in how.fields)
    make = lambda columns: spark.createDataFrame([], f"{how.by} {kind}, {columns}")
    return ProfileState(make(", ".join(f"{h} string" for h in HASHES)), make("layer string, field string, value string, score int, active boolean, evidence_id string"), make(f"input_hash string, created_at timestamp, profile struct<{fields}>"), make("input_hash string"))


def maintain(state: ProfileState, inputs: DataFrame, stale: DataFrame, how: Upkeep, now: Column) -> tuple[ProfileState, DataFrame]:
    """(new state, work). `stale` (by) names the jobs whose sources changed, moved or went (M02); the others are not read beyond the join that leaves them out.

    A stale job whose inputs have the digests they had is worked out no further (R09). Of the others each layer runs only on the rows whose part of the inputs changed, the
    candidates of the other layer are taken as they were, facts and profile are worked out again, and versions are published (R10). Jobs that are stale and not in `inputs` any more lose
    candidates, digests and pointer and keep their versions. work: (layer, n), the rows that each layer ran on. The result is that of building all anew."""
    by = how.by
    asked = staged(stale.select(by).distinct(), "stale")
    rows = staged(inputs.join(asked, by, "left_semi"), "stale-inputs")
    prints = staged(fingerprint(rows, by, how.metadata, how.description, how.rules).select(by, *HASHES), "prints")
    plan = staged(layers_to_run(prints, state.prints.join(asked, by, "left_semi"), by), "plan")
    gone = asked.join(rows, by, "left_anti")

    def ran(layer: str) -> DataFrame:
        return plan.where(F.array_contains("layers", layer)).select(by)

    new = None
    for layer, work_out in (("native", how.native), ("text", how.text)):
        made = work_out(rows.join(ran(layer), by, "left_semi")).select(by, F.lit(layer).alias("layer"), "field", "value", F.col("score").cast("int").alias("score"), "active", "evidence_id")
        new = made if new is None else new.unionByName(made)
    over = ran("native").withColumn("layer", F.lit("native")).unionByName(ran("text").withColumn("layer", F.lit("text")))
    over = over.unionByName(gone.select(by, F.explode(F.array(F.lit("native"), F.lit("text"))).alias("layer")))
    candidates = staged(state.candidates.join(over, [by, "layer"], "left_anti").unionByName(new), "candidates")

    redo = staged(ran("profile"), "redo")
    facts = select_fact(candidates.join(redo, by, "left_semi"), [by, "field"])
    profiles = assemble_profiles(facts, rows.join(redo, by, "left_semi").select(by, F.col(how.quality).alias("quality")), by, how.fields)
    fresh = profiles.join(prints.select(by, "input_hash"), by).select(by, "input_hash", now.alias("created_at"), "profile")
    before = state.versions.select(by, "input_hash", "created_at", "profile")
    # A job that comes back to inputs it had before points to that version again, so pointers follow the digests, not the dates.
    versions = staged(publish_versions(before, fresh, by)[0], "versions")
    pointers = state.pointers.join(asked, by, "left_anti").unionByName(prints.select(by, "input_hash"))
    kept = state.prints.join(asked, by, "left_anti").unionByName(prints)
    work = plan.select(F.explode("layers").alias("layer")).groupBy("layer").agg(F.count("*").alias("n"))
    work = work.unionByName(asked.agg(F.count("*").alias("n")).select(F.lit("asked").alias("layer"), "n")).unionByName(gone.agg(F.count("*").alias("n")).select(F.lit("gone").alias("layer"), "n"))
    return ProfileState(staged(kept, "kept-prints"), candidates, versions, staged(pointers, "pointers")), work


def current_profiles(state: ProfileState, by: str) -> DataFrame:
    """(by, input_hash, profile) of the jobs that are there."""
    return state.pointers.join(state.versions.select(by, "input_hash", "profile"), [by, "input_hash"])
