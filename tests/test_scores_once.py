"""Scores of pairs are worked out once, and are those of the plain expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.text import similarity_of, trigram_codes, with_similarity
from tablewright.functions.values import location_similarity, with_location_similarity

TEXTS = ["", "praha", "brno", "praha 1", "data engineer", "engineer of data", "Data-Engineer", "--", "a"]


def pairs(spark):
    rows = spark.createDataFrame([(a, b) for a in TEXTS for b in TEXTS], "a string, b string")
    return rows.withColumns({"ga": trigram_codes(F.col("a")), "gb": trigram_codes(F.col("b"))})


def test_similarity_is_one_intersection(spark):
    found = with_similarity(pairs(spark), "ga", "gb", "s").where("s >= 0.2")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect") == 1
    plain = pairs(spark).select("a", "b", similarity_of(F.col("ga"), F.col("gb")).alias("s")).where("s >= 0.2")
    assert sorted(found.select("a", "b", "s").collect()) == sorted(plain.collect())


def test_location_similarity_by_columns(spark):
    found = with_location_similarity(pairs(spark), "a", "b", "ga", "gb", "s").select("a", "b", "s").collect()
    plain = pairs(spark).select("a", "b", location_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert sorted(found) == sorted(plain)


def test_safe_merges_need_no_other_pairs(spark, sf_dir):
    """R01 with R02's thresholds gives R02 the same pairs as R01 with its own."""
    from tablewright.operators import linkage as L
    from tablewright.plans.linkage import order_jobs

    jobs = order_jobs(spark, sf_dir)
    merged = [L.safe_auto_merge(L.duplicate_candidates(jobs, words=False, **limits).withColumn("status", F.lit("pending"))).select("a", "b", "confidence").collect() for limits in ({}, L.SAFE)]
    assert merged[0] == merged[1] and merged[0]
