"""Scans that later steps start from: jobs with their sources, and what freshness needs of each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_jobs(jobs: DataFrame, sources: DataFrame, job: str, fields: list[str]) -> DataFrame:
    """Jobs with `sources`, an array of their source rows in the order of `fields`; null without any. A job has few sources by nature."""
    held = sources.groupBy(job).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("sources"))
    return jobs.join(held, job, "left")


def freshness_snapshot(sources: DataFrame, payload: str, keep: list[str], paths: dict[str, str]) -> DataFrame:
    """The columns of `keep` and what the payload states at each path, as text; nothing else of the payload is carried on."""
    return sources.select(*keep, *[F.get_json_object(payload, path).alias(name) for name, path in paths.items()])


def select_scopes(registry: DataFrame, order: list[str], only: Column | None = None, max_n: int | None = None, **equal: object) -> DataFrame:
    """Registered scopes in order, those whose columns equal the given values (or one of a list) and that meet `only`; at most `max_n`."""
    for name, value in equal.items():
        registry = registry.where(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    chosen = (registry if only is None else registry.where(only)).orderBy(*order)
    return chosen if max_n is None else chosen.limit(max_n)
