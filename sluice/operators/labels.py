"""Run labels: which names and tags would change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.checks import require_none, require_unique
from sluice.functions.text import tag_pairs


def refuse_bad_tags(df: DataFrame, value: str) -> DataFrame:
    return require_none(df, F.exists(tag_pairs(F.col(value)), lambda p: p["v"].isNull()), f"{value} with an item that isn't key=value")


def wanted(runs: DataFrame, commit: str = "", since: Column | None = None) -> DataFrame:
    """Runs whose commit begins so, started since then, by start."""
    found = runs.where(F.startswith(F.col("commit"), F.lit(commit)))
    return (found.where(F.col("start_time") >= since) if since is not None else found).orderBy("start_time")


def changes(runs: DataFrame, name: Column, tags: Column, check: bool = True) -> DataFrame:
    """runs with new_name and new_tags, of those that either would change.

    tags is a map; only what differs is new, and the name so far is kept as a tag the
    first time. Two runs of one new name are refused.
    """
    named = runs.withColumn("new_name", name)
    if check:
        require_unique(named, "new_name")
    full = F.when(F.map_contains_key("tags", F.lit("original_run_name")), tags).otherwise(F.map_concat(tags, F.create_map(F.lit("original_run_name"), F.col("name"))))
    new = F.map_filter(full, lambda k, v: ~F.try_element_at(F.col("tags"), k).eqNullSafe(v))
    return named.withColumn("new_tags", new).where((F.col("new_name") != F.col("name")) | (F.size("new_tags") > 0))
