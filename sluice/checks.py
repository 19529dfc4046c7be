"""Validation barriers, which raise in Python, since a check inside a plan may be pruned: as aggregates of their own, or observed while rows are written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sluice.shared import located


class CheckError(ValueError):
    """Data breaks a rule."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise CheckError(f"columns are missing: {', '.join(missing)}")
    return df


def require_none(df: DataFrame, bad: Column, what: str) -> DataFrame:
    """df, unless bad holds for any row."""
    n = df.where(bad).count()
    if n:
        raise CheckError(f"{what}: {n} rows")
    return df


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that several rows have, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    found = repeated(df, *keys).limit(5).collect()
    if found:
        raise CheckError(f"repeated {', '.join(keys)}: {', '.join(str(tuple(r)[:-1]) for r in found)}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise CheckError(f"nothing left: {what}")
    return df


def require_disjoint(a: DataFrame, b: DataFrame, key: str) -> None:
    n = a.select(key).intersect(b.select(key)).count()
    if n:
        raise CheckError(f"{n} values of {key} on both sides")


def published(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], rules: dict[str, Column] | None = None, unique: str | None = None) -> int:
    """Writes df beside path and renames it there if no rule holds for any row, else removes it; returns the number of rows.

    The rows are read once: what breaks a rule is counted while they are written, so
    nothing that reads path meets rows that were refused, or half of them. What is at path stays until then.
    unique: a column whose values must differ; its rows are then dealt by it.
    """
    spark, rules, seen = df.sparkSession, dict(rules or {}), Observation()
    watched = df
    if unique:
        watched = df.withColumn("__same", F.count("*").over(Window.partitionBy(unique)))
        rules[f"repeated {unique}"] = F.col("__same") > 1
    watched = watched.observe(seen, F.count("*").alias("rows"), *(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"rule_{i}") for i, bad in enumerate(rules.values())))
    part = f"{path.rstrip('/')}.part-{uuid.uuid4().hex}"
    fs, made = located(spark, part)
    try:
        write(watched.drop("__same"), part)
        got = seen.get
        broken = [f"{what}: {got[f'rule_{i}']} rows" for i, what in enumerate(rules) if got.get(f"rule_{i}")]
        if broken:
            raise CheckError("; ".join(broken))
        _, at = located(spark, path)
        fs.delete(at, True)
        if not fs.rename(made, at):
            raise OSError(f"{path} could not be written")
    except BaseException:
        fs.delete(made, True)
        raise
    return got.get("rows", 0)


def require_enough_shards(shards: int, workers: int, world: int) -> None:
    """Every worker of every rank needs a shard of its own."""
    if shards < max(1, workers) * world:
        raise CheckError(f"{shards} shards for {world} ranks of {workers} workers")
