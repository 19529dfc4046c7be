"""Benchmark results: family statistics, pivot, choice of a checkpoint."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.checks import CheckError
from sluice.functions.text import FAMILY_PREFIXES, PRIMARY_METRIC, family_of


def exploded(results: DataFrame) -> DataFrame:
    """A row for each of a file's nested results."""
    return results.select(F.col("upstream").alias("of"), F.explode("results").alias("r")).select("of", "r.*").withColumn("upstream", F.coalesce("upstream", "of")).drop("of")


def main_metric(rows: DataFrame, prefixes: dict[str, str] = FAMILY_PREFIXES, metrics: dict[str, str] = PRIMARY_METRIC) -> DataFrame:
    """upstream, family and value of the good results whose family has a main metric which they give; rows have name, status and a map metrics."""
    family = family_of(F.col("name"), prefixes)
    value = F.coalesce(*(F.when(F.col("family") == f, F.try_element_at("metrics", F.lit(m))) for f, m in metrics.items()))
    return rows.where("status = 'ok'").withColumn("family", family).withColumn("value", value).where("value is not null").select("upstream", "family", "value")


def family_stats(rows: DataFrame) -> DataFrame:
    """mean and (sample) std by upstream and family; the std of one value is 0."""
    return rows.groupBy("upstream", "family").agg(F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"), F.count("*").alias("n"))


def report(upstreams: DataFrame, stats: DataFrame, families: list[str]) -> DataFrame:
    """A row for each upstream, with <family>_mean and <family>_std; null where there is none."""
    wide = stats.groupBy("upstream").pivot("family", families).agg(F.first("mean").alias("mean"), F.first("std").alias("std"))
    return upstreams.join(wide, "upstream", "left")


def proxy_score(values: DataFrame, name: str, value: str, higher_is_better: bool) -> DataFrame:
    """name and score (lower is better) from the mean of the values there are; infinite without any."""
    mean = F.avg(value)
    return values.groupBy(name).agg(F.coalesce(-mean if higher_is_better else mean, F.lit(float("inf"))).alias("score"))


def best(scores: DataFrame, name: str, order: Column) -> DataFrame:
    """One row: best and best_score; of equal scores the first in order. The caller refuses an infinite one."""
    return scores.agg(F.min_by(name, F.struct("score", order.alias("o"))).alias("best"), F.min("score").alias("best_score"), F.count("*").alias("candidates"))


def choose(scores: DataFrame, name: str, order: Column) -> tuple[object, float]:
    """The best candidate and its score; an error without candidates, or if all of them failed."""
    row = best(scores, name, order).first()
    if not row.candidates or row.best_score == float("inf"):
        raise CheckError("no candidate has a score")
    return row.best, row.best_score


def selection(scores: DataFrame, name: str, order: Column, task: str, seed: int) -> str:
    """The choice as JSON: task, seed, best checkpoint and score, and all candidates' scores, which are few."""
    chosen, score = choose(scores, name, order)
    made = {str(r[0]): r[1] for r in scores.select(name, "score").orderBy(order).collect()}
    return json.dumps({"proxy_task": task, "proxy_seed": seed, "best_checkpoint": str(chosen), "best_score": score, "all_scores": made}, indent=2)


def selection_json(scores: DataFrame, name: str) -> DataFrame:
    """all_scores: a JSON map of the candidates' scores, which are few."""
    return scores.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(name).cast("string"), "score"))))).alias("all_scores"))
