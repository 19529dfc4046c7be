"""Metrics by interval, streak alarms, checkpoint retention and resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.checks import CheckError
from sluice.functions.text import step_of


def stepped(readings: DataFrame, run: str, order: str) -> DataFrame:
    """readings with step, from 1 in each run."""
    return readings.withColumn("step", F.row_number().over(Window.partitionBy(run).orderBy(order)).cast("long"))


def by_interval(readings: DataFrame, run: str, value: str, every: int) -> DataFrame:
    """For each run and interval of steps: readings, mean, sum, the last value and step."""
    interval = F.floor((F.col("step") - 1) / every).cast("long").alias("interval")
    return readings.groupBy(run, interval).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.sum(value).alias("total"), F.max_by(value, "step").alias("last"), F.max("step").alias("last_step"))


def interval_report(readings: DataFrame, run: str, every: int, means: list[str], norm: str, seconds: str, clock: str) -> DataFrame:
    """What is logged whenever a whole interval of steps is done: for each run, and the last step of each such interval,
    the mean of each of means over the readings that give it (0 without any), norm summed by the interval's length, and
    per_second: the sum of seconds by what the clock (in seconds) has gone on since the interval before, or since the run's first reading."""
    interval = F.floor((F.col("step") - 1) / every).cast("long").alias("interval")
    mean = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in means]
    sums = readings.groupBy(run, interval).agg(F.max("step").alias("step"), *mean, (F.coalesce(F.sum(norm), F.lit(0.0)) / every).alias(f"{norm}_norm"), F.sum(seconds).alias("__seconds"), F.max_by(clock, "step").alias("__end"), F.min_by(clock, "step").alias("__start"))
    elapsed = F.col("__end") - F.coalesce(F.lag("__end").over(Window.partitionBy(run).orderBy("interval")), F.col("__start"))
    rate = F.when(elapsed > 0, F.col("__seconds") / elapsed).otherwise(0.0)
    return sums.withColumn("per_second", rate).where(F.col("step") % every == 0).drop("interval", "__seconds", "__end", "__start")


def alarms(readings: DataFrame, run: str, value: str, floor: float, streak: int) -> DataFrame:
    """run, first_alarm and readings in alarm: a reading below the floor raises one if streak readings in a row are below."""
    by_run = Window.partitionBy(run).orderBy("step")
    low = readings.withColumn("low", F.col(value) < floor)
    island = low.withColumn("island", F.sum(F.when(~F.col("low"), 1).otherwise(0)).over(by_run))
    length = island.where("low").withColumn("length", F.row_number().over(Window.partitionBy(run, "island").orderBy("step")))
    return length.where(F.col("length") >= streak).groupBy(run).agg(F.min("step").alias("first_alarm"), F.count("*").alias("alarms"))


def checkpoints(listing: DataFrame, folder: str, file: str, needed: list[str]) -> DataFrame:
    """step and complete of each folder that is named like a checkpoint; complete ones have all needed files."""
    found = listing.withColumn("step", step_of(F.col(folder))).where(F.col("step").isNotNull())
    return found.groupBy("step").agg(F.bool_and(F.lit(True)).alias("__t"), *(F.max((F.col(file) == n).cast("int")).alias(f"__{i}") for i, n in enumerate(needed))).select("step", (sum(F.col(f"__{i}") for i in range(len(needed))) == len(needed)).alias("complete"))


def newest_first(found: DataFrame) -> DataFrame:
    return found.where("complete").orderBy(F.desc("step"))


def resume_step(found: DataFrame) -> DataFrame:
    """step of the newest complete checkpoint, 0 without any."""
    return found.where("complete").agg(F.coalesce(F.max("step"), F.lit(0).cast("long")).alias("step"))


def retained(found: DataFrame, milestones: list[int], newest: int) -> DataFrame:
    """found with keep: milestones, and the newest of the others. One row a checkpoint."""
    stone = F.col("step").isin(milestones) if milestones else F.lit(False)
    nth = F.row_number().over(Window.partitionBy("stone").orderBy(F.desc("step")))
    return found.withColumn("stone", stone).withColumn("keep", F.col("stone") | (nth <= newest)).drop("stone")


def trimmed(curve: DataFrame, resume: int) -> DataFrame:
    """The rows up to the step that a run resumes from; none for 0."""
    return curve.where(F.col("step") <= resume) if resume else curve.where(F.lit(False))


def milestones(found: DataFrame, steps: list[int]) -> DataFrame:
    """step and there of each milestone; those that aren't complete checkpoints aren't there."""
    wanted = found.sparkSession.createDataFrame([(s,) for s in steps], "step long")
    return wanted.join(found.where("complete").select("step", F.lit(True).alias("there")), "step", "left").withColumn("there", F.coalesce("there", F.lit(False))).orderBy("step")


def usable_step(found: DataFrame, unreadable: DataFrame, explicit: int | None = None) -> int:
    """The newest complete checkpoint that isn't unreadable, 0 without any; an explicit one must be complete."""
    if explicit is not None:
        if found.where((F.col("step") == explicit) & F.col("complete")).isEmpty():
            raise CheckError(f"checkpoint {explicit} is not complete")
        return explicit
    return resume_step(found.join(unreadable.select("step"), "step", "left_anti")).first().step
