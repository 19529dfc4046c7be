"""Cuts: split long ones, merge short ones, shuffle, shard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.checks import require_none
from sluice.operators.fits import lots
from sluice.operators.ordering import hash_bucket, ranked, seeded


def split_long(cuts: DataFrame, most: int, id_col: str = "id", length: str = "duration_ms") -> DataFrame:
    """Cuts above most become the fewest equal windows that aren't, with start and length; the last takes what is left. Ids get -p and the window's number."""
    n = F.greatest(F.lit(1), F.ceil(F.col(length) / most)).cast("int")
    out = cuts.withColumn("__n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    piece = F.col(length) / F.col("__n")
    whole = F.col("__n") == 1
    new = F.when(whole, F.col(id_col)).otherwise(F.concat(F.col(id_col), F.lit("-p"), F.col("part").cast("string")))
    took = F.when(F.col("part") == F.col("__n") - 1, F.col(length) - F.col("part") * piece).otherwise(piece)
    return out.withColumns({"cut_id": new, "start_ms": F.col("part") * piece, "cut_ms": took}).drop("__n")


def merge_short(cuts: DataFrame, least: int, target: int, id_col: str = "id", channel: str = "channel_id", length: str = "duration_ms", order: str = "row_index") -> DataFrame:
    """cut_id, channel, n, total_ms and first_row of cuts of least or more, which pass, and of merged shorter ones.

    A channel's short cuts are gathered in order until they reach target, then anew; the
    last lot stays if it has least. A lot of one keeps its id, others are concat-<first id>-x<n>.
    A channel of any size is several tasks' work (``fits.lots``).
    """
    base = cuts.select(F.col(id_col).alias("cut_id"), F.col(channel).alias("channel"), F.col(length).cast("long").alias("total_ms"), F.col(order).cast("long").alias("first_row"))

    short = lots(base.where(F.col("total_ms") < least), "channel", "first_row", "total_ms", target)
    merged = short.groupBy("channel", "lot").agg(F.min_by("cut_id", "first_row").alias("first_id"), F.count("*").alias("n"), F.sum("total_ms").alias("total_ms"), F.min("first_row").alias("first_row"))
    merged = merged.where(F.col("total_ms") >= min(least, target))
    name = F.when(F.col("n") == 1, F.col("first_id")).otherwise(F.concat(F.lit("concat-"), "first_id", F.lit("-x"), F.col("n").cast("string")))
    columns = ["cut_id", "channel", "n", "total_ms", "first_row"]
    return base.where(F.col("total_ms") >= least).withColumn("n", F.lit(1).cast("long")).select(columns).unionByName(merged.withColumn("cut_id", name).select(columns))


def sharded(cuts: DataFrame, seed: int, size: int, id_col: str = "id") -> DataFrame:
    """cuts with position (in seeded order) and shard_id: size of them a shard."""
    out = ranked(cuts.withColumn("__order", seeded(F.col(id_col), seed)), [F.col("__order"), F.col(id_col)], hash_bucket(F.col("__order")), "position").drop("__order")
    return out.withColumn("shard_id", F.floor(F.col("position") / size).cast("long"))


def shard_numbers(cuts: DataFrame, size: int) -> DataFrame:
    """The shard_id of every shard that sharded makes of cuts: positions have no gaps, so the number of cuts tells them."""
    return cuts.sparkSession.range(-(-cuts.count() // size)).withColumnRenamed("id", "shard_id")


def dealt(shards: DataFrame, seed: int, epoch: int, world: int, workers: int) -> DataFrame:
    """shard_id and worker: each shard goes to one worker of one rank, dealt anew each epoch; one row a shard."""
    out = ranked(shards.withColumn("__order", seeded(F.col("shard_id"), seed + epoch)), [F.col("__order")], hash_bucket(F.col("__order")), "__nth")
    return out.withColumn("worker", (F.col("__nth") % (world * max(1, workers))).cast("long")).drop("__order", "__nth")


def summary(sharded_cuts: DataFrame, length: str = "duration_ms") -> DataFrame:
    return sharded_cuts.groupBy("shard_id").agg(F.count("*").alias("n"), F.sum(length).alias("total_ms"), F.max(length).alias("longest_ms"))


def too_long(length: Column, most: float) -> Column:
    """A condition for a barrier: a hundredth of a second is let pass."""
    return length > most + 10


def refuse_too_long(cuts: DataFrame, most: float, length: str = "cut_ms") -> DataFrame:
    """cuts, unless one is too long: none may survive the splitting."""
    return require_none(cuts, too_long(F.col(length), most), f"cuts longer than {most} ms")


def refuse_other_rates(cuts: DataFrame, rate: int, column: str = "sampling_rate") -> DataFrame:
    """cuts, unless one has another sampling rate than training expects, or none."""
    return require_none(cuts, ~F.col(column).eqNullSafe(F.lit(rate)), f"cuts whose {column} isn't {rate}")
